"""Cross-entropy difference between a target and a background language model.

Both models are bigram models over one vocabulary. Words and word pairs are
counted under full 64-bit keys, so the tables grow with the text. The target
model counts the documents marked as target; the background model counts all
documents. Both smooth alike (Dirichlet, pairs over words over a uniform
floor), and the background's counts are scaled to the target's total so that
smoothing weighs on both the same: that is what makes their losses comparable.
Each document is scored without its own counts.

A document's score is its mean loss per word under the target model minus
that under the background model (nats). Below zero it reads more like the
target than like the corpus.

Documents are written once, in chunks. A chunk sends each of its distinct words
and pairs once, with their counts in it, to the range of their key; the range
sums every key over all chunks and answers each chunk with what the others add
to its own counts, where they add anything. The chunk, joined by its answers,
then scores its documents. No table is whole anywhere, and a frequent word or
pair is one entry a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import keyed
from lakeloom.llm.common import HashedWords, columns, cut, lean, partitions, ship, text_bytes
from lakeloom.llm.substrings import _input_bytes
from lakeloom.operators.joins import broadcast_if_small

CHUNK_WORDS, CHUNK_BYTES, CHUNK_ROWS = 1_000_000, 8 << 20, 50_000
RANGE_BYTES = 48 << 20
MASS_PAIR, MASS_WORD, LEAST = 200.0, 1.0, 2
#: Target ids up to so many are broadcast, beyond them joined by a merge join.
MOST_IDS = 2_000_000
SALTS = 1024
_B = np.uint64(0x9E3779B97F4A7C15)
_START = np.uint64(0xD1B54A32D192ED03)  # stands before the first word


def _pairs(h: np.ndarray) -> np.ndarray:
    pair = h[:-1] * _B + h[1:]
    return (pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def chunk_keys(words: list[list[bytes]], hashes: HashedWords):
    """Sorted distinct keys of the words (a document's start among them) and of
    the pairs of a chunk, and for each word of it, document by document, the
    places of the word, of the word before it and of the pair in them."""
    size = np.array([len(w) for w in words], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    h = np.empty(int(size.sum()) + len(words), np.uint64)
    first = np.zeros(len(h), bool)
    first[begin] = True
    h[first] = _START
    h[~first] = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, int(size.sum()))
    at = np.flatnonzero(~first)
    vocabulary, place = np.unique(h, return_inverse=True)
    pairs, pair = np.unique(_pairs(h)[at - 1], return_inverse=True)
    return vocabulary, pairs, place[at], place[at - 1], pair


def _counts(n: int, at: np.ndarray, mark: np.ndarray) -> list[np.ndarray]:
    return [np.bincount(at[mark], minlength=n), np.bincount(at, minlength=n)]


class Chunk:
    """Distinct words and pairs of a chunk's documents with their counts:
    target and all, of words also as history. ``rows``: (doc_id, text, mark)."""

    def __init__(self, rows: list[tuple], hashes: HashedWords):
        self.ids, self.marks = [r[0] for r in rows], [r[2] for r in rows]
        self.texts = [(r[1] or b"").split() for r in rows]
        words = [w for w in self.texts if w]
        none = np.zeros(0, np.uint64)
        self.keys = [none, none]
        self.counts = [np.zeros((4, 0), np.int64), np.zeros((2, 0), np.int64)]
        if words:
            vocabulary, pairs, self.word, self.before, self.pair = chunk_keys(words, hashes)
            mark = np.repeat(np.array([m for w, m in zip(self.texts, self.marks) if w], bool), [len(w) for w in words])
            n = len(vocabulary)
            self.keys = [vocabulary, pairs]
            self.counts = [np.stack(_counts(n, self.word, mark) + _counts(n, self.before, mark)),
                           np.stack(_counts(len(pairs), self.pair, mark))]

    def blobs(self, n_ranges: int) -> Iterator[tuple[int, bytes]]:
        """Range, and its words and pairs with their counts."""
        yield from _by_range(self.keys, self.counts, n_ranges)

    def add(self, n_ranges: int, answers: list[tuple[int, bytes]]) -> None:
        """Put what the other chunks hold on top of the own counts."""
        of = [ranges(k, n_ranges) for k in self.keys]
        for r, data in answers:
            at = 0
            for keys, counts in zip(of, self.counts):
                i, j = np.searchsorted(keys, (r, r + 1)).tolist()
                bits = np.frombuffer(data, np.uint8, -(-(j - i) // 8), at)
                which = np.flatnonzero(np.unpackbits(bits, count=j - i)) + i
                at += len(bits)
                for row in counts:
                    more, at = keyed._unsmall(data, len(which), at)
                    row[which] += more


def ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges each key lies in: ascending for sorted keys."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _by_range(keys: list[np.ndarray], counts: list[np.ndarray], n_ranges: int) -> Iterator[tuple[int, bytes]]:
    of = [ranges(k, n_ranges) for k in keys]
    for r in np.union1d(*of).tolist():
        body = []
        for k, c, o in zip(keys, counts, of):
            i, j = np.searchsorted(o, (r, r + 1)).tolist()
            # Words are history but at the end of a document: the difference is small.
            rows = [c[0, i:j], c[1, i:j], *(c[:2, i:j] - c[2:, i:j])] if len(c) == 4 else [c[0, i:j], c[1, i:j]]
            body.append(keyed.press(k[i:j], *rows))
        yield r, keyed.squeeze(b"".join(body))


def _unpack(data: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Words and pairs, and their (4, words) and (2, pairs) counts."""
    data, at, keys, counts = keyed.unsqueeze(data), 0, [], []
    for _ in range(2):
        k, c, at = keyed.unpress(data, at)
        c = np.stack(c)
        keys.append(k)
        counts.append(np.concatenate((c[:2], c[:2] - c[2:])) if len(c) == 4 else c)
    return keys, counts


def _sums(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sums by key over all parts, and each part's share of them."""
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros((counts[0].shape[0], len(distinct)), np.int64)
    for row, own in zip(total, np.concatenate(counts, axis=1)):
        # In doubles, exact to 2^53 occurrences of one key.
        row += np.bincount(inverse, weights=own, minlength=len(distinct)).astype(np.int64)
    return total, [total[:, i] for i in np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])]


def add_up(blobs: list[tuple[int, bytes]]) -> tuple[list[int], list[tuple[int, bytes]]]:
    """A range's figures (words in the vocabulary, target and all words, those
    outside the vocabulary), and for each chunk what the others add to its counts."""
    chunks = [c for c, _ in blobs]
    parts = [_unpack(data) for _, data in blobs]
    figures, answers = [], [[] for _ in chunks]
    for kind in (0, 1):
        own = [counts[kind] for _, counts in parts]
        total, shares = _sums([keys[kind] for keys, _ in parts], own)
        if not kind:
            few = total[0] < LEAST
            figures = [int((~few).sum()), *(int(x.sum()) for x in (*total[:2], *total[:2, few]))]
        for out, share, mine in zip(answers, shares, own):
            more = share - mine
            at = more.any(axis=0)
            out.append(np.packbits(at).tobytes() + b"".join(keyed._small(row[at]) for row in more))
            out.append(at.any())
    return figures, [(c, keyed.squeeze(a[0] + a[2])) for c, a in zip(chunks, answers) if a[1] or a[3]]


class Tables:
    """The two models' counts of a chunk's words, smoothed as they are looked up.

    The shared vocabulary is the words found ``LEAST`` times or more in the
    target documents; all others are one unknown word in either model, whose
    share in the target is that of the words seen once (Good and Turing). A
    document is scored without its own counts, so those that were counted
    as target and those that were not compare.

    ``word``, ``history``, ``pair``: target and background counts in the whole
    input; ``total``, ``unknown``: words, and words outside the vocabulary, of
    either model; ``size``: words in the vocabulary, the unknown one among them.
    """

    def __init__(self, word: np.ndarray, history: np.ndarray, pair: np.ndarray, total: list[float],
                 unknown: list[float], size: int):
        self.word, self.history, self.pair = word, history, pair
        self.total, self.unknown, self.size = total, unknown, size

    def losses(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray, is_target: bool) -> list[float]:
        """Mean loss per word under the target and the background model."""
        n = len(word)
        counts = []
        for tables, at in ((self.word, word), (self.history, before), (self.pair, pair)):
            _, inverse, own = np.unique(at, return_inverse=True, return_counts=True)
            own = own[inverse]
            counts.append([np.maximum(tables[0][at] - own * is_target, 0.0), np.maximum(tables[1][at] - own, 0.0)])
        known = counts[0][0] >= LEAST
        both = known & np.concatenate(([True], known[:-1]))
        left = [self.total[0] - n * is_target, self.total[1] - n]
        scale = left[0] / left[1] if left[0] > 0 and left[1] > 0 else 1.0
        out = []
        for m, by in ((0, 1.0), (1, scale)):
            total = max(left[m], 0.0) * by + MASS_WORD
            seen = np.where(known, counts[0][m] * by, self.unknown[m] * by)
            p = (seen + MASS_WORD / self.size) / total
            p = np.where(both, (counts[2][m] * by + MASS_PAIR * p) / (counts[1][m] * by + MASS_PAIR), p)
            out.append(float(-np.log(p).mean()))
        return out


_CHUNKS = "chunk bigint, part int, data binary"
_FIGURES = ("known", "target", "every", "target_unknown", "every_unknown")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.binary()))],
                                      names=["chunk", "part", "data"])


def _open(data: bytes) -> list[tuple]:
    """A chunk's (doc_id, text, mark) rows."""
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()
    return list(zip(*(c.to_pylist() for c in table.columns)))


def _gather_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, mark) rows in chunks, each of them compressed as one."""
    press = zstandard.ZstdCompressor(level=3)
    top, made = TaskContext.get().partitionId() << 32, 0
    rows, words, size = [], 0, 0

    def close() -> pa.RecordBatch:
        docs = pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.bool_())], names=["doc_id", "text", "mark"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as out:
            out.write_batch(docs)
        return _rows([(top + made, -1, press.compress(sink.getvalue()))])

    for batch in batches:
        for doc_id, text, mark in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            raw = text_bytes(text.as_py())
            rows.append((doc_id, raw, mark))
            words += raw.count(b" ") + 1
            size += len(raw)
            if words >= CHUNK_WORDS or size >= CHUNK_BYTES or len(rows) >= CHUNK_ROWS:
                yield close()
                made += 1
                rows, words, size = [], 0, 0
    if rows:
        yield close()


def _answers(chunks: DataFrame, parts: int, subs: int) -> DataFrame:
    """chunk, part (the range), data: what the other chunks add to a chunk's
    counts; figures of a range are in a row without a chunk."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.common import HashedWords
        from lakeloom.llm.xent import Chunk, _open

        hashes = HashedWords(17)
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(2)):
                yield _rows([(chunk, r, blob) for r, blob in Chunk(_open(data.as_py()), hashes).blobs(parts)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.xent import _by_range, _unpack

        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(2)):
                yield _rows([(chunk, r, blob) for r, blob in _by_range(*_unpack(data.as_py()), parts * subs)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.xent import add_up

        held: list[tuple[int, bytes]] = []
        last = None

        def close() -> pa.RecordBatch:
            figures, found = add_up(held)
            return _rows([(None, last, np.array(figures, "<i8").tobytes())] + [(c, last, data) for c, data in found])

        for batch in batches:
            for chunk, part, data in zip(*(c.to_pylist() for c in batch.columns)):
                if part != last and held:
                    yield close()
                    held = []
                last = part
                held.append((chunk, data))
        if held:
            yield close()

    df = chunks.mapInArrow(lean(split), _CHUNKS).repartitionById(parts, F.col("part"))
    if subs > 1:
        df = df.mapInArrow(lean(deal), _CHUNKS)
    return df.sortWithinPartitions("part").mapInArrow(lean(gather), _CHUNKS)


def _figures(answers: DataFrame) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(_FIGURES), np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += np.frombuffer(data.as_py(), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(total[i:i + 1]) for i in range(len(total))], names=list(_FIGURES))

    rows = answers.where("chunk IS NULL").select("data").mapInArrow(lean(run), ", ".join(f"{f} bigint" for f in _FIGURES))
    return list(rows.agg(*[F.coalesce(F.sum(f), F.lit(0)) for f in _FIGURES]).first())


def _marked(docs: DataFrame, targets: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, mark: whether the id is one of the targets'."""
    ids = columns(targets, of="doc_id").where("of IS NOT NULL").select(F.col("of").cast("bigint").alias("of")).distinct()
    ids = broadcast_if_small(ids.withColumn("of_salt", F.lit(0)), MOST_IDS)
    own = columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Rows without an id have no partner: a salt spreads them where the join is by a shuffle.
    own = own.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
                         .otherwise(F.lit(0)))
    joined = own.join(ids, (F.col("doc_id") == F.col("of")) & (F.col("salt") == F.col("of_salt")), "left")
    return joined.select("doc_id", "text", F.col("of").isNotNull().alias("mark"))


def score(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score, selected.

    ``targets``: the ids of the target documents in column ``doc_id``. Null and
    empty texts have no word: losses and score are null and they are not
    selected. Repeated rows count as often as they occur and score alike. With
    no target document the target model is the smoothing alone. An empty
    table gives no rows. A very long text is a chunk of its own and is scored
    whole; memory is a few times the longest text. Other columns of either
    input are not read, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    parts, subs = keyed.plan_ranges(partitions(spark), 3 * _input_bytes(docs), range_bytes)
    chunks = cut(_marked(docs, targets, id_col, text_col).mapInArrow(lean(_gather_chunks), _CHUNKS))
    answers = cut(_answers(chunks, parts, subs))
    figures = _figures(answers)
    total, unknown, size = [float(x) for x in figures[1:3]], [float(x) for x in figures[3:]], figures[0] + 1
    n_ranges = parts * subs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.common import HashedWords
        from lakeloom.llm.xent import Chunk, Tables, _open, keyed

        hashes = HashedWords(17)
        docs, answers, last = None, [], None

        def close() -> pa.RecordBatch:
            own = Chunk(_open(docs), hashes)
            own.add(n_ranges, answers)
            models = Tables(own.counts[0][:2], own.counts[0][2:], own.counts[1], total, unknown, size)
            n, target, every, at = [], [], [], 0
            for w, mark in zip(own.texts, own.marks):
                here = slice(at, at := at + len(w))
                n.append(len(w))
                t, b = models.losses(own.word[here], own.before[here], own.pair[here], mark) if w else (None, None)
                target.append(t)
                every.append(b)
            diff = [None if t is None else t - b for t, b in zip(target, every)]
            return pa.RecordBatch.from_arrays(
                [pa.array(own.ids, pa.int64()), pa.array(n, pa.int64()), pa.array(target, pa.float64()),
                 pa.array(every, pa.float64()), pa.array(diff, pa.float64()),
                 pa.array([d is not None and d < 0 for d in diff], pa.bool_())],
                names=["doc_id", "n_tokens", "target_loss", "background_loss", "score", "selected"])

        for batch in batches:
            for chunk, part, data in zip(*(c.to_pylist() for c in batch.columns)):
                if part < 0:
                    if last is not None:
                        yield close()
                    docs, answers, last = data, [], chunk
                    continue
                answers.append((part, keyed.unsqueeze(data)))
        if last is not None:
            yield close()

    rows = chunks.unionByName(answers.where("chunk IS NOT NULL")).repartition("chunk")
    return rows.sortWithinPartitions("chunk", "part").mapInArrow(
        lean(run), "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, "
                   "score double, selected boolean")


def training_fold(id_col: Column, fold: int = 2, folds: int = 4) -> Column:
    """Rows outside the held-out fold."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds != fold
