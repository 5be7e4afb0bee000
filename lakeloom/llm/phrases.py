"""Collocations by Rabin-Karp fingerprints of all n-grams.

Texts are cut into pieces at punctuation and line ends and into words. Each
chunk of texts hashes all its n-grams at once: with prefix polynomials
``S[i] = sum(h[j] * B**-j, j < i)`` modulo 2^64 the fingerprint of the n words
from ``i`` is ``(S[i + n] - S[i]) * B**(i + n - 1)``. A chunk sends its distinct
fingerprints with their counts, sorted and as differences; a pointer to their
occurrences is the chunk and the place in its order. Each range of
fingerprints adds up the counts and points back to the chunks where a frequent
one occurs.

The chunks then compare the text of all occurrences of those fingerprints, so
that different n-grams under one fingerprint part, and only the frequent ones
become phrases with their words. Their exact counts are added once more by
text, so fingerprints decide nothing but what is looked at: a phrase that is
frequent has a frequent fingerprint.

Scale: what travels is a fingerprint per distinct n-gram and chunk (some four
bytes) and twice the compressed text; a frequent n-gram is one entry a chunk.
Ranges grow in number with the input: a chunk writes at most
``keyed.MOST_PARTITIONS`` blobs, and each of those partitions deals its blobs out to
as many smaller ranges as it needs, through Spark's sort.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm import keyed
from lakeloom.llm.common import columns, cut, lean, partitions, ship, text_bytes
from lakeloom.llm.substrings import _input_bytes

LONGEST, LEAST, COVERED, TOP = 3, 10, 50, 2000
CHUNK_WORDS, CHUNK_BYTES, CHUNK_ROWS = 1_500_000, 12 << 20, 50_000
RANGE_BYTES = 48 << 20
SALTS = 8
BITS = 48
_B = 0x9E3779B97F4A7C15
_BACK = pow(_B, -1, 1 << 64)

# Separators become full stops, A-Z become a-z.
_TABLE = bytes(0x2E if b in b".,;:!?\n\v\f\r" else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_END = re.compile(rb"[.,;:!?\x0A-\x0D]")


def stretches(text: bytes, most: int = CHUNK_BYTES) -> Iterator[bytes]:
    """A text in stretches of about ``most`` bytes, cut at separators only."""
    at = 0
    while len(text) - at > most:
        end = _END.search(text, at + most)
        if end is None:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


def tokens(text: bytes) -> list[bytes]:
    """Words, with a full stop at each end of a piece."""
    return text.translate(_TABLE).replace(b".", b" . ").split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Chunk:
    """The n-grams of a chunk of (language, text) rows, ``languages`` by number."""

    def __init__(self, rows: list[tuple[str, bytes]]):
        number = _Numbers({b".": 0})
        langs: dict[str, int] = {}
        ids, lang = [], []
        for name, text in rows:
            own = np.fromiter(map(number.__getitem__, tokens(text)), np.int64)
            ids += [own, np.zeros(1, np.int64)]
            lang.append((langs.setdefault(name, len(langs)), len(own) + 1))
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        self.lang = np.repeat(np.array([k for k, _ in lang], np.int64), np.array([n for _, n in lang], np.int64))
        self.languages, self.words = list(langs), list(number)
        self.is_word = self.ids != 0
        counts = np.bincount(self.lang[self.is_word], minlength=len(langs))
        self.totals = dict(zip(self.languages, counts.tolist()))
        n = len(self.ids)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        power = np.full(n + LONGEST, _B, np.uint64)
        power[:1] = 1
        self.power = np.cumprod(power, dtype=np.uint64)
        power[1:] = _BACK
        back = np.cumprod(power[:n], dtype=np.uint64)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes[self.ids] * back, dtype=np.uint64, out=self.prefix[1:])
        self.salt = np.fromiter((xxhash.xxh64_intdigest(x.encode(), 1) for x in self.languages), np.uint64, len(langs))

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all n-grams of ``size`` words, and their fingerprints."""
        n = len(self.ids) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        inner = self.is_word[:n].copy()
        for k in range(1, size):
            inner &= self.is_word[k:n + k]
        at = np.flatnonzero(inner)
        x = (self.prefix[at + size] - self.prefix[at]) * self.power[at + size - 1]
        x = (x ^ (x >> np.uint64(29)) ^ self.salt[self.lang[at]] ^ np.uint64(size)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return at, x >> np.uint64(64 - BITS)

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct fingerprints of all n-grams, ascending, and their counts."""
        x = np.concatenate([self.grams(size)[1] for size in range(1, LONGEST + 1)])
        x.sort()
        at = np.flatnonzero(np.concatenate((x[:1] == x[:1], x[1:] != x[:-1])))
        return x[at], np.diff(np.append(at, len(x)))

    def phrases(self, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
        """Size, languages by number, words and counts of the n-grams with a
        fingerprint of ``wanted`` (ascending). All occurrences under one
        fingerprint are compared with the first; those that differ come one by one."""
        if not len(wanted):
            return
        words = pa.array(self.words, pa.binary())
        near = np.zeros(1 << 22, bool)  # keeps most other fingerprints from being looked up
        near[(wanted & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        for size in range(1, LONGEST + 1):
            at, x = self.grams(size)
            maybe = near[(x & np.uint64((1 << 22) - 1)).astype(np.int64)]
            at, x = at[maybe], x[maybe]
            hit = wanted[np.minimum(np.searchsorted(wanted, x), len(wanted) - 1)] == x
            at, x = at[hit], x[hit]
            _, first, which = np.unique(x, return_index=True, return_inverse=True)
            model = at[first][which]
            same = self.lang[at] == self.lang[model]
            for k in range(size):
                same &= self.ids[at + k] == self.ids[model + k]
            counts = np.concatenate((np.bincount(which[same], minlength=len(first)), np.ones(int((~same).sum()), np.int64)))
            at = np.concatenate((at[first], at[~same]))
            text = [words.take(pa.array(self.ids[at + k])) for k in range(size)]
            text = text[0] if size == 1 else pc.binary_join_element_wise(*text, b" ")
            yield size, self.lang[at], text, counts


def press(keys: np.ndarray, counts: np.ndarray) -> bytes:
    return keyed.squeeze(keyed.press(keys, counts))


def unpress(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys, (counts,), _ = keyed.unpress(keyed.unsqueeze(data))
    return keys, counts


def ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges each key lies in."""
    return (keys * np.uint64(n)) >> np.uint64(BITS)


def add_up(blobs: list[tuple[int, bytes]], least: int) -> Iterator[tuple[int, bytes]]:
    """chunk -> a bit for each of its keys, in their order: whether the counts
    of the key over all chunks reach ``least``. Chunks without one are left out."""
    parts = [(chunk, *unpress(data)) for chunk, data in blobs]
    _, which = np.unique(np.concatenate([k for _, k, _ in parts]), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate([c for *_, c in parts]))
    keep = (total >= least)[which]
    at = 0
    for chunk, keys, _ in parts:
        own = keep[at:at + len(keys)]
        at += len(keys)
        if own.any():
            yield chunk, np.packbits(own).tobytes()


def marked(keys: np.ndarray, n_ranges: int, answers: list[tuple[int, bytes]]) -> np.ndarray:
    """The keys of a chunk that its ``answers``, (range, bits), mark."""
    edges = np.searchsorted(ranges(keys, n_ranges), np.array([r for r, _ in answers], np.uint64)[:, None]
                            + np.array([0, 1], np.uint64)).tolist()
    bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=j - i).view(bool) for (_, b), (i, j) in zip(answers, edges)]
    return np.concatenate([keys[i:j][m] for m, (i, j) in zip(bits, edges)]) if answers else keys[:0]


def _pack_rows(rows: list[tuple[str, bytes]]) -> bytes:
    batch = pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())],
                            names=["lang", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _unpack_rows(data: bytes) -> list[tuple[str, bytes]]:
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()
    return list(zip(table["lang"].to_pylist(), table["text"].to_pylist()))


#: part or range, whether data are a chunk's texts, chunk, data
_SENT = "part int, texts boolean, chunk bigint, data binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.bool_(), pa.int64(), pa.binary()))],
                                      names=["part", "texts", "chunk", "data"])


def _split(parts: int):
    """Chunks of (lang, text) rows: their texts and their fingerprints by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.phrases import Chunk, _pack_rows, press, ranges, stretches

        top, made = TaskContext.get().partitionId() << 32, 0
        rows, words, size = [], 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            chunk = top + made
            yield _rows([(chunk % parts, True, chunk, _pack_rows(rows))])
            keys, counts = Chunk(rows).fingerprints()
            edges = np.searchsorted(ranges(keys, parts), np.arange(parts + 1))
            for a in range(0, parts, 256):
                yield _rows([(p, False, chunk, press(keys[i:j], counts[i:j]))
                             for p in range(a, min(a + 256, parts)) if (i := edges[p]) < (j := edges[p + 1])])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for piece in stretches(text_bytes(text.as_py())):
                    rows.append(("und" if lang is None else lang, piece))
                    words += piece.count(b" ") + 1
                    size += len(piece)
                    if words >= CHUNK_WORDS or size >= CHUNK_BYTES or len(rows) >= CHUNK_ROWS:
                        yield from close()
                        made += 1
                        rows, words, size = [], 0, 0
        if rows:
            yield from close()

    return run


def _deal(parts: int, subs: int):
    """Blobs of a part, dealt out to its ranges; a few blobs at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.phrases import press, ranges, unpress

        for batch in batches:
            for part, texts, chunk, data in zip(*(c.to_pylist() for c in batch.columns)):
                if texts:
                    yield _rows([(part, True, chunk, data)])
                    continue
                keys, counts = unpress(data)
                own = ranges(keys, parts * subs).astype(np.int64)
                edges = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
                yield _rows([(int(own[i]), False, chunk, press(keys[i:j], counts[i:j])) for i, j in zip(edges, edges[1:])])

    return run


def _gather(least: int):
    """Texts as they are; of the blobs of each range what its chunks shall look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.phrases import add_up

        held: list[tuple[int, bytes]] = []
        last = None

        def close() -> pa.RecordBatch:
            return _rows([(last, False, chunk, bits) for chunk, bits in add_up(held, least)])

        for batch in batches:
            for part, texts, chunk, data in zip(*(c.to_pylist() for c in batch.columns)):
                if texts:
                    yield _rows([(part, True, chunk, data)])
                    continue
                if part != last and held:
                    yield close()
                    held = []
                last = part
                held.append((chunk, data))
        if held:
            yield close()

    return run


def _materialise(n_ranges: int):
    """The phrases of each chunk; words of each language have size 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.phrases import Chunk, _unpack_rows, marked

        texts, answers, last = None, [], None

        def rows(lang: pa.Array, size: int, text: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [lang, pa.array(np.full(len(lang), size, np.int32)), text.cast(pa.string()), pa.array(counts, pa.int64())],
                names=["lang", "size", "phrase", "n"])

        def close() -> Iterator[pa.RecordBatch]:
            own = Chunk(_unpack_rows(texts))
            names = pa.array(own.languages, pa.string())
            yield rows(names, 0, pa.array([b""] * len(names), pa.binary()), np.array([own.totals[x] for x in own.languages]))
            wanted = marked(own.fingerprints()[0], n_ranges, sorted(answers))
            for size, lang, text, counts in own.phrases(wanted):
                for a in range(0, len(text), 100_000):
                    part = slice(a, a + 100_000)
                    yield rows(names.take(pa.array(lang[part])), size, text[part], counts[part])

        for batch in batches:
            for part, is_text, chunk, data in zip(*(c.to_pylist() for c in batch.columns)):
                if chunk != last:
                    if last is not None:
                        yield from close()
                    texts, answers, last = None, [], chunk
                if is_text:
                    texts = data
                else:
                    answers.append((part, data))
        if last is not None:
            yield from close()

    return run


def frequent(docs: DataFrame, least: int = LEAST, range_bytes: int = RANGE_BYTES,
             lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, size, phrase, n of all n-grams of 1 to 3 words found ``least``
    times or more; rows of size 0 have the words of each language.

    Null languages are ``und``; null and empty texts have no words. Repeated
    rows count as often as they occur. Texts longer than a chunk are cut at
    separators, which no n-gram crosses.
    """
    spark = docs.sparkSession
    ship(spark)
    parts, subs = keyed.plan_ranges(partitions(spark), 4 * _input_bytes(docs), range_bytes)
    df = columns(docs, lang=lang_col, text=text_col).mapInArrow(lean(_split(parts)), _SENT).repartitionById(parts, F.col("part"))
    if subs > 1:
        df = df.mapInArrow(lean(_deal(parts, subs)), _SENT)
    df = df.sortWithinPartitions("texts", "part").mapInArrow(lean(_gather(least)), _SENT)
    df = df.select("part", "texts", "chunk", "data").repartition("chunk").sortWithinPartitions("chunk", "texts")
    df = df.mapInArrow(lean(_materialise(parts * subs)), "lang string, size int, phrase string, n bigint")
    return df.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("size") == 0))


def exact_score(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)) in exact integers, for counts below 10^16."""
    wide = "CAST({} AS DECIMAL(16, 0))".format
    return f"(({wide(a)} * {wide(a)} * 1000000) div ({wide(left)} * {wide(right)}))"


def collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase's score is its lowest over all cuts, the smallest cut among equal
    ones. Phrases inside a longer one with ``covered`` percent of their count
    or more are dropped. Ties go by count, then by the phrase's bytes. Inputs
    without a frequent phrase, and empty tables, give no rows. Other columns
    are not read. See ``frequent`` for nulls, repeated rows and long texts.
    """
    found = cut(frequent(docs, least, lang_col=lang_col, text_col=text_col))
    words = found.where("size = 0").select(F.col("lang").alias("of"), F.col("n").alias("total"))
    named = found.where("size > 0").select("lang", "size", "phrase", F.col("n").alias("a"))
    # Frequent words begin or end a large share of the phrases: as parts, words are salted.
    salts = F.sequence(F.lit(0), F.when(F.col("size") == 1, F.lit(SALTS - 1)).otherwise(F.lit(0)))
    parts = named.select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("a").alias("part_n"),
                         F.explode(salts).alias("part_salt"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = named.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
    for side, count, words_in in (("head", "l", F.col("k")), ("tail", "r", F.col("size") - F.col("k"))):
        cuts = cuts.withColumn("salt", F.when(words_in == 1, salt).otherwise(F.lit(0)))
        cuts = cuts.join(parts, (F.col("lang") == F.col("part_lang")) & (F.col(side) == F.col("part"))
                         & (F.col("salt") == F.col("part_salt"))).drop("part_lang", "part", "part_salt", "salt")
        cuts = cuts.withColumnRenamed("part_n", count)
    cuts = cuts.withColumn("score", F.expr(exact_score("a", "l", "r")))
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    longer = named.where("size > 2").select(
        "lang", "a", F.explode(F.expr(
            "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
            "s -> array_join(slice(split(phrase, ' '), s, m), ' '))))")).alias("inside"))
    longer = longer.groupBy("lang", "inside").agg(F.max("a").alias("around")).withColumnRenamed("lang", "long_lang")
    kept = scored.join(longer, (F.col("lang") == F.col("long_lang")) & (F.col("phrase") == F.col("inside")), "left").where(
        F.col("around").isNull() | (100 * F.col("around") < covered * F.col("a")))
    # A language may hold most phrases: the best of each of its shares first, then the best of these.
    best = [F.desc("best.score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase", F.lit(1)), F.lit(2 * SALTS))
    ranked = kept.withColumn("share", share)
    for keys in (["lang", "share"], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(words, F.col("lang") == F.col("of")).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "best.l", "best.r",
        F.col("total").alias("n"), "best.score")
