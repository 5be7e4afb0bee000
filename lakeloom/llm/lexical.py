"""Ranked lexical search by pipelined term partitioning.

The index is partitioned by terms: each term of the queries is owned by one of
a few stages, rarest terms first. A bundle holds the queries' sparse document
accumulators of one slice of the documents. It visits the stages one after
the other; at each, a cogroup brings it together with the postings that the
stage owns, and their integer contributions are added.

Accumulators are dropped only on proof: what the later stages can still add to
an item's scores is bounded by its terms' largest contributions, and the kth
best partial score found so far, over all slices, is a lower bound of the kth
best final score. What cannot reach it any more is dropped, and no new
accumulators begin once a document that holds none of the earlier terms cannot
reach it either. Ties with the bound stay.

Scale: items are taken in blocks of bounded size, and only a block's terms,
weights and bounds travel to the tasks. Documents are tokenised once a block;
what is shuffled are postings of the block's terms and accumulators, in slices
of at most ``SLICE_DOCS`` documents, whatever their number.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import columns, cut, lean, ship, text_bytes

SLICE_DOCS, SLICE_POSTINGS = 4096, 1_000_000
BLOCK_ITEMS, BLOCK_BYTES = 1000, 8 << 20
#: Shares of all postings, rarest terms first, at which the stages end.
STAGES = (1 / 64, 1 / 8, 1 / 2, 1.0)

# Bytes that are not part of a term become spaces; A-Z become a-z.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def norms(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """m of documents of ``n`` terms, in exact integers."""
    if len(n) and 90 * int(n.max()) * docs >= 1 << 63:
        return np.array([100 - 90 + 90 * int(x) * docs // total for x in n], np.int64)
    return 100 - 90 + 90 * n.astype(np.int64) * docs // total


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Slice:
    """A slice's documents and postings: of term ``terms[i]`` the documents
    ``doc[at[i]:at[i + 1]]`` (numbers in the slice) with ``tf`` likewise."""

    _HEAD = struct.Struct("<III")

    def __init__(self, ids, null, n, terms, sizes, doc, tf):
        self.ids, self.null, self.n = ids, null, n
        self.terms, self.doc, self.tf = terms, doc, tf
        self.sizes, self.at = sizes, np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))

    @classmethod
    def build(cls, ids: list, sizes: list[int], found: list[np.ndarray]) -> "Slice":
        """``found``: the numbers of the query terms of each document, with repeats."""
        per = np.fromiter(map(len, found), np.int64, len(found))
        code = np.concatenate(found).astype(np.int64) << 16 | np.repeat(np.arange(len(found)), per)
        code, tf = np.unique(code, return_counts=True)
        terms, size = np.unique(code >> 16, return_counts=True)
        return cls(np.array([i or 0 for i in ids], "<i8"), np.array([i is None for i in ids], "u1"),
                   np.array(sizes, "<i8"), terms.astype("<u4"), size.astype("<u4"),
                   (code & 0xFFFF).astype("<u2"), tf.astype("<u4"))

    def owned(self, mine: np.ndarray) -> "Slice":
        """Only the terms that are marked in ``mine``."""
        keep = mine[self.terms]
        each = np.repeat(keep, self.sizes)
        return Slice(self.ids, self.null, self.n, self.terms[keep], self.sizes[keep], self.doc[each], self.tf[each])

    def pack(self) -> bytes:
        body = b"".join(np.ascontiguousarray(x).tobytes() for x in (
            self.ids, self.n, self.null, self.terms, self.sizes, self.tf, self.doc))
        return zstandard.ZstdCompressor(level=1).compress(
            self._HEAD.pack(len(self.ids), len(self.terms), len(self.doc)) + body)

    @classmethod
    def unpack(cls, data: bytes) -> "Slice":
        data = zstandard.ZstdDecompressor().decompress(data)
        d, t, p = cls._HEAD.unpack_from(data)
        at, out = cls._HEAD.size, []
        for kind, size in (("<i8", d), ("<i8", d), ("u1", d), ("<u4", t), ("<u4", t), ("<u4", p), ("<u2", p)):
            out.append(np.frombuffer(data, kind, size, at))
            at += out[-1].nbytes
        ids, n, null, terms, sizes, tf, doc = out
        return cls(ids, null, n, terms, sizes, doc, tf)


class Block:
    """A block of items: their terms by number, and what the stages need."""

    def __init__(self, items: list[tuple]):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.terms = [np.array(sorted({self.vocabulary.setdefault(t, len(self.vocabulary)) for t in own}), np.int64)
                      for _, own in items]

    def plan(self, docs: int, total: int, df: np.ndarray, best: np.ndarray, shares) -> None:
        """Weights, owners and bounds, once the terms' counts are known."""
        self.docs, self.total = docs, total
        self.weight = np.array([weight(docs, int(x)) for x in df], np.int64)
        order = np.argsort(df, kind="stable")
        reached = np.cumsum(df[order]) / max(1, int(df.sum()))
        self.owner = np.empty(len(df), np.int64)
        self.owner[order] = np.minimum(np.searchsorted(np.array(shares), reached - 1e-12), len(shares) - 1)
        most = self.weight * best
        # What an item can gain at stage s and after it.
        self.bound = np.array([[int(most[t[self.owner[t] >= s]].sum()) for t in self.terms]
                               for s in range(len(shares) + 1)], np.int64).reshape(len(shares) + 1, len(self.terms))


def _pack_bundle(held: dict[int, tuple[np.ndarray, np.ndarray]]) -> bytes:
    items = np.array(sorted(held), "<u4")
    sizes = np.array([len(held[i][0]) for i in items.tolist()], "<u4")
    body = [items.tobytes(), sizes.tobytes()]
    body += [held[i][0].astype("<u2").tobytes() for i in items.tolist()]
    body += [held[i][1].astype("<i8").tobytes() for i in items.tolist()]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<I", len(items)) + b"".join(body))


def _unpack_bundle(data: bytes) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    data = zstandard.ZstdDecompressor().decompress(data)
    (k,) = struct.unpack_from("<I", data)
    items, sizes = np.frombuffer(data, "<u4", k, 4), np.frombuffer(data, "<u4", k, 4 + 4 * k).astype(np.int64)
    total = int(sizes.sum())
    at = np.concatenate(([0], np.cumsum(sizes)))
    doc = np.frombuffer(data, "<u2", total, 4 + 8 * k)
    score = np.frombuffer(data, "<i8", total, 4 + 8 * k + 2 * total)
    return {i: (doc[a:b], score[a:b]) for i, a, b in zip(items.tolist(), at[:-1].tolist(), at[1:].tolist())}


def advance(held: dict, own: Slice, block: Block, stage: int, floor: np.ndarray, k: int) -> dict:
    """A bundle's accumulators after the stage that owns ``own``'s terms.
    ``floor``: a lower bound of each item's kth best final score."""
    m = norms(own.n, block.docs, block.total)
    place = {t: i for i, t in enumerate(own.terms.tolist())}
    gains: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def gain(t: int):
        if t not in gains:
            part = slice(int(own.at[place[t]]), int(own.at[place[t] + 1]))
            doc = own.doc[part].astype(np.int64)
            gains[t] = doc, block.weight[t] * impacts(own.tf[part], m[doc])
        return gains[t]

    out = {}
    for item, terms in enumerate(block.terms):
        here = [t for t in terms.tolist() if block.owner[t] == stage and t in place and block.weight[t]]
        old = held.get(item)
        if not here and old is None:
            continue
        least = int(floor[item])
        if here and block.bound[stage][item] >= least:
            dense = np.zeros(len(own.ids), np.int64)
            if old is not None:
                dense[old[0]] = old[1]
            for t in here:
                doc, value = gain(t)
                dense[doc] += value
            doc = np.flatnonzero(dense)
            score = dense[doc]
        elif old is None:
            continue
        else:
            doc, score = old[0].astype(np.int64), old[1].copy()
            for t in here:
                at, value = gain(t)
                i = np.minimum(np.searchsorted(at, doc), len(at) - 1)
                score += np.where(at[i] == doc, value[i], 0)
        if len(score) >= k:
            least = max(least, int(np.partition(score, len(score) - k)[len(score) - k]))
        keep = score + block.bound[stage + 1][item] >= least
        if keep.any():
            out[item] = doc[keep], score[keep]
    return out


def _slices(docs: DataFrame, block: Block) -> DataFrame:
    """slice, data, docs, total: the block's postings in every slice, and the
    documents with a term and their terms counted in it."""
    vocabulary = block.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.lexical import Slice, terms_of

        top, made = TaskContext.get().partitionId() << 32, 0
        ids, sizes, found, held, n_docs, total = [], [], [], 0, 0, 0
        number = vocabulary.get

        def close() -> pa.RecordBatch:
            data = Slice.build(ids, sizes, found).pack() if ids else None
            return pa.RecordBatch.from_arrays(
                [pa.array([top + made]), pa.array([data], pa.binary()), pa.array([n_docs], pa.int64()),
                 pa.array([total], pa.int64())], names=["slice", "data", "docs", "total"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text_bytes(text.as_py()))
                if not words:
                    continue
                n_docs += 1
                total += len(words)
                own = np.array([x for x in map(number, words) if x is not None], np.uint32)
                if len(own):
                    ids.append(doc_id)
                    sizes.append(len(words))
                    found.append(own)
                    held += len(own)
                if len(ids) >= SLICE_DOCS or held >= SLICE_POSTINGS:
                    yield close()
                    made += 1
                    ids, sizes, found, held, n_docs, total = [], [], [], 0, 0, 0
        if n_docs:
            yield close()

    return docs.mapInArrow(lean(run), "slice bigint, data binary, docs bigint, total bigint")


def _term_figures(slices: DataFrame, n_terms: int, docs: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that hold each term, and its largest contribution."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.lexical import Slice, impacts, norms

        df, best = np.zeros(n_terms, np.int64), np.zeros(n_terms, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                own = Slice.unpack(data)
                df[own.terms] += own.sizes
                gain = impacts(own.tf, norms(own.n, docs, total)[own.doc])
                best[own.terms] = np.maximum(best[own.terms], np.maximum.reduceat(gain, own.at[:-1]))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen]), pa.array(best[seen])], names=["term", "df", "best"])

    rows = slices.select("data").mapInArrow(lean(run), "term bigint, df bigint, best bigint")
    df, best = np.zeros(n_terms, np.int64), np.zeros(n_terms, np.int64)
    for r in rows.groupBy("term").agg(F.sum("df").alias("df"), F.max("best").alias("best")).collect():  # the block's terms
        df[r.term], best[r.term] = r.df, r.best
    return df, best


def _floors(bundles: DataFrame, n_items: int, k: int) -> np.ndarray:
    """The kth best partial score of each item over all slices, 0 if fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.lexical import _unpack_bundle

        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for data in batch.column(0).to_pylist():
                for item, (_, score) in _unpack_bundle(data).items():
                    score = np.concatenate((best.get(item, score[:0]), score))
                    best[item] = np.sort(score)[-k:]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, s in best.items() for _ in s], pa.int64()),
             pa.array([x for s in best.values() for x in s.tolist()], pa.int64())], names=["item", "score"])

    ranked = bundles.select("data").mapInArrow(lean(run), "item bigint, score bigint").withColumn(
        "place", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"))))
    floor = np.zeros(n_items, np.int64)
    for r in ranked.where(F.col("place") == k).collect():  # a row per item of the block at most
        floor[r.item] = r.score
    return floor


def _owned(mine: np.ndarray):
    """The postings of the terms marked in ``mine``, slice by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.lexical import Slice

        for batch in batches:
            data = [Slice.unpack(d).owned(mine).pack() for d in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["slice", "data"])

    return run


def _visit(block: Block, stage: int, floor: np.ndarray, k: int, last: bool):
    """A slice's bundle (left, none at first) at the stage that owns the
    postings (right): the bundle that goes on, or after the last stage the
    ``k`` best documents of each item in the slice."""

    def visit(key, left: pa.Table, right: pa.Table) -> pa.Table:
        from lakeloom.llm.lexical import Slice, _pack_bundle, _unpack_bundle, advance

        own = Slice.unpack(right["data"][0].as_py())
        held = _unpack_bundle(left["data"][0].as_py()) if left.num_rows else {}
        held = advance(held, own, block, stage, floor, k)
        if not last:
            data = [_pack_bundle(held)] if held else []
            return pa.table({"slice": pa.array([key[0].as_py()] * len(data), pa.int64()), "data": pa.array(data, pa.binary())})
        rows = []
        for item, (doc, score) in held.items():
            order = np.lexsort((own.ids[doc], own.null[doc], -score))[:k]
            rows += [(item, block.ids[item], None if own.null[d] else int(own.ids[d]), s)
                     for d, s in zip(doc[order].tolist(), score[order].tolist()) if s > 0]
        cols = list(zip(*rows)) if rows else [()] * 4
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("item", "item_id", "doc_id", "score"), cols)})

    return visit


def _block(docs: DataFrame, block: Block, k: int, shares) -> DataFrame | None:
    slices = cut(_slices(docs, block))
    n_docs, total = slices.agg(F.sum("docs"), F.sum("total")).first()
    if not n_docs:
        return None
    slices = slices.where("data IS NOT NULL")
    block.plan(n_docs, total, *_term_figures(slices, len(block.vocabulary), n_docs, total), shares)
    block.vocabulary = {}
    bundles = docs.sparkSession.createDataFrame([], "slice bigint, data binary")
    floor = np.zeros(len(block.ids), np.int64)

    for stage in range(len(shares)):
        last = stage == len(shares) - 1
        postings = slices.select("slice", "data").mapInArrow(
            lean(_owned(block.owner == stage)), "slice bigint, data binary")
        schema = "item bigint, item_id bigint, doc_id bigint, score bigint" if last else "slice bigint, data binary"
        bundles = bundles.groupBy("slice").cogroup(postings.groupBy("slice")).applyInArrow(
            _visit(block, stage, floor, k, last), schema)
        if not last:
            bundles = cut(bundles)
            floor = np.maximum(floor, _floors(bundles, len(block.ids), k))

    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return cut(bundles.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
               .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def _items(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item_id and its distinct terms; rows that share an id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.lexical import terms_of

        for batch in batches:
            rows = [(i, t) for i, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for t in set(terms_of(text_bytes(text.as_py())))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()),
                                              pa.array([t for _, t in rows], pa.binary())], names=["item_id", "term"])

    own = columns(items, item_id=item_col, text=text_col).select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    return own.mapInArrow(lean(run), "item_id bigint, term binary").groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def rank(docs: DataFrame, items: DataFrame, k: int = 10, stages=STAGES, block_items: int = BLOCK_ITEMS,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents.

    Equal scores go by ascending doc_id, null ids last. Only scores above 0
    are returned. Null and empty texts have no terms: such documents do not
    count and such items have no rows. Every row of ``docs`` is a document of
    its own; rows of ``items`` that share an id (or have none) are one item of
    all their terms. An empty table on either side gives no rows. A very long
    text is tokenised whole and is a slice of its own; other columns are not
    read.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    done: list[DataFrame] = []

    def finish(held: list[tuple]) -> None:
        out = _block(texts, Block(held), k, stages) if held else None
        if out is not None:
            done.append(out)

    held, size = [], 0
    for row in _items(items, item_col, item_text).toLocalIterator():
        terms = [bytes(t) for t in row.terms]
        own = sum(map(len, terms))
        if held and (len(held) >= block_items or size + own > BLOCK_BYTES):
            finish(held)
            held, size = [], 0
        held.append((row.item_id, terms))
        size += own
    finish(held)
    if not done:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out
