"""Token ids on disk as Re-Pair grammars.

Documents are put in ascending id order (range partitions, sorted within) and
cut into shards of whole documents. In each shard frequent pairs of symbols
are replaced by nonterminals, round after round, until none is frequent: a
round counts adjacent pairs, gives every pair that is frequent enough a new
symbol and replaces its occurrences from left to right. Rounds after the first
count only pairs beside a new symbol. No pair crosses a document's end. A shard
holds the rules, the expansion length of every symbol and each document's
place among the symbols, so any range of ids is decoded from the few symbols
that cover it.

File format: Parquet rows, one per shard, written by Spark.

==============  ==========================================================
part, shard     range partition and number of the shard within it
before          ids of all shards before it in the partition
n_docs, n_ids   documents and ids (end ids included)
terminals       <u4, the token ids that the first symbols stand for
left, right     <u4, the two symbols of each further symbol, in order
lengths         <u4, expansion length of every symbol
symbols         ``width`` bytes each, end ids left out: <u2, <u4, or at three
                bytes all lower halves (<u2) and then all upper bytes (u1)
doc_symbols     <i8, symbols of each document
doc_ids         <i8, the documents' ids; no_id: u1, 1 where the id is null
==============  ==========================================================

``end_id`` is kept beside them. The end id closes each document and is not
among the symbols.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import columns, gather, lean, partitions, ship

SHARD_IDS = 4_000_000
LEAST = 16
_SLOT_BITS = 19

SHARDS = ("part bigint, shard bigint, before bigint, n_docs bigint, n_ids bigint, width int, end_id bigint, "
          "terminals binary, left binary, right binary, lengths binary, symbols binary, "
          "doc_symbols binary, doc_ids binary, no_id binary")


def _slots(codes: np.ndarray) -> np.ndarray:
    slots = codes.astype(np.uint64)
    slots *= np.uint64(0x9E3779B97F4A7C15)
    slots >>= np.uint64(64 - _SLOT_BITS)
    return slots.view(np.int64)


def _codes(x: np.ndarray, k: int, at: np.ndarray) -> np.ndarray:
    """The pairs that begin at places ``at``, each as one number."""
    kind = np.uint32 if k <= 1 << 16 else np.uint64
    if 4 * len(at) < len(x):
        return x[at].astype(kind) * kind(k) + x[at + 1]
    every = x[:-1].astype(kind)
    every *= kind(k)
    every += x[1:]
    return every if len(at) == len(every) else every[at]


def _frequent(codes: np.ndarray, least: int) -> np.ndarray:
    """Codes that occur ``least`` times or more, ascending."""
    s = np.sort(codes)
    at = np.flatnonzero(np.concatenate((s[:1] == s[:1], s[1:] != s[:-1])))
    return s[at[np.diff(np.append(at, len(s))) >= least]]


def _places(codes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each code among the distinct ``keys``, -1 if it is none. Only
    codes that share a slot of a hash table with a key are looked up."""
    taken = np.zeros(1 << _SLOT_BITS, bool)
    taken[_slots(keys)] = True
    at = np.flatnonzero(taken[_slots(codes)])
    out = np.full(len(codes), -1, np.int32)
    found = pc.index_in(pa.array(codes[at]), value_set=pa.array(keys.astype(codes.dtype)))
    out[at] = found.fill_null(-1).to_numpy()
    return out


def compress(docs: list[np.ndarray], least: int = LEAST) -> dict[str, np.ndarray]:
    """The Re-Pair grammar of a shard: ``docs`` are id arrays without end ids.

    Rounds go on until no pair of neighbours occurs ``least`` times. After a
    round that replaced every frequent pair only pairs with a new symbol can be
    frequent, so only those are counted; the last word has a count of all.
    """
    sizes = np.array([len(d) for d in docs], np.int64)
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    seen = np.zeros(int(ids.max()) + 1 if len(ids) else 1, bool)
    seen[ids] = True
    terminals = np.flatnonzero(seen).astype(np.uint32)
    dense = np.zeros(len(seen), np.uint32)
    dense[terminals] = np.arange(len(terminals), dtype=np.uint32)
    x = dense[ids]
    last = np.zeros(len(x), bool)  # the last symbol of a document
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    left, right = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
    lengths = [np.ones(len(terminals), np.uint32)]
    k, base, complete = len(terminals), 0, True
    while len(x) > 1:
        inner = ~last[:-1]
        if base:
            new = x >= base
            inner &= new[:-1] | new[1:]
        at = np.flatnonzero(inner)
        code = _codes(x, k, at)
        found = _frequent(code, least)
        if not len(found):
            if complete:
                break
            base, complete = 0, True
            continue
        place = _places(code, found)
        hit = np.flatnonzero(place >= 0)
        place, hit = place[hit], at[hit]
        found = found.astype(np.uint64)
        # Overlapping occurrences: every other one of a run, from its left end.
        first = np.concatenate(([True], np.diff(hit) > 1))
        take = ((hit - np.maximum.accumulate(hit * first)) & 1) == 0
        place, hit = place[take], hit[take]
        # A rule that its neighbours left fewer than two places is none.
        uses = np.bincount(place, minlength=len(found))
        rule = np.cumsum(uses > 1) - 1
        good = uses[place] > 1
        place, hit = place[good], hit[good]
        found = found[uses > 1]
        if not len(found):
            if complete and not base:
                break
            base, complete = 0, True
            continue
        a, b = (found // np.uint64(k)).astype(np.uint32), (found % np.uint64(k)).astype(np.uint32)
        left.append(a)
        right.append(b)
        own = np.concatenate(lengths)
        lengths = [own, own[a] + own[b]]
        x[hit] = (k + rule[place]).astype(np.uint32)
        last[hit] = last[hit + 1]
        keep = np.ones(len(x), bool)
        keep[hit + 1] = False
        keep = np.flatnonzero(keep)
        x, last = x[keep], last[keep]
        base, k, complete = k, k + len(found), False
    doc_symbols = np.zeros(len(sizes), np.int64)
    doc_symbols[sizes > 0] = np.diff(np.flatnonzero(last), prepend=-1)
    return {"terminals": terminals, "left": np.concatenate(left), "right": np.concatenate(right),
            "lengths": np.concatenate(lengths), "symbols": x, "doc_symbols": doc_symbols}


def expansions(terminals: np.ndarray, left: np.ndarray, right: np.ndarray,
               lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All symbols' ids in one array, and where each symbol's begin."""
    at = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    flat = np.zeros(int(at[-1]), np.uint32)
    base, done = len(terminals), 0
    flat[:base] = terminals
    # Rules that use only symbols before them are expanded at once.
    needs = np.maximum.accumulate(np.maximum(left, right))
    while done < len(left):
        upto = int(np.searchsorted(needs, base + done))
        both = np.stack((left[done:upto], right[done:upto]), 1).ravel()
        flat[at[base + done]:at[base + upto]] = gather(flat, at[both], lengths[both])
        done = upto
    return flat, at


def pack_symbols(symbols: np.ndarray, width: int) -> bytes:
    if width == 3:
        return (symbols & 0xFFFF).astype("<u2").tobytes() + (symbols >> 16).astype("u1").tobytes()
    return symbols.astype(f"<u{width}").tobytes()


def unpack_symbols(data: bytes, width: int) -> np.ndarray:
    if width == 3:
        n = len(data) // 3
        return np.frombuffer(data, "<u2", n).astype(np.uint32) | np.frombuffer(data, "u1", n, 2 * n).astype(np.uint32) << 16
    return np.frombuffer(data, f"<u{width}")


class Shard:
    """A shard read back: whole documents, or any range of a document's ids."""

    def __init__(self, row: dict):
        u4 = lambda k: np.frombuffer(row[k], "<u4")
        self.lengths, self.end_id = u4("lengths"), row["end_id"]
        self.flat, self.at = expansions(u4("terminals"), u4("left"), u4("right"), self.lengths)
        self.symbols = unpack_symbols(row["symbols"], row["width"])
        self.stops = np.concatenate(([0], np.cumsum(np.frombuffer(row["doc_symbols"], "<i8"))))
        self.n_docs = row["n_docs"]

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.at[symbols], self.lengths[symbols])

    def document(self, i: int) -> np.ndarray:
        body = self._expand(self.symbols[self.stops[i]:self.stops[i + 1]])
        return np.append(body, self.end_id).astype("<u4")

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents one after the other, and how many each has."""
        # The end id as one more symbol behind each document's own.
        symbols = np.insert(self.symbols.astype(np.uint32), self.stops[1:], len(self.lengths))
        n = np.append(self.lengths, np.uint32(1))[symbols]
        out = gather(np.append(self.flat, np.uint32(self.end_id)), self.at[symbols], n)
        ends = np.cumsum(n, dtype=np.int64)[self.stops[1:] + np.arange(len(self.stops) - 1)]
        return out.astype("<u4", copy=False), np.diff(ends, prepend=0)

    def slice(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of document ``i``, from the symbols that cover them."""
        own = self.symbols[self.stops[i]:self.stops[i + 1]]
        ends = np.cumsum(self.lengths[own], dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        start, stop = max(0, start), min(stop, total + 1)
        if start >= stop:
            return np.zeros(0, "<u4")
        a = int(np.searchsorted(ends, start, "right"))
        b = int(np.searchsorted(ends, min(stop, total), "left")) + 1
        skipped = int(ends[a - 1]) if a else 0
        body = self._expand(own[a:b])[start - skipped:stop - skipped] if start < total else np.zeros(0, np.uint32)
        return (np.append(body, self.end_id) if stop > total else body).astype("<u4")


def write(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
          shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as grammar shards under ``path``.

    A null or empty text is its end id alone; null ids come first; rows that
    share an id stand next to each other; an empty table writes no shards.
    A shard is closed once it holds ``shard_ids`` ids, so it is larger only
    where one document is.
    """
    spark = docs.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.repair import compress, pack_symbols
        from lakeloom.llm.tokens import encoder

        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        ids, texts, held, shard, before = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            g = compress(texts)
            width = 2 if len(g["lengths"]) <= 1 << 16 else 3 if len(g["lengths"]) <= 1 << 24 else 4
            row = {"part": part, "shard": shard, "before": before, "n_docs": len(ids), "n_ids": held,
                   "width": width, "end_id": end_id} | {k: g[k].astype("<u4").tobytes() for k in ("terminals", "left", "right", "lengths")}
            row["symbols"] = pack_symbols(g["symbols"], width)
            row["doc_symbols"] = g["doc_symbols"].astype("<i8").tobytes()
            row["doc_ids"] = np.array([i or 0 for i in ids], "<i8").tobytes()
            row["no_id"] = bytes(i is None for i in ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int32() if k == "width" else pa.int64())
                 for k, v in row.items()], names=list(row))

        try:
            for batch in batches:
                for doc_id, x in zip(batch.column(0).to_pylist(), enc.many(t.as_py() for t in batch.column(1))):
                    ids.append(doc_id)
                    texts.append(x)
                    held += len(x) + 1
                    if held >= shard_ids:
                        yield close()
                        ids, texts, held, shard, before = [], [], 0, shard + 1, before + held
            if ids:
                yield close()
        finally:
            enc.rest()

    df = columns(docs, doc_id=id_col, text=text_col)
    df = df.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    df.mapInArrow(lean(run), SHARDS).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the
    files. ``start`` counts the ids of all documents before it."""
    ship(spark)
    shards = spark.read.schema(SHARDS).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.repair import Shard

        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                ids = np.frombuffer(row["doc_ids"], "<i8")
                null = np.frombuffer(row["no_id"], "u1").astype(bool)
                own, n = shard.documents()
                stops = np.cumsum(n)
                crc = np.array([zlib.crc32(own[a:b]) for a, b in zip((stops - n).tolist(), stops.tolist())], np.int64)
                start = row["before"] + stops - n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=null), pa.array(start), pa.array(n), pa.array(crc),
                     pa.array(np.full(shard.n_docs, row["part"]))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "part"])

    out = shards.mapInArrow(lean(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, part bigint")
    return out.join(totals, F.col("part") == F.col("of")).select(
        "doc_id", (F.col("start") + F.col("ahead")).alias("start"), "n_tokens", "ids_crc32")
