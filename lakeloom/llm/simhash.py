"""SimHash near-duplicates by anchor-point covering.

Every text gets a 64-bit fingerprint. Two fingerprints that differ in at most
three bits differ in at most one bit in one of their 32-bit halves, so each
half is searched for distance one. The anchors of a half are the codewords of
the binary Hamming code of length 31 (the half's top bit is left out): a
perfect covering code, in which every word lies within radius R = 1 of exactly
one codeword, its home. A fingerprint goes to every anchor within R + 1 = 2 of
it, its home and fifteen others. A neighbour x of y (one bit apart) has its
home within 2 of y, so the two meet there; they are then compared on all 64
bits. With 2 x 2^26 anchors, fingerprints that are not near each other seldom
meet.

Only distinct fingerprints take part. An anchor passes on a spanning forest
of the links among its fingerprints, not the links themselves, and finds it
by growing one component at a time against the fingerprints not yet reached,
so a dense group of n costs about n comparisons and n - 1 rows, not n^2.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import columns, cut, lean, ship, text_bytes
from lakeloom.operators.joins import broadcast_if_small

SHINGLE, MAX_BITS = 3, 3
#: Rows that go are broadcast up to so many (24 bytes each).
MOST_ROWS = 1_000_000
_SEED = 42
_LOW31 = (1 << 31) - 1


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text: a bit is 1 if set in over half the shingle
    hashes. Fewer words than a shingle make one shingle; no word makes 0."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    n = len(words)
    if n < shingle:
        return xxhash.xxh64_intdigest(flat, _SEED)
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:n - shingle + 1].tolist()
    end = end[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for a in range(0, len(start), 65536):
        h = np.array([digest(flat[s:e], _SEED) for s, e in zip(start[a:a + 65536], end[a:a + 65536])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(start), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp as a signed 64-bit integer."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.simhash import fingerprint

        for batch in batches:
            fp = np.array([fingerprint(text_bytes(t.as_py()), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "fp"])

    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(lean(run), "doc_id bigint, fp bigint")


def _syndrome(v: Column) -> Column:
    """Position (1 to 31) of the bit that separates v from its codeword, or 0."""
    out = F.lit(0)
    for b in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> b & 1)
        out = out + F.shiftleft(F.bit_count(v.bitwiseAND(F.lit(mask))) % 2, b)
    return out


def anchors(fps: DataFrame) -> DataFrame:
    """(anchor, fp, home) of every fingerprint in ``fp``: up to 16 anchors for
    each half. The flag marks the home."""
    halves = F.array(*[
        F.struct(F.lit(h).cast("bigint").alias("half"),
                 F.shiftrightunsigned("fp", 32 * h).bitwiseAND(F.lit(_LOW31)).alias("v")) for h in (0, 1)])
    df = fps.select("fp", F.explode(halves).alias("x")).select("fp", "x.half", "x.v")
    df = df.withColumn("s", _syndrome(F.col("v")).cast("int"))
    flip = lambda p: F.expr(f"shiftleft(1L, {p} - 1)")
    home = F.when(F.col("s") == 0, F.col("v")).otherwise(F.col("v").bitwiseXOR(flip("s")))
    # Two flipped bits i < j reach a codeword if i xor j is the syndrome.
    others = F.expr(
        "transform(filter(sequence(1, 31), i -> s <> 0 AND i < (i ^ s)), "
        "i -> v ^ shiftleft(1L, i - 1) ^ shiftleft(1L, (i ^ s) - 1))")
    spots = F.concat(F.array(F.struct(home.alias("code"), F.lit(True).alias("home"))),
                     F.transform(others, lambda c: F.struct(c.alias("code"), F.lit(False).alias("home"))))
    df = df.select("fp", "half", F.explode(spots).alias("a"))
    return df.select((F.shiftleft("half", 31) + F.col("a.code")).alias("anchor"), "fp", F.col("a.home").alias("home"))


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph that links values at most
    ``max_bits`` bits apart."""
    pool = fps
    heads, tails = [], []
    while len(pool) > 1:
        queue, pool = [pool[0]], pool[1:]
        while queue and len(pool):
            x = queue.pop()
            near = np.bitwise_count(pool ^ x) <= max_bits
            if near.any():
                found = pool[near]
                heads.append(np.full(len(found), x))
                tails.append(found)
                queue.extend(found)
                pool = pool[~near]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(heads) if heads else none), (np.concatenate(tails) if tails else none)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): links that connect whatever links of up to three bits connect.
    Input: distinct fingerprints in column ``fp``."""
    if max_bits != 3:
        raise ValueError("the halves' code is laid out for a distance of 3 bits")
    spark = fps.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.simhash import forest

        def edges(a: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
            size = np.diff(np.append(at, len(a)))
            homes = np.add.reduceat(home.astype(np.int64), at)
            us, vs = [], []
            for i in np.flatnonzero((size > 1) & (homes > 0)).tolist():
                u, v = forest(np.unique(fp[at[i]:at[i] + size[i]]), max_bits)
                us.append(u)
                vs.append(v)
            u = np.concatenate(us) if us else np.zeros(0, np.uint64)
            v = np.concatenate(vs) if vs else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        held: list[tuple] = []  # the rows of one anchor so far, at the end of what was read
        for batch in batches:
            if not batch.num_rows:
                continue
            a = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy().view(np.uint64)
            home = batch.column(2).to_numpy(zero_copy_only=False)
            if held and held[-1][0][-1] == a[-1] and a[0] == a[-1]:
                held.append((a, fp, home))
                continue
            held.append((a, fp, home))
            a, fp, home = (np.concatenate(x) for x in zip(*held))
            cut_at = int(np.searchsorted(a, a[-1]))
            held = [(a[cut_at:], fp[cut_at:], home[cut_at:])]
            if cut_at:
                yield edges(a[:cut_at], fp[:cut_at], home[:cut_at])
        if held:
            yield edges(*(np.concatenate(x) for x in zip(*held)))

    met = anchors(fps).repartition("anchor").sortWithinPartitions("anchor")
    return met.mapInArrow(lean(run), "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each
    sends every node's larger (then smaller) neighbours to the smallest one.
    Minima are aggregated before they are joined back, so a hub's row is one
    row beside its neighbours, which an adaptive join can split.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            near = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            near = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = cut(near.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m")))
        met = near.join(low, F.col("u") == F.col("k"))
        if large:
            met = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            met = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                low.select(F.col("k").alias("u"), F.col("m").alias("v")))
        return met.where("u <> v").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = mark(e)
    while seen[0]:
        e = cut(star(star(e, True), False))
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def groups(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of (doc_id, fp) rows."""
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp"), max_bits))
    nodes = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    nodes = cut(nodes)
    ids = cut(nodes.groupBy(F.col("root").alias("of")).agg(F.min("first").alias("component_id")))
    return cut(nodes.join(ids, F.col("root") == F.col("of")).select(
        F.col("fp").alias("key"), "root", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. Rows
    that repeat appear as often as they occur. component_id is the smallest
    non-null id reachable, null if there is none. An empty table gives no rows.
    A very long text is fingerprinted whole, 65,536 shingles at a time; other
    columns are not read, whatever their names.
    """
    fps = cut(fingerprints(docs, shingle, id_col, text_col))
    out = fps.join(groups(fps, max_bits), F.col("fp") == F.col("key"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every near-duplicate component: the smallest
    id (null last), then the smallest fingerprint and hash of the row. Of rows
    that repeat exactly one stays. All columns stay as they are, whatever their
    names. Null and empty texts are one component, however many they are; a
    very long text is fingerprinted whole; an empty table stays empty.

    The choice is made on ids, fingerprints and 128-bit hashes of the rows;
    texts meet only the list of rows that go, which is broadcast if it is
    proven small.
    """
    ship(docs.sparkSession)
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    # A null leaves Spark's hash as it was: which columns are null is hashed beside them.
    whole = [*quoted, *[c.isNull() for c in quoted]]
    tag = uuid.uuid4().hex[:8]
    h = [f"h1_{tag}", f"h2_{tag}"]
    tagged = docs.withColumns({h[0]: F.xxhash64(*whole), h[1]: F.xxhash64(F.lit(1), *whole)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.simhash import fingerprint

        for batch in batches:
            fp = np.array([fingerprint(text_bytes(t.as_py()), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(fp.view(np.int64)), batch.column(2), batch.column(3)],
                names=["doc_id", "fp", "h1", "h2"])

    own = columns(tagged, doc_id=id_col, text=text_col, h1=h[0], h2=h[1])
    fps = cut(own.mapInArrow(lean(run), "doc_id bigint, fp bigint, h1 bigint, h2 bigint"))
    found = groups(fps.select("doc_id", "fp"), max_bits).select("key", "root")
    # One row for each fingerprint and then for each component: no key is hot in the join.
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "h1", "h2"))
    first = fps.groupBy(F.col("fp").alias("of")).agg(best.alias("row")).join(found, F.col("of") == F.col("key"))
    chosen = first.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row.h1").alias("c1"), F.col("row.h2").alias("c2"))
    rows = fps.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    rows = cut(rows.join(chosen, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
               .where(F.col("c1").isNull() | (F.col("n") > 1))
               .select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("c1").isNotNull().alias("again")))
    same = (F.col(h[0]) == F.col("g1")) & (F.col(h[1]) == F.col("g2"))
    out = tagged.join(broadcast_if_small(rows, MOST_ROWS, materialize=False), same, "left_anti").select(*quoted)
    again = rows.where("again")
    if not again.isEmpty():
        met = tagged.join(broadcast_if_small(again, MOST_ROWS, materialize=False), same, "left_semi")
        met = met.groupBy(*h).agg(F.first(F.struct(*quoted)).alias("row"))
        out = out.unionAll(met.select("row.*"))
    return out
