"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are turned into integers, so scores are exact. The data are dealt into
blocks: every vector goes to the nearest of a bounded sample of pivots, and a
pivot's vectors are cut into blocks of about ``BLOCK`` rows, however many it
has. Queries (a stated set) are dealt the same way. Each block is indexed by a
cover tree, and the trees of a query block and a data block are searched
together. A pair of nodes is pruned when the largest inner product that their
centres and covering radii allow,

    <q, p> + |q| R_p + |p| R_q + R_q R_p,

is below the worst kth score so far in the query node. The same bound holds for
whole blocks: every query block first meets the data block with the largest
bound, which gives each of its queries a kth score; then only those pairs of
blocks are formed whose bound reaches the worst of them. A pair's answer is at
most k rows per query; the k best of those are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import columns, cut, ship

SCALE = 1024.0
BLOCK, QUERY_BLOCK = 4096, 1024
LEAF, QUERY_LEAF = 512, 128
#: Blocks whose centres and radii travel in a row together.
SPOTS = 1024
PIVOTS = 64
EXACT = float(1 << 53)


class CoverTree:
    """A cover tree by farthest-point separation.

    A node holds a centre, its covering radius (largest distance to any point
    below) and either children or, as a leaf, its points. At each level the
    children's centres are points at least half the parent's radius apart,
    and each point goes to its nearest one. Points equal to the centre make
    a leaf of radius zero.
    """

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.leaf = x, leaf
        self.center: list[np.ndarray] = []
        self.norm: list[float] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.points: list[np.ndarray] = []
        self.root = self._build(np.arange(len(x)))

    def _add(self, center: np.ndarray, radius: float, points: np.ndarray) -> int:
        self.center.append(center)
        self.norm.append(float(np.sqrt(center @ center)))
        self.radius.append(radius)
        self.children.append([])
        self.points.append(points)
        return len(self.center) - 1

    def _distance(self, points: np.ndarray, center: np.ndarray) -> np.ndarray:
        d = self.x[points] - center
        return np.sqrt((d * d).sum(1))

    def _build(self, everything: np.ndarray) -> int:
        first = self.x[everything].mean(0)
        root = self._add(first, float(self._distance(everything, first).max()), everything)
        todo = [root]
        while todo:
            node = todo.pop()
            points, radius = self.points[node], self.radius[node]
            if len(points) <= self.leaf or radius == 0:
                continue
            center = self.x[points[0]]
            near = self._distance(points, center)
            owner = np.zeros(len(points), np.int64)
            k = 1
            # Centres at least half the radius apart; at most 32 at a level.
            while k < 32 and near.max() > radius / 2:
                far = self._distance(points, self.x[points[int(near.argmax())]])
                closer = far < near
                owner[closer], near[closer] = k, far[closer]
                k += 1
            if k == 1:  # off-centre parent: split by the farthest point all the same
                if near.max() == 0:
                    self.center[node], self.radius[node] = center, 0.0
                    self.norm[node] = float(np.sqrt(center @ center))
                    continue
                far = self._distance(points, self.x[points[int(near.argmax())]])
                owner[far < near] = 1
                k = 2
            for j in range(k):
                own = points[owner == j]
                if len(own):
                    mid = self.x[own].mean(0)
                    child = self._add(mid, float(self._distance(own, mid).max()), own)
                    self.children[node].append(child)
                    todo.append(child)
        return root


class Best:
    """The k best (score, -id) of each query, found so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def worst(self, q: np.ndarray) -> float:
        return float(self.score[q, -1].min())

    def offer(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        scores = np.where(ids[None, :] == own[q][:, None], -np.inf, scores)
        k = self.k
        least = self.score[q, -1]
        if scores.shape[1] > k:
            least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
        for r in np.flatnonzero(scores.max(1) >= least).tolist():
            near = np.flatnonzero((scores[r] >= least[r]) & (scores[r] > -np.inf))
            s = np.concatenate((self.score[q[r]], scores[r, near]))
            i = np.concatenate((self.id[q[r]], ids[near]))
            order = np.lexsort((i, -s))[:k]
            self.score[q[r]], self.id[q[r]] = s[order], i[order]


def search(queries: CoverTree, data: CoverTree, own: np.ndarray, ids: np.ndarray, best: Best,
           floor: float = -np.inf) -> int:
    """Fill ``best`` from one pair of trees; the number of node pairs scored.
    Scores below ``floor`` are not wanted."""
    def bound(a: int, b: int) -> float:
        ra, rb = queries.radius[a], data.radius[b]
        top = float(queries.center[a] @ data.center[b]) + queries.norm[a] * rb + data.norm[b] * ra + ra * rb
        return top + 1e-6 * (1.0 + abs(top))  # above any rounding of the sums

    pairs = [(bound(queries.root, data.root), queries.root, data.root)]
    scored = 0
    while pairs:
        top, a, b = pairs.pop()
        q = queries.points[a]
        if top < max(floor, best.worst(q)):
            continue
        ca, cb = queries.children[a], data.children[b]
        if not ca and not cb:
            p = data.points[b]
            best.offer(q, queries.x[q] @ data.x[p].T, ids[p], own)
            scored += 1
            continue
        # Open the wider node; search the most promising pair first.
        if cb and (not ca or data.radius[b] >= queries.radius[a]):
            more = [(bound(a, c), a, c) for c in cb]
        else:
            more = [(bound(c, b), c, b) for c in ca]
        pairs.extend(sorted(more))
    return scored


def _matrix(rows: list, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), dim)


def block_topk(qid: np.ndarray, q: np.ndarray, pid: np.ndarray, p: np.ndarray, k: int, tree: CoverTree | None = None,
               floor: float = -np.inf):
    """(query, id, score) of the k best of each query in one block pair, as far
    as they reach ``floor``."""
    if not len(qid) or not len(pid):
        return [], [], []
    limit = float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * q.shape[1]
    if not limit < EXACT:  # products beyond what doubles hold exactly: whole-number arithmetic, row by row
        out = ([], [], [])
        data = [[int(v) for v in row] for row in p]
        for i, row in zip(qid.tolist(), q):
            own = [int(v) for v in row]
            best = sorted((-sum(a * b for a, b in zip(own, d)), j) for d, j in zip(data, pid.tolist()) if j != i)[:k]
            for s, j in best:
                out[0].append(i)
                out[1].append(j)
                out[2].append(max(-(1 << 63), min((1 << 63) - 1, -s)))
        return out
    best = Best(len(qid), k)
    search(CoverTree(q, QUERY_LEAF), tree or CoverTree(p), qid, pid, best, floor)
    row, col = np.nonzero(best.score > -np.inf)
    return qid[row].tolist(), best.id[row, col].tolist(), best.score[row, col].astype(np.int64).tolist()


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, x): components as floor(1024 * x) in a row of doubles.
    Null vectors, empty ones and those with null or non-finite components,
    and rows with a null id, are left out."""
    ship(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, rows = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                x = np.floor(v.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
                if np.isfinite(x).all():
                    ids.append(i)
                    dims.append(len(x))
                    rows.append(x.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(rows, pa.binary())],
                names=["vec_id", "dim", "x"])

    return columns(vectors, vec_id=id_col, v=vector_col).mapInArrow(run, "vec_id bigint, dim int, x binary")


def _blocks(rows: DataFrame, size: int, pivots: dict[int, np.ndarray]) -> DataFrame:
    """(dim, block, ids, data, centre, radius): vectors by nearest pivot, in
    blocks of about ``size``, with their mean and covering radius."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for dim, x in zip(batch.column(1).to_pylist(), batch.column(2)):
                d = pivots[dim] - np.frombuffer(x.as_py(), "<f8")
                at.append(int((d * d).sum(1).argmin()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())],
                                             names=["vec_id", "dim", "x", "pivot"])

    df = cut(rows.mapInArrow(place, "vec_id bigint, dim int, x binary, pivot int"))
    # A pivot with many vectors gets as many blocks as hold them at ``size`` rows each.
    many = df.groupBy("dim", "pivot").agg(F.count(F.lit(1)).alias("n"))
    df = df.join(F.broadcast(many), ["dim", "pivot"])  # a row per pivot: at most PIVOTS for each dimension
    salt = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / size).cast("bigint"))
    df = df.groupBy("dim", (F.shiftleft(F.col("pivot").cast("bigint"), 40) + salt).alias("block")).agg(
        F.collect_list("vec_id").alias("ids"), F.collect_list("x").alias("data"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.covertree import _matrix

        for batch in batches:
            centre, radius = [], []
            for dim, data in zip(batch.column(0).to_pylist(), batch.column(3)):
                x = _matrix(data.as_py(), dim)
                centre.append(x.mean(0))
                d = x - centre[-1]
                radius.append(float(np.sqrt((d * d).sum(1).max())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in centre], pa.binary()), pa.array(radius, pa.float64())],
                names=["dim", "block", "ids", "data", "centre", "radius"])

    return df.mapInArrow(measure, "dim int, block bigint, ids array<bigint>, data array<binary>, centre binary, radius double")


def block_bounds(q: np.ndarray, q_radius: float, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """No product of a vector around ``q`` with one around each centre is larger."""
    own, norm = float(np.sqrt(q @ q)), np.sqrt((centres * centres).sum(1))
    top = centres @ q + own * radii + norm * q_radius + radii * q_radius
    return top + 1e-6 * (1.0 + np.abs(top)) + 1e-9 * own * norm  # above any rounding of the sums


def _met(asked: DataFrame, spots: DataFrame, all_of_them: bool) -> DataFrame:
    """(q_dim, q_block, block, bound) for each query block and row of ``spots``:
    the data block of the largest bound, or all whose bound reaches the query
    block's ``floor`` and that it has not met as its ``first``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.covertree import _matrix, block_bounds

        for batch in batches:
            for dim, q_block, q, q_radius, floor, first, listed in zip(*(c.to_pylist() for c in batch.columns)):
                blocks = np.array([x["block"] for x in listed], np.int64)
                top = block_bounds(np.frombuffer(q, "<f8"), q_radius, _matrix([x["centre"] for x in listed], dim),
                                   np.array([x["radius"] for x in listed]))
                top = np.where(np.isnan(top), np.inf, top)
                if all_of_them:
                    at = np.flatnonzero((blocks != first) & (top >= (-np.inf if floor is None else floor)))
                else:
                    at = np.array([int(top.argmax())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), dim), pa.int32()), pa.array(np.full(len(at), q_block), pa.int64()),
                     pa.array(blocks[at]), pa.array(top[at])], names=["q_dim", "q_block", "block", "bound"])

    met = asked.join(spots, F.col("q_dim") == F.col("s_dim")).select(
        "q_dim", "q_block", "q_centre", "q_radius", "floor", "first", "blocks")
    return met.mapInArrow(run, "q_dim int, q_block bigint, block bigint, bound double")


def _answers(pairs: DataFrame, asked: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """(q_dim, q_block, query_id, vec_id, score) of pairs of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.covertree import CoverTree, _matrix, block_topk

        last, tree, pid = None, None, None
        for batch in batches:
            for r in range(batch.num_rows):
                dim, q_block, block, floor, q_ids, q_data, ids, x = (c[r].as_py() for c in batch.columns)
                if (dim, block) != last:  # a data block's tree serves all query blocks that come to this task
                    last, pid, tree = (dim, block), np.array(ids), CoverTree(_matrix(x, dim))
                query, found, score = block_topk(np.array(q_ids), _matrix(q_data, dim), pid, tree.x, k, tree,
                                                 -np.inf if floor is None else floor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(query), dim), pa.int32()), pa.array(np.full(len(query), q_block), pa.int64()),
                     pa.array(query, pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.int64())],
                    names=["q_dim", "q_block", "query_id", "vec_id", "score"])

    to = data.select(F.col("dim").alias("d_dim"), F.col("block").alias("d_block"), "ids", "data")
    full = pairs.join(asked.select("q_dim", "q_block", "floor", "q_ids", "q_data"), ["q_dim", "q_block"]).join(
        to, (F.col("q_dim") == F.col("d_dim")) & (F.col("block") == F.col("d_block")))
    return full.select("q_dim", "q_block", "block", "floor", "q_ids", "q_data", "ids", "data").mapInArrow(
        run, "q_dim int, q_block bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, is_query: str = "vec_id % 100 = 0", k: int = 10,
          id_col: str = "vec_id", vector_col: str = "embedding", figures: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products.

    Ties go to the smaller id; a query with fewer candidates gets all of
    them. Only vectors of a query's own length are its candidates. Rows that
    share an id are one row (the first by content). Scores beyond a bigint
    stop at its ends. An empty table gives no rows. Other columns are not
    read. ``figures`` takes the pairs of blocks formed and those there are.
    """
    rows = whole_vectors(vectors, id_col, vector_col)
    rows = cut(rows.groupBy("vec_id").agg(F.min(F.struct("dim", "x")).alias("v")).select("vec_id", "v.dim", "v.x"))
    # The pivots only steer which vectors share a block: a sample, one for a block's worth of rows, at most PIVOTS.
    whole = Window.partitionBy("dim")
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr(is_query)).alias("n_queries"))
    sizes = {r["dim"]: r for r in sizes.collect()}  # a row per vector length
    rank = F.row_number().over(whole.orderBy(F.xxhash64(F.lit(3), "vec_id"), "vec_id"))
    sample: dict[int, list] = {}
    for r in rows.withColumn("r", rank).where(F.col("r") <= PIVOTS).orderBy("r").select("dim", "x").collect():
        sample.setdefault(r["dim"], []).append(bytes(r["x"]))

    def pivots(column: str, size: int) -> dict[int, np.ndarray]:
        return {d: _matrix(v[:max(1, -(-sizes[d][column] // size))], d) for d, v in sample.items()}

    data = cut(_blocks(rows, BLOCK, pivots("n", BLOCK)))
    asked = _blocks(rows.where(is_query), QUERY_BLOCK, pivots("n_queries", QUERY_BLOCK))
    asked = cut(asked.toDF("q_dim", "q_block", "q_ids", "q_data", "q_centre", "q_radius"))
    rows_of_spots = F.ceil(F.count(F.lit(1)) / SPOTS).cast("bigint")
    parts = {r["dim"]: r["n"] for r in data.groupBy("dim").agg(rows_of_spots.alias("n")).collect()}
    share = F.pmod(F.xxhash64("block"), F.lit(max(parts.values(), default=1)))
    spots = cut(data.groupBy(F.col("dim").alias("s_dim"), share.alias("share")).agg(
        F.collect_list(F.struct("block", "centre", "radius")).alias("blocks")))

    # Each query block's most promising data block gives its queries a kth score each.
    none = asked.withColumn("floor", F.lit(None).cast("double")).withColumn("first", F.lit(None).cast("bigint"))
    first = cut(_met(none, spots, False).groupBy("q_dim", "q_block").agg(F.max_by("block", F.struct("bound", "block")).alias("block")))
    seeds = cut(_answers(first, none, data, k))
    kth = seeds.groupBy("q_dim", "q_block", "query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    # Scores that stopped at the lower end of a bigint bound nothing.
    full = (F.col("n") >= k) & (F.col("kth") > -(1 << 63))
    kth = kth.groupBy("q_dim", "q_block").agg(F.count_if(full).alias("able"), F.min("kth").alias("kth"))
    known = asked.join(first.withColumnRenamed("block", "first"), ["q_dim", "q_block"]).join(kth, ["q_dim", "q_block"], "left")
    known = cut(known.withColumn("floor", F.when(F.col("able") == F.size("q_ids"), F.col("kth").cast("double"))).drop("able", "kth"))
    rest = cut(_met(known, spots, True).drop("bound"))
    if figures is not None:
        figures |= {"pairs": first.count() + rest.count(), "all": asked.join(data, F.col("q_dim") == F.col("dim")).count()}
    part = seeds.unionByName(_answers(rest, known, data, k))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
