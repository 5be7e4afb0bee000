"""Toxicity scores from a factorization machine over hashed terms.

A document is the set of its terms, hashed into 2^22 buckets: lower-cased words
without punctuation at their ends, and their first four and five letters, which
inflected forms share. Its score is the logistic function of

    b + sum of w_i + sum over pairs i < j of <v_i, v_j>

over the terms i it holds: the pair term learns what a weight per term cannot,
such as an insult that counts only beside a mention of a group. The pair sum
is half of |sum v_i|^2 - sum |v_i|^2, so it costs no more than the linear part.

Training takes a bounded sample (``MAX_ROWS`` labelled rows, those of smallest
id hash) of the rows outside the held-out fold. Only buckets whose presence
tells significantly about the label (a G-test of ``LEAST_G`` or more) have
weights, and the ``PAIRED`` foremost of them have factors: words that a few
toxic rows hold by chance cannot add up in a long text, and the model's size
is bounded by the sample's.
Scoring maps over the scan; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import columns, cut, lean, ship, text_bytes

MAX_ROWS = 20_000
BUCKETS = 1 << 22
PAIRED, FACTORS, LEAST_G = 4096, 8, 12.0
THRESHOLD = 0.3
_EDGES = ".,;:!?\"'()[]{}<>|*-_#"


def term_buckets(word: bytes) -> tuple[int, ...]:
    """Buckets of a word and its beginnings; none for punctuation alone."""
    term = word.decode("utf-8", "surrogatepass").lower().strip(_EDGES)
    starts = [term[:n] + "+" for n in (4, 5) if len(term) > n]
    return tuple(xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 5) % BUCKETS
                 for t in (term, *starts)) if term else ()


class Buckets(dict):
    """word -> its buckets, or their rows in a model; at most ``limit`` words are held."""

    def __init__(self, rows: dict[int, int] | None = None, limit: int = 300_000):
        super().__init__()
        self.rows, self.limit = rows, limit

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        b = term_buckets(word)
        if self.rows is not None:
            b = tuple(self.rows[x] for x in b if x in self.rows)
        self[word] = b
        return b


def _terms(text: bytes, lookup: Buckets) -> np.ndarray:
    found = set(chain.from_iterable(map(lookup.__getitem__, set(text.split()))))
    return np.sort(np.fromiter(found, np.int64, len(found)))


def held_out(doc_id: int | None, fold: int = 2, folds: int = 4) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


class Model:
    """Bias, weights and factors; rows below ``len(v)`` have factors."""

    def __init__(self, bias: float, buckets: np.ndarray, w: np.ndarray, v: np.ndarray):
        self.bias, self.buckets, self.w, self.v = bias, buckets, w, v

    def lookup(self) -> Buckets:
        return Buckets({b: i for i, b in enumerate(self.buckets.tolist())})

    def score(self, rows: np.ndarray) -> float:
        z = self.bias + float(self.w[rows].sum())
        f = self.v[rows[:int(np.searchsorted(rows, len(self.v)))]]
        z += 0.5 * float((f.sum(0) ** 2).sum() - (f ** 2).sum())
        return 1.0 / (1.0 + float(np.exp(-np.clip(z, -40, 40))))


def fit(sets: list[np.ndarray], labels: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.3,
        decay: float = 2e-4, least_g: float = LEAST_G, seed: int = 7) -> Model:
    """Adagrad on the logistic loss. ``sets``: each row's sorted bucket ids.

    In the G-test counts are smoothed by a half. A term must be in two rows.
    """
    y = labels.astype(np.float64)
    bias = float(np.log((y.sum() + 0.1) / (len(y) - y.sum() + 0.9)))
    none = Model(bias, np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32))
    if not sets or not 0 < y.sum() < len(y):
        return none
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets).astype(np.int32, copy=False)
    buckets, count = np.unique(flat, return_counts=True)
    buckets = buckets[count >= 2]
    if not len(buckets):
        return none
    place = np.full(BUCKETS, -1, np.int32)
    place[buckets] = np.arange(len(buckets), dtype=np.int32)
    flat = place[flat]
    doc = np.repeat(np.arange(len(y), dtype=np.int32), sizes)[flat >= 0]
    flat = flat[flat >= 0]
    # Rows of the model: terms that tell most about the label first (G-test with a half count).
    n = np.bincount(flat, minlength=len(buckets)) + 1.0
    k = np.bincount(flat, weights=y[doc], minlength=len(buckets)) + 0.5
    base = (y.sum() + 0.5) / (len(y) + 1)
    g = 2 * (k * np.log(k / (n * base)) + (n - k) * np.log((n - k) / (n * (1 - base))))
    order = np.argsort(-g, kind="stable")
    order = order[:int((g >= least_g).sum())]
    if not len(order):
        return none
    rank = np.full(len(buckets), -1, np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    flat = rank[flat]
    doc, flat = doc[flat >= 0], flat[flat >= 0].astype(np.int64)
    sizes = np.bincount(doc, minlength=len(y))
    buckets = buckets[order].astype(np.int64)
    start = np.concatenate(([0], np.cumsum(sizes)))

    rng = np.random.default_rng(seed)
    m = min(PAIRED, len(buckets))
    w, v = np.zeros(len(buckets)), rng.normal(0, 0.01, (m, FACTORS))
    gw, gv, gb = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), 1e-2
    for _ in range(epochs):
        rows = rng.permutation(len(y))
        for at in range(0, len(rows), batch):
            own = rows[at:at + batch]
            size = sizes[own]
            total = int(size.sum())
            idx = flat[np.repeat(start[own] - (np.cumsum(size) - size), size) + np.arange(total)]
            doc = np.repeat(np.arange(len(own)), size)
            paired = idx < m
            pi, pd = idx[paired], doc[paired]
            f = v[pi]
            sums = np.stack([np.bincount(pd, weights=f[:, j], minlength=len(own)) for j in range(FACTORS)], 1)
            squares = np.bincount(pd, weights=(f ** 2).sum(1), minlength=len(own))
            z = bias + np.bincount(doc, weights=w[idx], minlength=len(own)) + 0.5 * ((sums ** 2).sum(1) - squares)
            err = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[own]
            gb += err.sum() ** 2
            bias -= rate * err.sum() / np.sqrt(gb)
            used, inv = np.unique(idx, return_inverse=True)
            d = np.bincount(inv, weights=err[doc]) + decay * w[used]
            gw[used] += d ** 2
            w[used] -= rate * d / np.sqrt(gw[used])
            used, inv = np.unique(pi, return_inverse=True)
            step = err[pd][:, None] * (sums[pd] - f)
            d = np.stack([np.bincount(inv, weights=step[:, j], minlength=len(used)) for j in range(FACTORS)], 1)
            d = d + 10 * decay * v[used]  # whole numbers if the batch has no paired term
            gv[used] += d ** 2
            v[used] -= 0.1 * rate * d / np.sqrt(gv[used])
    return Model(bias, buckets, w.astype(np.float32), v.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold.

    Repeated labels of a document count once (1 if any is 1), and so do
    repeated rows of a document (one of them), so no more than ``max_rows``
    rows are gathered; null texts are rows without terms. With no labelled row,
    or one class only, every score is the smoothed share of label 1.
    """
    ship(docs.sparkSession)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    own = columns(labels, doc_id=id_col, y=label_col).where("doc_id IS NOT NULL AND y IS NOT NULL").where(fold != 2)
    own = own.groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.toxicity import Buckets, _terms

        lookup = Buckets()
        for batch in batches:
            sets = [_terms(text_bytes(t.as_py()), lookup).astype("<i4").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())],
                                             names=["doc_id", "y", "terms"])

    # The sample is at most max_rows pairs of numbers: small enough to broadcast.
    named = columns(docs, doc_id=id_col, text=text_col).join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")
    rows = named.mapInArrow(lean(run), "doc_id bigint, y int, terms binary")
    rows = cut(rows.groupBy("doc_id").agg(F.min(F.struct("y", "terms")).alias("r")).select("doc_id", "r.*"))
    passed = _telling(rows)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(t.as_py(), "<i4") for t in batch.column(2)]
            sets = [t[np.isin(t, passed)].tobytes() for t in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())],
                                             names=["doc_id", "y", "terms"])

    found = rows.mapInArrow(lean(thin), rows.schema).toPandas().sort_values("doc_id", kind="stable")
    return fit([np.frombuffer(t, "<i4") for t in found["terms"]], found["y"].to_numpy() == 1)


def _telling(rows: DataFrame) -> np.ndarray:
    """Sorted buckets that pass the G-test over all rows of the sample.

    Counted and tested in Spark: of the sample's many terms only these reach
    the driver. ``fit`` tests them again, so the margin here decides nothing.
    """
    total, toxic = rows.select(F.count("*"), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0))).first()
    if not 0 < toxic < total:
        return np.zeros(0, np.int32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(t.as_py(), "<i4") for t in batch.column(2)]
            y = np.repeat(batch.column(1).to_numpy() == 1, [len(t) for t in sets])
            buckets, inverse, n = np.unique(np.concatenate([np.zeros(0, "<i4"), *sets]), return_inverse=True,
                                            return_counts=True)
            k = np.bincount(inverse[y], minlength=len(buckets))
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(n, pa.int64()),
                                              pa.array(k, pa.int64())], names=["bucket", "n", "k"])

    base = (toxic + 0.5) / (total + 1)
    own = rows.mapInArrow(lean(count), "bucket int, n bigint, k bigint").groupBy("bucket").agg(
        F.sum("n").alias("rows"), (F.sum("n") + 1.0).alias("n"), (F.sum("k") + 0.5).alias("k"))
    rest = F.col("n") - F.col("k")
    g = 2 * (F.col("k") * F.log(F.col("k") / (F.col("n") * base)) + rest * F.log(rest / (F.col("n") * (1 - base))))
    passed = own.where(F.col("rows") >= 2).where(g >= LEAST_G - 1e-6).select("bucket").toPandas()
    return np.sort(passed["bucket"].to_numpy(np.int32))


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row. A null or empty text
    has no terms and scores the bias alone; a null id is not held out; repeated
    rows score alike; an empty table gives no rows. A very long text is scored
    by all its distinct terms; other columns are not read."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.toxicity import _terms, held_out

        lookup = model.lookup()
        for batch in batches:
            s = np.array([model.score(_terms(text_bytes(t.as_py()), lookup)) for t in batch.column(1)], np.float64)
            out = [held_out(i) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(out, pa.bool_()), pa.array(s),
                 pa.array((s >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(
        lean(run), "doc_id bigint, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns
    stay, whatever their names. See ``scores`` for nulls and long texts."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lakeloom.llm.toxicity import _terms

        lookup = model.lookup()
        for batch in batches:
            keep = [model.score(_terms(text_bytes(t.as_py()), lookup)) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
