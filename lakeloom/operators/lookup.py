"""Lookup of addresses in nested ranges by a file that every executor gets.

Ranges may lie inside each other. They are cut into disjoint segments, each
with the narrowest range that covers it; the segments go to the executors once
as a file, and every batch of points is found in them by binary search. For
ranges of a proven number; ``joins.range_join`` takes any.
"""

from __future__ import annotations

import heapq
import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MOST_RANGES = 1_000_000


def segments(ranges: list[tuple]) -> list[tuple]:
    """(lo, hi, label): disjoint and ascending, from (lo, hi, label) with both
    ends included. Where several ranges cover a value the narrowest wins, of
    equally narrow ones the one that begins first and then the smaller label.
    Ranges that end before they begin, or lack an end, cover nothing."""
    valid = sorted((r for r in ranges if r[0] is not None and r[1] is not None and r[0] <= r[1]), key=lambda r: r[0])
    edges = sorted({r[0] for r in valid} | {r[1] + 1 for r in valid})
    out, open_, k = [], [], 0
    for a, b in zip(edges, edges[1:]):
        while k < len(valid) and valid[k][0] <= a:
            lo, hi, label = valid[k]
            heapq.heappush(open_, (hi - lo, lo, label, hi))
            k += 1
        while open_ and open_[0][3] < a:
            heapq.heappop(open_)
        if not open_:
            continue
        label = open_[0][2]
        if out and out[-1][1] == a - 1 and out[-1][2] == label:
            out[-1] = (out[-1][0], b - 1, label)
        else:
            out.append((a, b - 1, label))
    return out


def ship_segments(ranges: DataFrame, lo: str, hi: str, labels: list[str]) -> str:
    """Write the segments of ``ranges`` to a file, give it to every executor and
    return its name there. Raises beyond ``MOST_RANGES`` ranges."""
    spark = ranges.sparkSession
    rows = ranges.select(lo, hi, *labels).limit(MOST_RANGES + 1).collect()
    if len(rows) > MOST_RANGES:
        raise ValueError(f"over {MOST_RANGES} ranges: use joins.range_join")
    none = tuple("" for _ in labels)
    cut = segments([(r[0], r[1], tuple("" if x is None else x for x in r[2:]) or none) for r in rows])
    table = pa.table({"lo": pa.array([s[0] for s in cut], pa.int64()), "hi": pa.array([s[1] for s in cut], pa.int64())}
                     | {name: pa.array([s[2][i] or None for s in cut], pa.string()) for i, name in enumerate(labels)})
    path = os.path.join(tempfile.mkdtemp(prefix="lookup-"), f"segments-{uuid.uuid4().hex[:12]}.arrow")
    with pa.OSFile(path, "wb") as f, pa.ipc.new_file(f, table.schema) as out:
        out.write_table(table)
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped_lookup(points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str, labels: list[str]) -> DataFrame:
    """``points`` with the ``labels`` (strings) of the narrowest range that holds
    ``point``, null where there is none. Points are not shuffled; null points
    have no labels. ``labels`` must not be columns of ``points``."""
    clash = set(labels) & set(points.columns)
    if clash:
        raise ValueError(f"{sorted(clash)} are columns of the points")
    name = ship_segments(ranges, lo, hi, labels)
    at = points.columns.index(point)
    schema = T.StructType([*points.schema.fields, *[T.StructField(c, T.StringType()) for c in labels]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import SparkFiles

        with pa.memory_map(SparkFiles.get(name)) as f:
            table = pa.ipc.open_file(f).read_all()
        starts, ends = table["lo"].to_numpy(), table["hi"].to_numpy()
        for batch in batches:
            column = batch.column(at).cast(pa.int64())
            null = column.is_null().to_numpy(zero_copy_only=False)
            x = column.fill_null(0).to_numpy()
            i = np.searchsorted(starts, x, "right") - 1
            miss = null | (i < 0)
            if len(ends):
                miss |= x > ends[np.maximum(i, 0)]
            else:
                miss[:] = True
            place = pa.array(np.maximum(i, 0), mask=miss)
            found = [table[c].combine_chunks().take(place) if len(table) else pa.nulls(len(x), pa.string()) for c in labels]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, *labels])

    return points.mapInArrow(run, schema)
