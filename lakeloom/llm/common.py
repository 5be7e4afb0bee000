"""Helpers shared by the training-data operators.

Text rules used throughout: a *word* is a maximal run of bytes outside
``\\x20`` and ``\\x09-\\x0D``. ``bytes.split()`` with no argument cuts at
exactly those six bytes, and none of them occurs inside a multi-byte UTF-8
sequence, so splitting the encoded text is the exact rule.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Java / Spark form of the word pattern.
WORD = "[^\\x20\\x09-\\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per application).

    The package goes out through ``addPyFile``, so executors need neither a
    shared folder nor an installed copy.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    path = os.path.join(tempfile.mkdtemp(prefix="llm-ship-"), f"{name}_{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def columns(df: DataFrame, **want: str) -> DataFrame:
    """Only the named columns, under fixed names: extra columns of the input,
    whatever they are called, cannot clash with what an operator adds."""
    quoted = {k: "`" + v.replace("`", "``") + "`" for k, v in want.items()}
    return df.select(*[F.col(q).alias(k) for k, q in quoted.items()])


def text_bytes(value: str | None) -> bytes:
    return value.encode("utf-8", "surrogatepass") if value else b""


class HashedWords(dict):
    """word -> unsigned XXH64. Holds at most ``limit`` words, then starts anew,
    so its memory is bounded; the values do not depend on what it holds."""

    def __init__(self, seed: int = 0, limit: int = 200_000):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return h


def release() -> None:
    """Give freed memory back to the system. Python workers live on between
    tasks, and what they keep counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run):
    """``run`` (batches to batches), releasing its memory when a task ends."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def gather(flat: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` values from each ``start`` in ``flat``, one after the other."""
    n = n.astype(np.int64, copy=False)
    stop = np.cumsum(n)
    return flat[np.repeat(start - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)]


def partitions(spark: SparkSession) -> int:
    """Reduce-side partition count of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there:
    later passes neither recompute it nor depend on any executor."""
    from lakeloom.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def null_safe(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)  # type: ignore[return-value]
