"""Streams that are interrupted inside a batch, and session settings for a run.

A batch that dies before its commit is run again under the same id from the
offset log, whatever it had written by then. The helpers make that happen at a
chosen place, so that jobs and tests can show what a sink makes of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BatchWriter = Callable[[DataFrame, int], None]

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block; a query takes them when it starts."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def dies_midway(writer: BatchWriter, batch: int, part: Column) -> BatchWriter:
    """``writer``, which the first time it sees ``batch`` writes only the rows
    of ``part`` and then fails; the batch's next run goes through."""
    died = []

    def write(df: DataFrame, batch_id: int) -> None:
        if batch_id == batch and not died:
            died.append(batch_id)
            writer(df.where(part), batch_id)
            raise RuntimeError(f"batch {batch_id} dies after a part of its rows")
        writer(df, batch_id)
    return write


def failing_rows(df: DataFrame, bad: Column, marker: str) -> DataFrame:
    """``df`` whose tasks fail at the rows of ``bad``, after others were written:
    ``marker`` is a column that every row needs."""
    fault = F.raise_error(F.lit("the task dies at this row")).cast(df.schema[marker].dataType)
    return df.withColumn(marker, F.when(bad, fault).otherwise(F.col(marker)))


def run_with_restarts(run: Callable[[int], object], most: int = 3) -> tuple[object, int]:
    """``run(attempt)`` until a streaming query ends well; its result and how
    many attempts died before. The last failure is passed on."""
    for attempt in range(most):
        try:
            return run(attempt), attempt
        except StreamingQueryException:
            if attempt + 1 == most:
                raise
    raise ValueError("no attempt allowed")
