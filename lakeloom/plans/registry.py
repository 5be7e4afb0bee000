"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}


def query(name: str) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        return fn

    return register


def all_queries() -> dict[str, QueryFn]:
    # Importing the modules registers their queries.
    from lakeloom.plans import (  # noqa: F401
        batch_core,
        batch_json,
        batch_kv,
        batch_offsets,
        batch_time,
        batch_io,
        batch_parts,
        streams,
        streams_kept,
    )

    return dict(_QUERIES)
