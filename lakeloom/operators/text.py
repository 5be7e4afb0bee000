"""Text operators: word count and token explosion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.text import java_split, lines
from lakeloom.operators.relational import with_min_partitions


def words(df: DataFrame, text_col: str = "text", sep: str = " ",
          min_partitions: int | None = None) -> DataFrame:
    """One row per word of every line of ``text_col`` (flatMap of split)."""
    df = with_min_partitions(df.select(text_col), min_partitions)
    return (
        df.select(F.explode(lines(text_col)).alias("line"))
        .select(F.explode(java_split("line", sep)).alias("word"))
    )


def word_count(df: DataFrame, text_col: str = "text", sep: str = " ",
               min_partitions: int | None = None) -> DataFrame:
    """Count of every word over whole texts.

    Plan: scan(text) → Generate → partial HashAggregate → Exchange(word) →
    final HashAggregate. The map-side partial aggregate bounds what a hot
    word ships through the shuffle to one row per map task.
    """
    return (words(df, text_col, sep, min_partitions)
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def line_word_count(df: DataFrame, line_col: str = "value", sep: str = " ",
                    min_partitions: int | None = None) -> DataFrame:
    """Word count over input that is already one row per line (a text file
    read line by line): no further line splitting, so a blank line still
    yields the empty word, as splitting it would."""
    df = with_min_partitions(df.select(line_col), min_partitions)
    return (df.select(F.explode(java_split(line_col, sep)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def explode_split(df: DataFrame, keys: list[str], text_col: str, sep: str = " ") -> DataFrame:
    """Keep ``keys``, one row per token of ``split(text_col, sep)`` (regex sep).

    A null text yields no rows, like ``explode``.
    """
    return df.select(*keys, F.explode(F.split(F.col(text_col), sep)).alias("token"))


def split_tokens(df: DataFrame, keys: list[str], text_col: str, seps: dict[str, str]) -> DataFrame:
    """Token counts and first tokens for several separators at once."""
    out = [F.col(k) for k in keys]
    for name, sep in seps.items():
        parts = F.split(F.col(text_col), sep)
        out.append(F.size(parts).alias(f"n_{name}"))
        out.append(F.element_at(parts, 1).alias(f"first_{name}"))
    return df.select(*out)
