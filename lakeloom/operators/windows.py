"""Whole-group values and top-N per group.

A window that spans a whole group needs every row of the group in one
task. With a dominant key that task would hold a third of the data, so:
* whole-partition totals are an aggregate joined back to the rows;
* top-N uses ``row_number() <= n``, which Spark plans with a partial
  WindowGroupLimit before the shuffle (each map task forwards at most
  ``n`` rows per group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.joins import broadcast_if_small

SALTS = 32


def attach_group_totals(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column],
                        max_broadcast_groups: int = 1_000_000) -> DataFrame:
    """Rows plus aggregates over their whole group.

    Same result as ``agg.over(partitionBy(keys).orderBy(..).rangeBetween(
    unboundedPreceding, unboundedFollowing))``. The per-group aggregate is
    broadcast only when its row count is checked to be at most
    ``max_broadcast_groups``; otherwise it is a shuffle join (AQE splits
    skewed partitions of the row side).
    """
    renamed = {k: f"_gk{i}" for i, k in enumerate(keys)}
    totals = (df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
              .withColumnsRenamed(renamed))
    totals = broadcast_if_small(totals, max_broadcast_groups)
    cond = None
    for k, r in renamed.items():
        c = df[k].eqNullSafe(totals[r])  # a null key is a group, as in a window
        cond = c if cond is None else cond & c
    return df.join(totals, cond, "left").drop(*renamed.values())


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    rank_name: str = "rn") -> DataFrame:
    """Rows ranked 1..n per group by ``order`` (give a total order).

    Spark ranks before the shuffle as well only up to a threshold (1000); for
    a larger ``n`` each group is first cut to its n best in ``SALTS`` parts, so
    a hot group is spread and its last task gets at most ``SALTS * n`` rows.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        salt = F.pmod(F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]), F.lit(SALTS))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", salt).withColumn("_part", F.row_number().over(part))
              .where(F.col("_part") <= n).drop("_salt", "_part"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= n)
