"""Joins Spark has no native operator for: interval and range joins.

Both become equi-joins on a bucket key plus a residual range predicate, so
Catalyst can use a broadcast-hash or sort-merge join instead of a nested
loop over all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# In-memory layout of a broadcast row: a null bitmap, an 8-byte slot per
# field, variable-length data padded to 8 bytes; the hashed relation built
# from it roughly doubles that.
_HASH_FACTOR = 2


def _padded(n: Column) -> Column:
    return ((n + 7) / 8).cast("bigint") * 8


def _var_bytes(name: str, type_name: str) -> Column | None:
    """Variable-length bytes of one value (None for fixed-width types)."""
    c = F.col("`" + name.replace("`", "``") + "`")
    if type_name in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double",
                     "date", "timestamp", "timestamp_ntz") or type_name.startswith("decimal"):
        return None
    if type_name in ("string", "binary"):
        return _padded(F.coalesce(F.octet_length(c), F.lit(0)))
    if type_name.startswith(("struct", "array", "map")):
        return _padded(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16)
    return _padded(F.coalesce(F.octet_length(c.cast("string")), F.lit(0)))


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES,
                       materialize: bool = True) -> DataFrame:
    """Broadcast hint only after proving the side is small.

    One aggregate over the side (partial, no row shuffle) counts its rows
    and sums their in-memory size: per row a null bitmap and an 8-byte slot
    per field, plus the actual length of every string, binary or nested
    value padded to 8 bytes, times two for the hashed relation. The hint is
    given only if both ``max_rows`` and ``max_bytes`` hold. With
    ``materialize`` (default) the side is first written once as a reliable
    checkpoint in the shared checkpoint directory, so an expensive side is
    computed once (not again for the join) and survives executor loss.
    Above the bounds the frame is returned unhinted and Spark plans a
    shuffle join. ``materialize=False`` suits plain scans of small tables.
    """
    if materialize:
        from lakeloom.operators.relational import cut_lineage

        df = cut_lineage(df)
    fields = df.schema.fields
    fixed = 8 * ((len(fields) + 63) // 64) + 8 * len(fields)
    var = [e for f in fields if (e := _var_bytes(f.name, f.dataType.simpleString())) is not None]
    size = sum(var, F.lit(fixed).cast("bigint"))
    n, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    if n <= max_rows and (total or 0) * _HASH_FACTOR <= max_bytes:
        return F.broadcast(df)
    return df


def _epoch_micros(df: DataFrame, ts: str, wall_clock: bool) -> Column:
    """Exact integer microseconds on the same clock as the join predicate.

    TIMESTAMP (instant): ``unix_micros``. TIMESTAMP_NTZ (wall clock): days
    and time of day of the wall-clock value, independent of the session
    time zone (a cast to TIMESTAMP would shift values around DST changes
    while the predicate compares wall-clock values). Integers, because
    fractional seconds as doubles lose the last digits near bucket borders.
    """
    c = F.col(ts)
    if wall_clock:
        seconds = F.date_part(F.lit("SECOND"), c)  # decimal with microseconds
        return (F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000_000)
                + (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * F.lit(1_000_000)
                + (seconds * 1_000_000).cast("bigint"))
    return F.unix_micros(c.cast("timestamp"))


def _floor_div(x: Column, d: int) -> Column:
    # x and d are exact integers below 2**53, so the quotient is correctly
    # rounded and its floor is the integer floor division.
    return F.floor(x / F.lit(d)).cast("bigint")


_INTERVAL_HOWS = {"inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi",
                  "left_anti", "leftanti", "anti"}


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  lower_s: int, upper_s: int, how: str = "inner",
                  bucket_s: int | None = None) -> DataFrame:
    """``right.ts BETWEEN left.ts + lower AND left.ts + upper`` on equal keys.

    Bucketing: the left side goes to bucket ``floor(ts / width)``; each right
    row is copied to every bucket a matching left row can be in (at most
    two when ``width = upper - lower``). Each pair is found exactly once, so
    ``inner`` and ``left`` outer both work directly. Column names of the two
    sides must be distinct except for ``key`` (taken from the left).
    ``bucket_s`` (default ``upper - lower``) trades copies for group size:
    a bucket k times wider copies a right row with probability about 1/k
    but makes each (key, bucket) join group k times larger.
    """
    if how not in _INTERVAL_HOWS:
        raise ValueError(f"interval_join supports {sorted(_INTERVAL_HOWS)}, not {how!r} "
                         "(right rows are copied to several buckets)")
    # Wall-clock buckets only when both sides are wall-clock; otherwise both
    # sides on the instant clock, as the predicate compares them.
    wall = all(isinstance(d.schema[t].dataType, T.TimestampNTZType)
               for d, t in ((left, left_ts), (right, right_ts)))
    width_us = max(bucket_s or (upper_s - lower_s), 1) * 1_000_000
    lb = _floor_div(_epoch_micros(left, left_ts, wall), width_us)
    rus = _epoch_micros(right, right_ts, wall)
    rb_lo = _floor_div(rus - F.lit(upper_s * 1_000_000), width_us)
    rb_hi = _floor_div(rus - F.lit(lower_s * 1_000_000), width_us)
    l2 = left.withColumn("_bucket", lb)
    r2 = (right.withColumnRenamed(key, "_rkey")
          .withColumn("_bucket", F.explode(F.sequence(rb_lo, rb_hi))))
    cond = (
        (l2[key] == r2["_rkey"]) & (l2["_bucket"] == r2["_bucket"])
        & (r2[right_ts] >= l2[left_ts] + F.make_interval(secs=F.lit(lower_s)))
        & (r2[right_ts] <= l2[left_ts] + F.make_interval(secs=F.lit(upper_s)))
    )
    out = l2.join(r2, cond, how)
    return out.drop("_bucket", "_rkey")


def ip_to_long(ip: str | Column) -> Column:
    """Dotted IPv4 text → unsigned 32-bit value as bigint (null if malformed)."""
    c = F.col(ip) if isinstance(ip, str) else ip
    parts = F.split(c, r"\.")
    octet = [F.try_element_at(parts, F.lit(i)).try_cast("bigint") for i in range(1, 5)]
    value = octet[0] * 16777216 + octet[1] * 65536 + octet[2] * 256 + octet[3]
    ok = (F.size(parts) == 4)
    for o in octet:
        ok = ok & o.between(0, 255)
    return F.when(ok, value)


def long_to_ip(v: str | Column) -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.concat_ws(".", *[(F.shiftright(c, s) % 256).cast("string") for s in (24, 16, 8, 0)])


def range_join(points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str,
               bucket_bits: int = 16, max_broadcast_rows: int = 2_000_000,
               how: str = "left") -> DataFrame:
    """Each point joined to the ranges with ``lo <= point <= hi``.

    Equi key ``(level, point >> level)``. A range's level is the least one, in
    steps of eight bits from ``bucket_bits``, at which it touches at most 257
    buckets, so no range explodes into more rows than that however wide it
    is; a point gets one key for each level that occurs (at most eight, found
    by one aggregate). The exploded range table is broadcast after a checked
    row count, else shuffle-joined on the key. ``how`` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"range_join supports inner and left, not {how!r}")
    steps = range(bucket_bits, 64, 8)
    narrow = F.coalesce(*[F.when(F.try_subtract(F.shiftright(F.col(hi), s), F.shiftright(F.col(lo), s)) <= 256, s)
                          for s in steps], F.lit(63))
    rb = ranges.where(F.col(lo) <= F.col(hi)).withColumn("_level", narrow)
    levels = sorted(r["_level"] for r in rb.select("_level").distinct().collect())
    at = lambda c: F.expr(f"shiftright(`{c}`, _level)")
    rb = rb.withColumn("_bucket", F.explode(F.sequence(at(lo), at(hi))))
    rb = broadcast_if_small(rb.withColumnsRenamed({"_level": "_rlevel", "_bucket": "_rbucket"}), max_broadcast_rows)

    def matched(p: DataFrame, kind: str) -> DataFrame:
        p = p.withColumn("_bucket", at(point))
        cond = ((p["_level"] == rb["_rlevel"]) & (p["_bucket"] == rb["_rbucket"])
                & (p[point] >= rb[lo]) & (p[point] <= rb[hi]))
        return p.join(rb, cond, kind).drop("_level", "_bucket", "_rlevel", "_rbucket")

    if len(levels) <= 1:
        return matched(points.withColumn("_level", F.lit(levels[0] if levels else bucket_bits)), how)
    every = F.explode(F.array(*[F.lit(s) for s in levels]))
    if how == "inner":
        return matched(points.withColumn("_level", every), "inner")
    from lakeloom.operators.relational import cut_lineage

    # Several levels: points without a match are those that no level matched.
    named = cut_lineage(points.withColumn("_id", F.monotonically_increasing_id()))
    found = matched(named.withColumn("_level", every), "inner")
    missed = named.join(found.select(F.col("_id").alias("_found")), F.col("_id") == F.col("_found"), "left_anti")
    return found.unionByName(missed, allowMissingColumns=True).drop("_id")
