"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words. Within it documents weigh unequally:
one of weight w is to be taken ``least(max_copies, level * w)`` times, with the
level at which these copies add up to the source's target. The whole part of
that number is certain and is taken first. The fraction p that is left is a
probability: every document draws a uniform number U from its own hash and is
ranked by Pareto's ratio of odds

    Q = (U / (1 - U)) / (p / (1 - p))

and the documents with the smallest Q are taken until their words reach the
rest of the target. The sample size is fixed in words rather than drawn, and
the last gap is closed with up to ``FILLS`` of the remaining documents whose
sizes fit it best. Weights come from a column, or else from the size: longer
documents weigh more (``size_weight``). They count in steps of an eighth of a
power of two, so a source has few classes of weight.

No source is ever sorted in one task: sums over 4,096 x 4,096 buckets of Q
find where a source's running total crosses its target, and only the rows of
that one bucket are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.llm.common import WORD, columns, cut, null_safe

BUCKETS = 4096
MAX_BROADCAST = 10_000
FILLS = 3


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float,
                   max_copies: int) -> DataFrame:
    """(source, source_size, target) from one row per document (source, size).

    Sources in code point order, null last, take ``weights`` in turn. Their
    targets share ``share`` of all words in proportion to weight; a target
    that would exceed ``max_copies`` times its source stops there and the
    excess is shared again. The end state is a common level c: a source gets
    ``least(cap, c * weight)``. With sources ordered by cap / weight, the
    first one whose cap holds the level computed over itself and all later
    ones fixes c.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_copies))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    per = per.select(
        "*",
        F.row_number().over(order).alias("place"),
        (F.sum("source_size").over(whole) * float(share)
         - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
         ).alias("left"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("left_weight"),
    ).withColumn("level", F.col("left") / F.col("left_weight"))
    fits = F.col("cap") >= F.col("level") * F.col("weight")
    per = per.withColumn("first", F.min(F.when(fits, F.col("place"))).over(whole))
    per = per.withColumn("common", F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(whole))
    capped = F.col("first").isNull() | (F.col("place") < F.col("first"))
    return per.select(
        "source", "source_size",
        F.when(capped, F.col("cap")).otherwise(F.least(F.col("cap"), F.col("common") * F.col("weight")))
        .alias("target"))


def _draw(seed: int) -> Column:
    """Uniform in (0, 1), fixed by the document's id and text."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def size_weight(size: Column) -> Column:
    """1 up to 31 words, then one more for each doubling, 5 from 512 words on."""
    return F.least(F.greatest(F.log2(F.greatest(size, F.lit(1))) - 4, F.lit(1.0)), F.lit(5.0))


def _steps(w: Column) -> Column:
    """A weight rounded to an eighth of a power of two; 0 for null, NaN, 0 and below."""
    w = F.greatest(F.least(w.cast("double"), F.lit(2.0 ** 64)), F.lit(2.0 ** -64))
    return F.pow(F.lit(2.0), F.round(F.log2(w) * 8) / 8)


def _row_figures(seed: int, weight_col: str | None) -> list[Column]:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    if weight_col is None:
        return [size.alias("size"), _draw(seed).alias("u"), _steps(size_weight(size)).alias("w")]
    own = F.col("w").cast("double")
    return [size.alias("size"), _draw(seed).alias("u"),
            F.when((own > 0) & ~F.isnan(own), _steps(own)).otherwise(F.lit(0.0)).alias("w")]


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", weight_col: str | None = None, seed: int = 42) -> DataFrame:
    """(doc_id, source, size, u, w) of every document; a null text has size 0."""
    names = {"doc_id": id_col, "text": text_col, "source": source_col}
    df = columns(docs, **names, **({"w": weight_col} if weight_col else {}))
    return df.select("doc_id", "source", *_row_figures(seed, weight_col))


def class_copies(sizes: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """(source, w, source_size, target, whole, p, rest): for each source and
    weight the certain copies and the probability of one more, and the words of
    the source's target that the certain copies leave. The level is found as in
    ``source_targets``, among the classes of a source, heaviest first."""
    per = sizes.groupBy("source", "w").agg(F.sum("size").alias("class_size"))
    to = targets.withColumnRenamed("source", "of")
    per = per.join(to, null_safe(F.col("source"), F.col("of"))).drop("of")
    most = float(max_copies)
    down = Window.partitionBy("source").orderBy(F.desc("w"))
    per = per.select(
        "*", F.row_number().over(down).alias("place"),
        (F.col("target") - most * F.coalesce(F.sum("class_size").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         ).alias("left"),
        F.sum(F.col("w") * F.col("class_size")).over(down.rowsBetween(0, Window.unboundedFollowing)).alias("mass"))
    per = per.withColumn("level", F.try_divide(F.col("left"), F.nullif(F.col("mass"), F.lit(0.0))))
    source = Window.partitionBy("source")
    per = per.withColumn("first", F.min(F.when(F.col("level") * F.col("w") <= most, F.col("place"))).over(source))
    per = per.withColumn("common", F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(source))
    full = (F.col("first").isNull() | (F.col("place") < F.col("first"))) & (F.col("w") > 0)
    times = F.when(full, F.lit(most)).otherwise(
        F.least(F.lit(most), F.greatest(F.lit(0.0), F.coalesce(F.col("common"), F.lit(0.0)) * F.col("w"))))
    per = per.withColumn("times", times).withColumn("whole", F.floor("times"))
    return per.select("source", "w", "source_size", "target", "whole", (F.col("times") - F.col("whole")).alias("p"),
                      (F.col("target") - F.sum(F.col("whole") * F.col("class_size")).over(source)).alias("rest"))


def _ratio(p: Column) -> Column:
    """Pareto's ratio of odds, mapped from (0, inf) to (0, 1) in its order."""
    p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    q = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    return q / (1 + q)


def _beside_rows(per: DataFrame) -> DataFrame:
    """A table of a row per source, to be joined to the documents: broadcast
    once it is known to have at most ``MAX_BROADCAST`` rows, so that a source
    with most of the documents stays spread; with more sources, Spark's own
    join, which splits large ones."""
    return F.broadcast(per) if per.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else per


def _crossing(rows: DataFrame, bucket: Column) -> DataFrame:
    """Per source, the first bucket in which the running words pass ``rest``,
    and the words before it; a source whose rows all fit has no row here."""
    sums = rows.withColumn("bucket", bucket).groupBy("source", "bucket").agg(
        F.sum("size").alias("words"), F.max("rest").alias("rest"), F.max("before").alias("start"))
    run = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("end", F.col("start") + F.sum("words").over(run))
    return sums.where("end > rest").groupBy("source").agg(
        F.min_by(F.struct("bucket", (F.col("end") - F.col("words")).alias("before")), "bucket").alias("x")
    ).select(F.col("source").alias("at"), "x.bucket", F.col("x.before").alias("passed"))


def plan(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
         max_copies: int = 2) -> DataFrame:
    """(source, w, source_size, target, whole, p, rest, last, below, extra) per
    source and weight.

    ``whole`` are the certain copies; a document is taken once more if its
    rank value is at most ``last`` or among ``extra``.
    """
    per = class_copies(sizes, source_targets(sizes, weights, share, max_copies), max_copies)
    per = _beside_rows(cut(per))

    rows = ranked(sizes, per).where(f"rest > 0 AND size > 0 AND whole < {int(max_copies)} AND w > 0").withColumn(
        "before", F.lit(0).cast("bigint"))
    coarse = F.floor(F.col("v") * BUCKETS)
    fine = F.floor((F.col("v") * BUCKETS - F.floor(F.col("v") * BUCKETS)) * BUCKETS)

    def inside(found: DataFrame, bucket: Column) -> DataFrame:
        return rows.drop("before").join(found, null_safe(F.col("source"), F.col("at"))).where(
            bucket == F.col("bucket"))

    one = _beside_rows(cut(_crossing(rows, coarse)))
    in_one = inside(one, coarse).withColumn("before", F.col("passed")).drop("at", "bucket", "passed")
    two = _beside_rows(cut(_crossing(in_one, fine)))
    last_rows = in_one.drop("before").join(two, null_safe(F.col("source"), F.col("at"))).where(
        fine == F.col("bucket"))
    # Equal rank values stand together: rows of one document repeated are taken or left alike.
    run = Window.partitionBy("source").orderBy("v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tie = Window.partitionBy("source", "v")
    last_rows = last_rows.withColumn("end", F.col("passed") + F.sum("size").over(run)).withColumn(
        "own", F.sum("size").over(tie))
    inner = last_rows.groupBy(F.col("source").alias("at")).agg(
        F.max(F.when(F.col("end") <= F.col("rest"), F.struct("v", "end"))).alias("t"),
        F.min("passed").alias("passed"))
    # Rows in buckets below the crossing are in; a source without a crossing takes all.
    bound = one.select("at", F.col("bucket").alias("b1")).join(
        two.select(F.col("at").alias("at2"), F.col("bucket").alias("b2")), null_safe(F.col("at"), F.col("at2"))
    ).select("at", ((F.col("b1") + F.col("b2") / BUCKETS) / BUCKETS).alias("floor_v"))
    done = bound.join(inner.withColumnRenamed("at", "at3"), null_safe(F.col("at"), F.col("at3"))).select(
        "at", F.coalesce("t.v", "floor_v").alias("last"), F.col("t").isNull().alias("below"),
        F.coalesce("t.end", "passed").alias("got"))
    done = _beside_rows(cut(done))

    # The gap that is left: further documents, each the largest that fits, the last one the nearest.
    gaps = done.withColumn("extra", F.array().cast("array<double>"))
    for step in range(FILLS):
        later = rows.drop("before").join(gaps, null_safe(F.col("source"), F.col("at"))).where(
            ~_taken("v", "last", "below") & ~F.array_contains("extra", F.col("v")))
        gap = F.col("rest") - F.col("got")
        miss = F.abs(F.col("size") - gap)
        if step < FILLS - 1:
            later = later.where(F.col("size") <= gap)
        best = later.groupBy(F.col("source").alias("at4")).agg(
            F.min_by(F.struct("v", "size", miss.alias("miss"), gap.alias("gap")), F.struct(miss, "v")).alias("e"))
        best = best.where("e.miss < e.gap")
        gaps = _beside_rows(cut(gaps.join(best, null_safe(F.col("at"), F.col("at4")), "left").select(
            "at", "last", "below", (F.col("got") + F.coalesce("e.size", F.lit(0))).alias("got"),
            F.when(F.col("e").isNull(), F.col("extra")).otherwise(
                F.concat("extra", F.array("e.v"))).alias("extra"))))
    out = per.join(gaps, null_safe(F.col("source"), F.col("at")), "left")
    whole_rest = F.when(F.col("rest") > 0, F.lit(2.0)).otherwise(F.lit(-1.0))  # no crossing: all or none
    return _beside_rows(cut(out.select("source", "w", "source_size", "target", "whole", "p", "rest",
                          F.coalesce("last", whole_rest).alias("last"),
                          F.coalesce("below", F.lit(False)).alias("below"),
                          F.coalesce("extra", F.array().cast("array<double>")).alias("extra"))))


def _taken(v: str, last: str, below: str) -> Column:
    """At most ``last``; below it where ``last`` is only a bucket's lower end."""
    return F.when(F.col(below), F.col(v) < F.col(last)).otherwise(F.col(v) <= F.col(last))


def ranked(sizes: DataFrame, per: DataFrame) -> DataFrame:
    per = per.withColumnsRenamed({"source": "of", "w": "of_w"})
    return sizes.join(per, null_safe(F.col("source"), F.col("of")) & (F.col("w") == F.col("of_w")), "left").drop(
        "of", "of_w").withColumn("v", _ratio(F.col("p")))


def copies(sizes: DataFrame, chosen: DataFrame, max_copies: int = 2) -> DataFrame:
    """``sizes`` with source_size, target and the copies taken of each row."""
    more = (_taken("v", "last", "below") | F.array_contains("extra", F.col("v"))) & (F.col("rest") > 0) & (F.col("w") > 0)
    return ranked(sizes, chosen).withColumn("copies", F.least(
        F.lit(max_copies).cast("bigint"), F.col("whole") + more.cast("bigint")))


def mix_report(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
               max_copies: int = 2, seed: int = 42, **cols: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies per document.

    Null or empty texts have size 0 and take nothing; null sources are one
    source, last in order; repeated rows of one document are taken alike;
    an empty table gives an empty result. The hash of id and text decides,
    so reruns agree whatever the partitions.
    """
    sizes = cut(sized(docs, seed=seed, **cols))
    out = copies(sizes, plan(sizes, weights, share, max_copies), max_copies)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
        max_copies: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weight_col: str | None = None) -> DataFrame:
    """``docs`` as mixed: its own columns, one row for each copy taken.

    Words are counted once to plan and once to apply the plan, so the texts
    themselves are never shuffled.
    """
    names = {"id_col": id_col, "text_col": text_col, "source_col": source_col}
    chosen = plan(cut(sized(docs, weight_col=weight_col, seed=seed, **names)), weights, share, max_copies)
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
    names = {"doc_id": id_col, "text": text_col, "source": source_col, "row": "__row"} | ({"w": weight_col} if weight_col else {})
    whole = columns(docs.withColumn("__row", row), **names).select("row", "source", *_row_figures(seed, weight_col))
    out = copies(whole, chosen, max_copies)
    out = out.where("copies > 0 AND size > 0").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return out.select("row.*")
