"""One key holding a third of the rows: results stay exact and whole."""

import duckdb
from pyspark.sql import functions as F

from lakeloom.operators import aggregate as agg
from lakeloom.operators import joins, windows
from tests.conftest import SF01


def skewed(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    # every third event is re-assigned to user 0
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                         .otherwise(F.col("user_id")))


def duck_skewed():
    con = duckdb.connect()
    con.execute(f"""CREATE VIEW ev AS SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0
                    ELSE user_id END AS user_id) FROM read_parquet('{SF01}/events.parquet')""")
    return con


def test_hot_key_dedup_top_n_totals(spark):
    ev = skewed(spark)
    con = duck_skewed()
    d = agg.dedup_keep_first(ev.select("event_id", "ts", "user_id", "event_type"),
                             ["user_id", "event_type"], ["ts", "event_id"])
    want = con.execute("""SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY
        user_id, event_type ORDER BY ts, event_id) rn FROM ev) WHERE rn = 1""").fetchall()
    assert sorted(r.event_id for r in d.collect()) == sorted(r[0] for r in want)

    counts = agg.count_by_group(ev, ["event_type", "user_id"])
    top = windows.top_n_per_group(counts, ["event_type"], [F.desc("cnt"), F.asc("user_id")], 1)
    assert {r.user_id for r in top.collect()} == {0}

    tot = windows.attach_group_totals(ev.select("event_id", "user_id"), ["user_id"],
                                      {"n": F.count(F.lit(1))})
    assert tot.where("user_id = 0").select(F.min("n"), F.max("n")).first()[0] == \
        con.execute("SELECT count(*) FROM ev WHERE user_id = 0").fetchall()[0][0]
    assert tot.count() == 10_000


def test_hot_key_interval_join(spark):
    ev = skewed(spark)
    views = ev.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id",
                                                   F.col("ts").alias("view_ts"))
    clicks = ev.where("event_type = 'click'").select(F.col("event_id").alias("click_id"),
                                                     "user_id", F.col("ts").alias("click_ts"))
    got = joins.interval_join(views, clicks, "user_id", "view_ts", "click_ts", 0, 3600)
    want = duck_skewed().execute("""SELECT count(*) FROM ev v JOIN ev c ON v.user_id = c.user_id
        AND c.event_type = 'click' AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR
        WHERE v.event_type = 'view'""").fetchall()[0][0]
    assert got.count() == want
