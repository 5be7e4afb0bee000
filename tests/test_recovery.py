"""Interrupted streams, sides that lag, per-partition state, the committing sink."""

import datetime as dt
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakeloom.plans import streams, streams_kept
from lakeloom.streaming import ledger_sink, ops, recovery, sinks, stateful
from lakeloom.streaming.replay import (
    read_sink,
    run_available_now,
    run_in_drops,
    run_side_by_side,
    run_while_arriving,
)
from lakeloom.streaming.sources import file_stream
from lakeloom.tables import load
from tests.conftest import SF001

T0 = dt.datetime(2024, 1, 1)


def test_the_slow_side_holds_the_watermark_back(spark):
    """Under ``min`` no unmatched view is given up before the clicks are past it, and
    nothing is lost; under ``max`` the fast side's clock gives views up too early."""
    seen = []
    rounds = streams_kept.lagging_rounds(spark, SF001)
    out = run_side_by_side(rounds, streams_kept.join_views_clicks, "append", "twomin",
                           after_round=lambda i, df: seen.append(df.where("click_id IS NULL").count()))
    held = out.where("view_id >= 0")
    pairs = held.where("click_id IS NOT NULL").count()
    batch = streams._views_clicks(ops.event_time(load(spark, SF001, "events"), "ts"))
    plain = streams_kept.join_views_clicks(*batch)
    assert held.exceptAll(plain).count() == 0 and plain.exceptAll(held).count() == 0
    # One round behind: when all views are there, those beside the last clicks still wait.
    assert seen[0] == 0 and seen[1] < 0.5 * seen[-1] and seen[2] < 0.8 * seen[-1]

    fast = run_side_by_side(rounds, streams_kept.join_views_clicks, "append", "twomax", policy="max").where("view_id >= 0")
    assert fast.where("click_id IS NOT NULL").count() < pairs
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min") == "min"


def _records(spark, rows):
    return spark.createDataFrame([("t", p, o, T0 + dt.timedelta(minutes=m) if m is not None else None, d) for p, o, m, d in rows],
                                 "topic string, partition int, offset bigint, timestamp timestamp, data string")


def test_a_replayed_batch_counts_once_and_twice(spark, tmp):
    """The exactly-once ledger overwrites what the dead batch wrote; an at-least-once
    consumer that appends has those rows twice."""
    drops = [_records(spark, [(0, i, i, f"a{i}") for i in range(10)]), _records(spark, [(1, i, i, f"b{i}") for i in range(10)])]
    died = []

    def process(batch, batch_id):
        batch.write.mode("append").parquet(f"{tmp}/appended")
        if batch_id == 1 and not died:
            died.append(batch_id)
            raise RuntimeError("after the write")

    writers = {"once": recovery.dies_midway(sinks.offset_ledger_writer(f"{tmp}/once", "data"), 1, F.lit(True)),
               "twice": sinks.at_least_once_writer(f"{tmp}/starts", process)}
    failures = {}
    for name, write in writers.items():
        for i, drop in enumerate(drops):
            drop.write.parquet(f"{tmp}/in-{name}/d{i}")
            run = lambda attempt: run_available_now(
                file_stream(spark, f"{tmp}/in-{name}/d*", drop.schema), None, "append", name,
                foreach_batch=lambda _: write, base=f"{tmp}/{name}-q")
            failures[name, i] = recovery.run_with_restarts(run)[1]
    assert failures == {("once", 0): 0, ("once", 1): 1, ("twice", 0): 0, ("twice", 1): 1}
    once = spark.read.parquet(f"{tmp}/once")
    assert sorted((r.batch_id, r.partition, r.until_offset) for r in once.collect()) == [(0, 0, 10), (1, 1, 10)]
    counts = spark.read.parquet(f"{tmp}/appended").groupBy("partition").count().collect()
    assert {r.partition: r["count"] for r in counts} == {0: 10, 1: 20}


def test_a_query_that_keeps_failing_passes_the_failure_on(spark, tmp):
    spark.range(5).write.parquet(f"{tmp}/in/d0")

    def run(attempt):
        rows = recovery.failing_rows(file_stream(spark, f"{tmp}/in/d*", "id bigint"), F.col("id") == 3, "id")
        return run_available_now(rows, "parquet", "append", "dies", base=f"{tmp}/q")

    with pytest.raises(StreamingQueryException):
        recovery.run_with_restarts(run, most=2)
    with pytest.raises(ValueError):
        recovery.run_with_restarts(run, most=0)


def _gaps(spark, drops, **options):
    with recovery.session_conf(spark, recovery.ROCKSDB):
        out = run_in_drops([_records(spark, d) for d in drops], lambda s: stateful.offset_gaps(s, **options),
                           "parquet", "append", "testgaps")
        return sorted(((r.kind, r.partition, r.from_offset, r.to_offset, r.n_missing, r.data) for r in out.collect()), key=str)


def test_offset_gaps_over_batches_and_restarts(spark):
    """Gaps inside a batch and over a restart, replays, a record without an offset, a null
    partition; a partition that falls silent is closed and starts anew."""
    drops = [
        [(0, 5, 0, "a"), (0, 3, 1, "b"), (0, 4, 2, "c"), (1, 10, 0, "x"), (None, 7, 0, "n"), (0, None, 3, "no")],
        [(0, 9, 10, "d"), (0, 4, 11, "replay"), (1, 11, 12, "y"), (0, 9, 12, "again")],
        [(0, 10, 300, "e")],          # moves the clock on: partitions 1 and null have been silent
        [(1, 50, 310, "z"), (0, 12, 310, "f")],
        [(2, 0, 10_000, "end")],
    ]
    assert _gaps(spark, drops, delay="1 minute", idle_ms=3_600_000) == sorted([
        ("gap", 0, 5, 9, 3, None), ("idle", 1, 11, 11, 0, "y"), ("idle", None, 7, 7, 0, "n"),
        ("gap", 0, 10, 12, 1, None), ("idle", 0, 12, 12, 4, "f"), ("idle", 1, 50, 50, 0, "z")], key=str)


def test_only_payloads_that_may_be_last_go_to_the_state_function(spark):
    """Of a batch of records few payloads are kept: those that no greater offset outdoes in time."""
    rng = random.Random(4)
    schema = "topic_key string, partition_key string, offset bigint, at timestamp, at_ms bigint, data string"
    at = [T0 + dt.timedelta(seconds=i) for i in range(400)]
    for spread in (0, 1, 30, 400):
        rows = [("=t", f"={rng.randrange(3)}", i // 2, t, 0, f"p{i}")
                for i, t in ((i, at[min(399, max(0, i + rng.randint(-spread, spread)))]) for i in range(400))]
        rng.shuffle(rows)
        got = spark.createDataFrame(rows, schema).coalesce(1).mapInArrow(stateful._front(), schema).collect()
        assert [tuple(r)[:5] for r in got] == [r[:5] for r in rows]
        for r, g in zip(rows, got):
            outdone = any(o[1] == r[1] and o[2] > r[2] and o[3] >= r[3] for o in rows)
            assert g.data == (None if outdone else r[5])
    assert spark.createDataFrame([], schema).mapInArrow(stateful._front(), schema).count() == 0


def test_offset_gaps_send_few_payloads_to_the_state_function(spark, monkeypatch):
    """Ten thousand records of four partitions: all are counted, a few payloads are sent."""
    sent = spark.sparkContext.accumulator(0)
    processor = stateful._processor

    def counting(*args):
        inner = processor(*args)
        handle = inner.handleInputRows

        def rows_seen(key, rows, timers):
            def each():
                for part in rows:
                    sent.add(int(part["data"].notna().sum()))
                    yield part
            return handle(key, each(), timers)
        inner.handleInputRows = rows_seen
        return inner

    monkeypatch.setattr(stateful, "_processor", counting)
    rows = [(i % 4, i, i, f"p{i}") for i in range(10_000)]
    got = _gaps(spark, [rows, [(9, 0, 10_000_000, "end")]], delay="1 minute", idle_ms=3_600_000)
    assert [g for g in got if g[0] == "idle"] == [("idle", p, 9996 + p, 9996 + p, 3 * 2499, f"p{9996 + p}") for p in range(4)]
    assert len(got) == 4 + 4 * 2499 and sent.value <= 400


def test_state_runs_out_by_its_time_to_live(spark, tmp):
    """Long-lived state links two batches of a query; state that has run out does not."""
    found = {}
    for ttl in (1_000, 600_000):
        batches = []
        _records(spark, []).write.parquet(f"{tmp}/{ttl}/d_none")
        with recovery.session_conf(spark, recovery.ROCKSDB):
            out = stateful.offset_gaps(file_stream(spark, f"{tmp}/{ttl}/d*", _records(spark, []).schema), ttl_ms=ttl)
            query = (out.writeStream.foreachBatch(lambda df, n: batches.append((n, [tuple(r) for r in df.collect()])))
                     .option("checkpointLocation", f"{tmp}/q{ttl}").trigger(processingTime="500 milliseconds").start())
        try:
            for i, rows in enumerate(([(0, 1, 0, "a")], [(0, 9, 1, "b")])):
                _records(spark, rows).coalesce(1).write.parquet(f"{tmp}/{ttl}/d{i}")
                end = time.time() + 40
                while time.time() < end and sum(p["numInputRows"] for p in query.recentProgress) <= i:
                    time.sleep(0.2)
                time.sleep(3)
        finally:
            query.stop()
        found[ttl] = [(r[0], r[3], r[5]) for _, rows in batches for r in rows]
    assert found == {1_000: [], 600_000: [("gap", 1, 7)]}


def test_a_failed_task_leaves_no_entry(spark, tmp):
    """The second batch dies in a task: nothing of it is in the ledger; its rerun commits it whole."""
    ledger_sink.register(spark)
    drops = [[(0, 1, 0, "a"), (1, 5, 0, "b"), (None, 2, 0, "n")], [(0, 8, 1, "c"), (1, 2, 1, "rewound"), (2, 0, 1, None)]]
    for i, rows in enumerate(drops):
        _records(spark, rows).repartition(3).write.parquet(f"{tmp}/in/d{i}")

        def run(dies):
            s = file_stream(spark, f"{tmp}/in/d*", _records(spark, []).schema)
            s = recovery.failing_rows(s, F.col("offset") == 8, "topic") if dies else s
            run_available_now(s.select("topic", "partition", "offset", "data"), ledger_sink.FORMAT, "append", "led", base=f"{tmp}/q")

        if i:
            with pytest.raises(StreamingQueryException):
                run(True)
            assert ledger_sink.ledger(spark, f"{tmp}/q/sink").where("batch_id = 1").count() == 0
        run(False)
    rows = ledger_sink.ledger(spark, f"{tmp}/q/sink")
    assert sorted(((r.batch_id, r.partition, r.until_offset, r.data) for r in rows.collect()), key=str) == sorted([
        (0, 0, 2, "a"), (0, 1, 6, "b"), (0, None, 3, "n"), (1, 0, 9, "c"), (1, 1, 3, "rewound"), (1, 2, 1, None)], key=str)
    last = {r.partition: (r.until_offset, r.data) for r in sinks.committed_offsets(rows).collect()}
    assert last[1] == (3, "rewound") and last[0] == (9, "c")
    assert ledger_sink.ledger(spark, f"{tmp}/nothing").count() == 0


def test_records_without_a_time_are_in_the_ledger(spark):
    """The drops of the ledger jobs hold every record, whatever its time."""
    rows = _records(spark, [(0, 1, None, "a"), (0, 2, 0, "b"), (0, 3, 60, "c"), (0, 4, 600_000, "d")])
    drops = streams.time_drops(rows, "timestamp")
    assert sum(d.count() for d in drops) == 4 and drops[0].where("timestamp IS NULL").count() == 1
    assert [d.count() for d in streams.time_drops(rows.where("timestamp IS NULL"), "timestamp")] == [1]
    assert sum(d.count() for d in streams.time_drops(rows, "offset")) == 4


def test_streams_of_empty_tables(spark, tmp):
    """No batch runs: results are empty, with their columns."""
    names = ("events", "orders", "documents", "customer", "nation", "region")
    for name in names:
        load(spark, SF001, name).limit(0).write.parquet(f"{tmp}/sf/{name}.parquet")
    from lakeloom.plans.registry import all_queries

    queries = all_queries()
    for name in ("stream_kafka_to_parquet", "stream_filter", "stream_csv", "stream_line_word_count", "stream_parquet",
                 "stream_commit_ledger", "stream_offset_ledger", "stream_resume", "stream_processing_time"):
        out = queries[name](spark, f"{tmp}/sf")
        assert out.count() == 0 and out.columns, name


def test_a_query_that_stays_up_sees_what_arrives(spark):
    drops = [spark.createDataFrame([(w,) for w in words], "w string") for words in ("ab", "bc", "a")]
    log = run_while_arriving(drops, lambda s: ops.running_count(s, ["w"]), "update", "up", sinks.batch_log_writer)
    assert {r.w: r.cnt for r in sinks.latest_revision(log, ["w"]).collect()} == {"a": 2, "b": 2, "c": 1}
    assert log.select("batch_id").distinct().count() == 3
    assert not spark.streams.active
