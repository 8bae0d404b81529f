import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.slo import consumer_lag
from pulsegrid.operators.views import events_per_minute, merge_minute_partials
from pulsegrid.operators.windows import window_metrics
from pulsegrid.streaming import jobs, stateful
from pulsegrid.streaming.progress import progress_rows, topic_offsets
from pulsegrid.streaming.sources import read_files

SIMPLE = "id string, tenant_id string, user_id string, event_type string, timestamp bigint, value double, amount double"


class Feed:
    """A folder that receives one file per call, in order."""

    def __init__(self, spark, path, schema=SIMPLE):
        self.spark, self.path, self.schema = spark, str(path), schema

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        return read_files(self.spark, self.path, schema, max_files=1)


@pytest.fixture
def feed(spark, tmp_path):
    jobs.use_rocksdb(spark)
    return Feed(spark, tmp_path / "in")


def ev(i, ts, tenant="t", user="u", kind="e", value=1.0):
    return (str(i), tenant, user, kind, ts, value, 0.0)


M = 60_000


def test_late_events_are_kept_out_of_closed_windows(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    start = lambda: jobs.run_available(
        jobs.start_window_metrics(feed.stream(), f"{out}/data", f"{out}/cp", {"tumbling_1m": M})
    )
    feed.add([ev(1, 10), ev(2, 20), ev(3, M * 2)])
    start()
    feed.add([ev(4, M * 20)])
    start()  # watermark: minute 15
    feed.add([ev(5, 30), ev(6, M * 40)])  # 30 ms is 20 minutes late
    start()
    got = {r["window_start"]: r["count"] for r in spark.read.parquet(f"{out}/data").collect()}
    assert got == {0: 2, M * 2: 1, M * 20: 1}


def test_stream_equals_batch_on_closed_windows(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    rows = [ev(i, (i * 7919) % (2 * 3_600_000), f"t{i % 3}", f"u{i % 11}", value=float(i % 97)) for i in range(3000)]
    rows.sort(key=lambda r: r[4])
    for part in range(3):
        feed.add(rows[part * 1000 : (part + 1) * 1000])
        jobs.run_available(jobs.start_window_metrics(feed.stream(), f"{out}/data", f"{out}/cp"))
    feed.add([ev(9999, 10 * 3_600_000)])
    jobs.run_available(jobs.start_window_metrics(feed.stream(), f"{out}/data", f"{out}/cp"))
    names = ["tenant_id", "event_type", "window_type", "window_start", "count", "p99"]
    stream = spark.read.parquet(f"{out}/data").select(*names)
    batch = window_metrics(spark.createDataFrame(rows, SIMPLE)).select(*names)
    assert sorted(stream.collect()) == sorted(batch.collect())


def test_stream_dedup_keeps_the_first_within_the_horizon(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    day = 86_400_000
    writer = lambda: jobs.run_available(
        jobs.drop_duplicates(feed.stream(), ["id"]).select("id", "timestamp").writeStream.outputMode("append")
        .option("checkpointLocation", f"{out}/cp").foreachBatch(jobs.per_batch_writer(f"{out}/data"))
    )
    for rows in ([ev("a", 1)], [ev("a", 5), ev("b", 6)], [ev("c", 3 * day)], [ev("a", 3 * day + 1)]):
        feed.add(rows)
        writer()
    got = sorted((r["id"], r["timestamp"]) for r in spark.read.parquet(f"{out}/data").collect())
    assert got == [("a", 1), ("a", 3 * day + 1), ("b", 6), ("c", 3 * day)]


def test_exact_dedup_over_micro_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path / "d", "id string, timestamp bigint, seq bigint")
    out, hour = str(tmp_path / "o"), 3_600_000
    for rows in ([("a", 0, 1), ("a", 5, 2), ("b", hour, 3)], [("a", 20 * hour, 4), ("a", 24 * hour, 5), ("a", 25 * hour, 6)],
                 [("a", 47 * hour, 7), ("b", 26 * hour, 8), ("a", 48 * hour, 9)]):
        feed.add(rows)
        jobs.run_available(jobs.start_exact_dedup(feed.stream(), ["id"], out, f"{out}/cp"))
    assert sorted(r["seq"] for r in spark.read.parquet(f"{out}/accepted").collect()) == [1, 3, 5, 8, 9]


def test_repeated_batch_leaves_no_copies(spark, tmp_path):
    write = jobs.per_batch_writer(str(tmp_path / "t"))
    for batch_id in (0, 1, 1, 0):
        write(spark.range(5), batch_id)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_views_from_increments(spark, feed, tmp_path):
    out = str(tmp_path / "v")
    rows = [ev(i, i * 1000, user=f"u{i % 4}") for i in range(300)]
    for part in range(3):
        feed.add(rows[part::3])
        jobs.run_available(jobs.start_views(feed.stream(), f"{out}/m", f"{out}/r", f"{out}/cp"))
    got = merge_minute_partials(spark.read.parquet(f"{out}/m").drop("batch_id"))
    assert sorted(got.collect()) == sorted(events_per_minute(spark.createDataFrame(rows, SIMPLE)).collect())


def test_history_survives_between_runs(spark, tmp_path):
    schema = "tenant_id string, event_type string, window_start bigint, count bigint"
    feed = Feed(spark, tmp_path / "w", schema)
    jobs.use_rocksdb(spark)
    out = str(tmp_path / "s")

    def run():
        scored = stateful.score_windows(feed.stream(), history=10)
        jobs.run_available(
            scored.writeStream.outputMode("append").option("checkpointLocation", f"{out}/cp")
            .foreachBatch(jobs.per_batch_writer(f"{out}/data"))
        )

    rng = random.Random(6)
    steady = [rng.randint(45, 55) for _ in range(10)]
    feed.add([("a", "e", i, c) for i, c in enumerate(steady)])
    run()
    feed.add([("a", "e", 10, 1000), ("b", "e", 10, 1)])
    run()
    flagged = spark.read.parquet(f"{out}/data").where("is_anomaly").collect()
    assert [(r["tenant_id"], r["count"]) for r in flagged] == [("a", 1000)]


def test_cooldown_survives_between_runs(spark, tmp_path):
    feed = Feed(spark, tmp_path / "c", "rule_id string, tenant_id string, fired_at bigint")
    jobs.use_rocksdb(spark)
    out = str(tmp_path / "f")
    for times in ([0, 60_000], [299_999], [300_000, 360_000], [900_000]):
        feed.add([("r", "t", t) for t in times])
        jobs.run_available(
            stateful.apply_cooldown(feed.stream()).writeStream.outputMode("append")
            .option("checkpointLocation", f"{out}/cp").foreachBatch(jobs.per_batch_writer(f"{out}/data"))
        )
    assert sorted(r["fired_at"] for r in spark.read.parquet(f"{out}/data").collect()) == [0, 300_000, 900_000]


def test_gate_and_scorer_without_a_stream():
    scorer = stateful.HistoryScorer(60, 10, 3.0)
    assert scorer._score([1] * 9, 500) == 0.0
    assert scorer._score([5] * 10, 500) == 0.0
    assert scorer._score([1, 3] * 5, 5) == 3.0


def test_hot_table_drops_old_windows(spark):
    df = spark.createDataFrame([(0,), (10_000_000,), (17_200_000,)], "window_end bigint")
    assert sorted(r[0] for r in jobs.hot_windows(df).collect()) == [10_000_000, 17_200_000]
    assert jobs.hot_windows(df, now_ms=30_000_000).count() == 0


def test_progress_becomes_lag(spark, feed):
    feed.add([ev(1, 1)])
    query = feed.stream().writeStream.format("noop").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = progress_rows(spark, query)
    assert rows.agg(F.sum("input_rows")).first()[0] == 1
    report = [{"endOffset": {"events": {"0": 10, "1": 20}}, "latestOffset": {"events": {"0": 15, "1": 20}}}]
    fake = rows.limit(1).withColumn("sources", F.lit(pd.Series(report).to_json(orient="values")))
    offsets = topic_offsets(fake)
    assert consumer_lag(offsets).first()["lag"] == 5


def test_memory_sink_collects_published_events(spark, feed):
    feed.add([ev(i, i) for i in range(3)])
    query = feed.stream().writeStream.format("memory").queryName("published").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("published").count() == 3


def test_routing_before_write_keeps_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], T.StructType([T.StructField("tenant_id", T.StringType())]))
    routed = jobs.route_by_tenant(df, 4)
    assert routed.count() == 3
    per = routed.select("tenant_id", F.spark_partition_id().alias("p")).distinct()
    assert per.count() == 2


def states(spark, checkpoint):
    return spark.read.format("statestore").option("stateVarName", "state").load(checkpoint)


def test_exact_dedup_over_restarts_keeps_only_live_keys(spark, tmp_path):
    feed = Feed(spark, tmp_path / "d", "id string, timestamp bigint, seq bigint")
    jobs.use_rocksdb(spark)
    out, hour, rng = str(tmp_path / "o"), 3_600_000, random.Random(3)
    rows = sorted((rng.randrange(96 * hour), f"k{rng.randrange(40)}") for _ in range(600))
    rows = [(k, t, i) for i, (t, k) in enumerate(rows)]
    for part in range(4):  # each run is a restart
        mine = rows[part * 150 : part * 150 + 150]
        rng.shuffle(mine)
        feed.add(mine)
        jobs.run_available(jobs.start_exact_dedup(feed.stream(), ["id"], out, f"{out}/cp"))
    last, want = {}, set()
    for k, t, i in rows:
        if k not in last or t - last[k] >= 24 * hour:
            last[k] = t
            want.add(i)
    assert {r["seq"] for r in spark.read.parquet(f"{out}/accepted").collect()} == want
    assert 30 < states(spark, f"{out}/cp").count() <= 40
    for t in (300 * hour, 301 * hour):  # the watermark of a micro-batch is what the one before has seen
        feed.add([("new", t, t)])
        jobs.run_available(jobs.start_exact_dedup(feed.stream(), ["id"], out, f"{out}/cp"))
    assert {r["key"]["id"] for r in states(spark, f"{out}/cp").select("key").collect()} == {"new"}


def test_cooldown_state_ends(spark, tmp_path):
    feed = Feed(spark, tmp_path / "c", "rule_id string, tenant_id string, fired_at bigint")
    jobs.use_rocksdb(spark)
    out = str(tmp_path / "f")
    for rows in ([("a", "t", 0), ("b", "t", 1)], [("c", "t", 10**9)], [("d", "t", 10**9 + 1)]):
        feed.add(rows)
        jobs.run_available(
            stateful.apply_cooldown(feed.stream()).writeStream.outputMode("append")
            .option("checkpointLocation", f"{out}/cp").foreachBatch(jobs.per_batch_writer(f"{out}/data"))
        )
    assert spark.read.parquet(f"{out}/data").count() == 4
    assert {r["key"]["rule_id"] for r in states(spark, f"{out}/cp").select("key").collect()} == {"c", "d"}


def test_keys_of_a_bucket_share_state_and_differ_in_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path / "d", "a string, b string, timestamp bigint, seq bigint")
    out, hour, rng = str(tmp_path / "o"), 3_600_000, random.Random(4)
    keys = [(x, y) for x in ("p", "q", None, "p,q") for y in ("p", None, "r", "s")]
    rows = sorted((rng.randrange(120 * hour), i) for i in range(500))
    rows = [(*rng.choice(keys), t, i) for i, (t, _) in enumerate(rows)]
    for part in range(4):  # each run is a restart
        mine = rows[part * 125 : part * 125 + 125]
        rng.shuffle(mine)
        feed.add(mine)
        jobs.run_available(jobs.start_exact_dedup(feed.stream(), ["a", "b"], out, f"{out}/cp", buckets=3))
    last, want = {}, set()
    for *k, t, i in rows:
        if tuple(k) not in last or t - last[tuple(k)] >= 24 * hour:
            last[tuple(k)] = t
            want.add(i)
    assert {r["seq"] for r in spark.read.parquet(f"{out}/accepted").collect()} == want
    assert states(spark, f"{out}/cp").count() <= 3
    for t in (400 * hour, 401 * hour):
        feed.add([("new", "new", t, t)])
        jobs.run_available(jobs.start_exact_dedup(feed.stream(), ["a", "b"], out, f"{out}/cp", buckets=3))
    assert [list(r["value"]["taken"]) for r in states(spark, f"{out}/cp").collect()] == [['{"a":"new","b":"new"}']]
