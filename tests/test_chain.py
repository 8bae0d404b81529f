"""Chained ingest, retries, retention that deletes, compaction of stream tables, complete progress."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.timing import DAY
from pulsegrid.operators import views
from pulsegrid.operators.windows import window_metrics
from pulsegrid.sources import retries, tables
from pulsegrid.sources.tables import drop_expired, read_raw_events
from pulsegrid.streaming import jobs
from pulsegrid.streaming.chain import read_chain
from pulsegrid.streaming.progress import ProgressLog
from pulsegrid.streaming.sources import read_files

M = 60_000
HOUR = {"tumbling_1h": 60 * M}
MESSAGE = "value string, received_at bigint"
EVENT = "id string, tenant_id string, user_id string, event_type string, source string, timestamp bigint, version int, payload string, labels map<string,string>"


def message(i, ts, at, tenant="007", kind="e"):
    return (f'{{"id":"{i}","tenant_id":"{tenant}","event_type":"{kind}","timestamp":{ts},"payload":{{"value":{i % 10}.5}},"labels":{{"a":"b"}}}}', at)


def batches():
    """Five files: steady events, copies in later files, a late event, broken ones."""
    out, t0 = [], 10 * DAY
    for b in range(5):
        rows = [message(b * 100 + i, t0 + (b * 100 + i) * M, t0 + (b * 100 + i) * M + 10) for i in range(100)]
        if b:
            rows += [message(b * 100 - 50 + i, t0 + (b * 100 - 50 + i) * M, t0 + b * 100 * M + i) for i in range(20)]
        rows.append(message(9000 + b, t0 + b * 100 * M - 60 * M, t0 + b * 100 * M + 50))
        rows += [("{broken", t0 + b * 100 * M + 60), message(8000 + b, 0, t0 + b * 100 * M + 61, kind="")]
        out.append(rows)
    return out


def test_chain_with_failures_between_batches_equals_the_batch_result(spark, tmp_path):
    root, source = str(tmp_path / "root"), str(tmp_path / "messages")
    schema = spark.createDataFrame([], MESSAGE).schema
    chain = lambda: read_chain(spark, source, schema, root)
    for b, rows in enumerate(batches()):
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(source)
        if b == 2:  # the landing job dies in the middle of a micro-batch, and leaves files that were never committed
            broken = chain()
            broken.rows = broken.rows.withColumn("id", F.when(F.col("id") == "250", F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
            with pytest.raises(Exception, match="lost"):
                jobs.run_available(broken.start_landing())
            orphan = Path(root) / "landing" / "part-00000-orphan.snappy.parquet"
            orphan.write_bytes(next(Path(root, "landing").glob("part-*.parquet")).read_bytes())
        if b == 3:  # a later job does not run this time
            jobs.run_available(chain().start_landing())
        else:
            chain().run_available(HOUR)
    events, dlq = chain().read("events"), chain().read("dlq")
    ids = [r.id for r in events.select("id").collect()]
    assert sorted(map(int, ids)) == sorted([*range(500), *range(9000, 9005)])
    assert {(r.tenant_id, r.late) for r in events.where("cast(id AS int) >= 9000").selectExpr("tenant_id", "labels['late_arrival'] AS late").collect()} == {("007", "true")}
    assert events.where("labels['a'] = 'b' AND payload IS NOT NULL").count() == 505
    assert sorted((r.error, r.n) for r in dlq.groupBy("error").agg(F.count("*").alias("n")).collect()) == [("invalid JSON", 5), ("invalid event", 5)]
    on_time = events.where("NOT is_late").withColumn("value", F.expr("id % 10 + 0.5D"))
    closed = window_metrics(on_time, HOUR).where(F.col("window_end") <= 10 * DAY + 499 * M - 5 * M)
    names = ["tenant_id", "event_type", "window_start", "count", "sum", "p99"]
    assert sorted(chain().read("windows").select(*names).collect()) == sorted(closed.select(*names).collect())
    assert closed.count() == 8


def event(i, ts=1_700_000_000_000, tenant="t"):
    return (str(i), tenant, "u", "e", "s", ts, 1, "{}", {"k": "v"})


def test_attempts_are_counted_and_given_up_after_three(spark, tmp_path):
    path = str(tmp_path / "log")
    new = {1: ["a", "b", "c"], 2: ["d"], 3: [], 4: ["c"]}
    fails = {1: {"a", "b", "c"}, 2: {"a", "c"}, 3: {"c"}, 4: set()}

    def run(n):
        attempt = lambda df: df.withColumn("error", F.when(F.col("id").isin(*fails[n], ""), F.lit("down")))
        return retries.run_attempts(spark, spark.createDataFrame([event(i) for i in new[n]], EVENT), path, n, attempt)

    for n in (1, 2, 2, 3, 4):  # the second run is done twice
        run(n)
    log = spark.read.parquet(path)
    assert sorted((r.id, r.attempts) for r in log.where("outcome = 'stored'").collect()) == [("a", 3), ("b", 2), ("c", 1), ("d", 1)]
    dead = retries.dead_letters(log, "timestamp").collect()
    assert [(r.original_event.id, r.error, r.attempts) for r in dead] == [("c", "down", 3)]


def test_reprocessing_passes_dedup_and_counts_on(spark):
    failed = spark.createDataFrame([(*event(i), "down") for i in (1, 2, 2, 3)], EVENT + ", error string")
    dlq = tables.to_dead_letters(failed, "error", 5)
    stored = spark.createDataFrame([event(1)], EVENT)
    fresh, still = retries.reprocessed(dlq, lambda df: df.withColumn("error", F.when(F.col("id") == "3", F.lit("still"))), stored)
    assert [r.id for r in fresh.collect()] == ["2"] and sorted(fresh.columns) == sorted(tables.EVENT_COLUMNS)
    assert [(r.original_event.id, r.error, r.attempts, r.failed_at) for r in still.collect()] == [("3", "still", 4, 5)]


def test_retention_deletes_whole_days_and_nothing_else(spark, tmp_path):
    path, now = str(tmp_path / "raw"), 200 * DAY
    rows = [event(i, now - i * DAY, t) for i in range(0, 100, 5) for t in ("a", "b")] + [event("x", now - 95 * DAY, "old")]
    tables.write_raw_events(spark.createDataFrame(rows, EVENT), path, partitions=2)
    before = {f: f.read_bytes() for f in Path(path).rglob("*.parquet")}
    listed = read_raw_events(spark, path)
    named = drop_expired(spark, path, now, dry_run=True)
    assert len(named) == 3 and len(before) == len(list(Path(path).rglob("*.parquet")))
    assert drop_expired(spark, path, now) == named and drop_expired(spark, path, now) == []
    left = {f: f.read_bytes() for f in Path(path).rglob("*.parquet")}
    assert left.items() <= before.items() and not (Path(path) / "tenant_id=old").exists()
    kept = tables.retain(spark.createDataFrame(rows, EVENT), now).count()
    assert read_raw_events(spark, path).count() == kept == listed.count() == len(rows) - 3


def test_view_totals_do_not_change_with_compaction(spark, tmp_path):
    source, target = str(tmp_path / "m"), str(tmp_path / "compact")
    rows = spark.range(400).selectExpr("'t' AS tenant_id", "'e' AS event_type", "concat('u', id % 7) AS user_id", "id * 1000 AS timestamp", "id % 8 AS b")
    write = jobs.per_batch_writer(source, lambda df: views.minute_partials(df))
    add = lambda *ids: [write(rows.where(F.col("b") == b).drop("b"), b) for b in ids]
    total = lambda: sorted(views.merge_minute_partials(views.read_view(spark, source, target)).collect())
    want = lambda n: sorted(views.events_per_minute(rows.where(F.col("b") < n)).collect())
    assert views.compact_batches(spark, source, target, views.compact_minute_partials) is None
    add(0, 1, 2, 3)
    assert total() == want(4)
    assert views.compact_batches(spark, source, target, views.compact_minute_partials) == 2
    assert total() == want(4)
    add(3, 4, 5)  # the newest batch is written again
    with pytest.raises(Exception, match="lost"):  # a run that dies while it writes
        views.compact_batches(spark, source, target, lambda df: views.compact_minute_partials(df).withColumn("sum_state", F.raise_error(F.lit("lost")).cast("double")))
    assert total() == want(6)
    assert views.compact_batches(spark, source, target, views.compact_minute_partials) == 4
    assert total() == want(6)
    assert views.drop_compacted(spark, source, target) == [f"batch_id={b}" for b in range(5)] + ["upto=2"]
    assert total() == want(6)
    add(6, 7)
    assert views.compact_batches(spark, source, target, views.compact_minute_partials) == 6 and total() == want(8)


def test_months_of_a_stream_table(spark, tmp_path):
    source, target = str(tmp_path / "r"), str(tmp_path / "months")
    rows = spark.range(90).selectExpr("'t' AS tenant_id", "1704067200000 + id * 86400000 AS hour", "1.0D AS revenue", "id % 3 AS b")
    write = jobs.per_batch_writer(source)
    for b in range(3):
        write(rows.where(F.col("b") == b).drop("b"), b)
    views.compact_months(spark, source, target, views.merge_revenue, ["202402"])
    assert spark.read.parquet(target).agg(F.sum("revenue")).first()[0] == 29.0
    views.compact_months(spark, source, target, views.merge_revenue)
    assert spark.read.parquet(target).agg(F.sum("revenue")).first()[0] == 90.0


def test_all_progress_is_kept(spark, tmp_path):
    source, n = str(tmp_path / "in"), 150
    spark.range(n).repartition(n).write.parquet(source)
    files = len(list(Path(source).glob("*.parquet")))
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        query = read_files(spark, source, spark.range(1).schema, max_files=1).writeStream.queryName("many").format("noop").trigger(availableNow=True).start()
        query.awaitTermination()
        for _ in range(60):  # reports come in after the query has ended
            rows = log.table().where("input_rows > 0")
            if rows.count() >= files:
                break
            time.sleep(1)
        assert files > 100 and len(query.recentProgress) < files
        assert rows.select("batch_id").distinct().count() == rows.count() == files
        assert rows.agg(F.sum("input_rows")).first()[0] == n
    finally:
        spark.streams.removeListener(log)


def test_a_days_events_lie_in_few_files_however_many_tasks(spark, tmp_path):
    root, source, t0 = str(tmp_path / "root"), str(tmp_path / "messages"), 10 * DAY
    spark.createDataFrame([message(i, t0 + i * M, t0 + i * M) for i in range(1400)], MESSAGE).write.parquet(source)
    chain = read_chain(spark, source, spark.createDataFrame([], MESSAGE).schema, root, max_files=None)
    jobs.run_available(chain.start_landing())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        jobs.run_available(chain.start_events())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert chain.read("events").count() == 1400
    assert len(list(Path(root, "events").rglob("*.parquet"))) <= 4
