"""Streaming jobs run over the events file as their source; results are read from their tables.

A stream closes a window once the watermark (newest event - 5 minutes) has passed its end, so the
SQL counts windows that end by then.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timing import HOUR
from ..operators.views import merge_minute_partials, merge_revenue
from ..operators.windows import window_counts
from ..schemas import WINDOW_METRICS
from ..session import shared_dir, use_utc
from ..sources.canonical import as_events, load_events
from ..streaming import jobs, stateful
from ..streaming.chain import read_chain
from ..streaming.sources import read_files
from . import ingest_queries  # noqa: F401  (registers dedup_24h)
from .fixtures import candidates, dirty, tidy
from .registry import ORACLES, check_sql, query

_CLOSED = "now - 300000"


def _event_stream(spark, sf_dir):
    use_utc(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return as_events(read_files(spark, sf_dir, schema, name_filter="events.parquet"))


def _run(spark, stream, name, transform=None):
    """Run an append-mode stream to the end and return its table."""
    jobs.use_rocksdb(spark)
    out = shared_dir(spark, name)
    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(jobs.per_batch_writer(f"{out}/data", transform))
    )
    jobs.run_available(writer)
    return spark.read.parquet(f"{out}/data").drop("batch_id")


@query("stream_window_metrics", check_sql(
    f"SELECT * EXCLUDE (now) FROM metrics, clock WHERE window_end <= {_CLOSED}", "metrics", "clock"))
def stream_window_metrics(spark, sf_dir):
    jobs.use_rocksdb(spark)
    out = shared_dir(spark, "stream-metrics")
    jobs.run_available(jobs.start_window_metrics(_event_stream(spark, sf_dir), f"{out}/data", f"{out}/checkpoint"))
    names = WINDOW_METRICS.fieldNames()
    return tidy(spark.read.parquet(f"{out}/data").select(*names))


@query("stream_sliding_counts", check_sql(f"""
    SELECT tenant_id, event_type, timestamp - timestamp % 600000 - i * 600000 AS window_start,
           timestamp - timestamp % 600000 - i * 600000 + 3600000 AS window_end, count(*) AS count
    FROM canon, range(6) r(i), clock
    WHERE timestamp - timestamp % 600000 - i * 600000 + 3600000 <= {_CLOSED} GROUP BY ALL""", "clock"))
def stream_sliding_counts(spark, sf_dir):
    windows = jobs.sliding_counts(_event_stream(spark, sf_dir), "1 hour", "10 minutes")
    return _run(spark, windows, "stream-sliding")


@query("stream_session_windows", check_sql(f"""
    , s AS (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w >= 1800000 THEN 1 ELSE 0 END AS cut FROM canon
            WINDOW w AS (PARTITION BY tenant_id, user_id ORDER BY timestamp)),
    g AS (SELECT *, sum(cut) OVER (PARTITION BY tenant_id, user_id ORDER BY timestamp) AS grp FROM s),
    r AS (SELECT tenant_id, user_id, min(timestamp) AS session_start, max(timestamp) + 1800000 AS session_end,
                 count(*) AS count FROM g GROUP BY tenant_id, user_id, grp)
    SELECT r.* FROM r, clock WHERE session_end <= {_CLOSED}""", "clock"))
def stream_session_windows(spark, sf_dir):
    return _run(spark, jobs.session_windows(_event_stream(spark, sf_dir)), "stream-sessions")


def _accepted_in_batches(spark, sf_dir, batches=4):
    """Rows that exact deduplication accepts when the events come in parts by time, each a micro-batch of a run of its own."""
    out = shared_dir(spark, "stream-batches")
    events = load_events(spark, sf_dir).withColumn("key", F.concat_ws(":", "user_id", "event_type"))
    lo, hi = events.select(F.min("timestamp"), F.max("timestamp") + 1).first()
    cuts = [lo + (hi - lo) * i // batches for i in range(batches + 1)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        part = events.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
        part.write.mode("append").parquet(f"{out}/source")
        stream = read_files(spark, f"{out}/source", events.schema)  # all files that are new
        jobs.run_available(jobs.start_exact_dedup(stream, ["key"], out, f"{out}/checkpoint", buckets=stateful.BUCKETS))
    return spark.read.parquet(f"{out}/accepted")


@query("stream_dedup", ORACLES["dedup_24h"])
def stream_dedup(spark, sf_dir):
    """Accepted arrivals per user and type under the 24-hour rule, over four micro-batches."""
    return _accepted_in_batches(spark, sf_dir).select("key", "timestamp", "seq")


@query("stream_dedup_windows", check_sql(f"""
    SELECT tenant_id, event_type, c.timestamp - c.timestamp % 3600000 AS window_start, count(*) AS count
    FROM canon c JOIN ({ORACLES["dedup_24h"]}) a ON a.seq = c.seq GROUP BY ALL"""))
def stream_dedup_windows(spark, sf_dir):
    """Hourly counts over the table that the deduplication job writes: copies are stored nowhere and counted nowhere."""
    return window_counts(_accepted_in_batches(spark, sf_dir), HOUR)


@query("stream_dedup_exact", ORACLES["dedup_24h"])
def stream_dedup_exact(spark, sf_dir):
    out = shared_dir(spark, "stream-accepted")
    keyed = _event_stream(spark, sf_dir).select(
        F.concat_ws(":", "user_id", "event_type").alias("key"), "timestamp", "seq"
    )
    jobs.run_available(jobs.start_exact_dedup(keyed, ["key"], out, f"{out}/checkpoint", buckets=stateful.BUCKETS))
    return spark.read.parquet(f"{out}/accepted").select("key", "timestamp", "seq")


@query("stream_raw_sink", check_sql("""
    SELECT CASE WHEN error = '' THEN 'stored' ELSE 'dlq' END AS target, error,
           error = '' AND seq % 50 <> 4 AND (seq % 20) * 60000 > 300000 AS is_late, count(*) AS rows FROM checked GROUP BY ALL""", "checked"))
def stream_raw_sink(spark, sf_dir):
    """Stored and dead-letter rows of the ingest sink, late ones labelled; missing times become arrival times."""
    out = shared_dir(spark, "stream-raw")
    received = F.col("real_ts") + F.pmod("seq", F.lit(20)) * 60000
    stream = dirty(_event_stream(spark, sf_dir).withColumn("real_ts", F.col("timestamp")))
    stream = stream.withColumn("received_at", received)
    jobs.run_available(jobs.start_raw_sink(stream, f"{out}/raw", f"{out}/dlq", f"{out}/checkpoint"))
    stored = spark.read.parquet(f"{out}/raw/events").select(
        F.lit("stored").alias("target"),
        F.lit("").alias("error"),
        F.coalesce(F.try_element_at("labels", F.lit("late_arrival")) == "true", F.lit(False)).alias("is_late"),
    )
    dlq = spark.read.parquet(f"{out}/dlq").select(F.lit("dlq").alias("target"), "error", F.lit(False).alias("is_late"))
    return stored.unionByName(dlq).groupBy("target", "error", "is_late").agg(F.count("*").alias("rows"))


@query("stream_minute_view", check_sql("""
    SELECT tenant_id, event_type, timestamp - timestamp % 60000 AS window_start, count(*) AS count,
           CAST(count(*) AS DOUBLE) AS sum, count(DISTINCT user_id) AS unique_users FROM canon GROUP BY ALL"""))
def stream_minute_view(spark, sf_dir):
    minutes, _ = _views(spark, sf_dir)
    return merge_minute_partials(minutes)


@query("stream_revenue_view", check_sql("""
    SELECT tenant_id, timestamp - timestamp % 3600000 AS hour, round(sum(amount), 4) AS revenue
    FROM canon GROUP BY ALL"""))
def stream_revenue_view(spark, sf_dir):
    _, revenue = _views(spark, sf_dir)
    return merge_revenue(revenue).withColumn("revenue", F.round("revenue", 4))


def _views(spark, sf_dir):
    out = shared_dir(spark, "stream-views")
    writer = jobs.start_views(_event_stream(spark, sf_dir), f"{out}/minutes", f"{out}/revenue", f"{out}/checkpoint")
    jobs.run_available(writer)
    return spark.read.parquet(f"{out}/minutes"), spark.read.parquet(f"{out}/revenue")


@query("stream_zscore", check_sql(f"""
    , closed AS (SELECT hourly.* FROM hourly, clock WHERE window_start + 3600000 <= {_CLOSED}),
    s AS (SELECT *, count(*) OVER w AS n, sum(count) OVER w AS s, sum(count * count) OVER w AS q FROM closed
          WINDOW w AS (PARTITION BY tenant_id, event_type ORDER BY window_start ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, CASE WHEN n >= 10 AND n * q - s * s > 0
           THEN CAST(abs(n * count - s) AS DOUBLE) / sqrt(CAST(n * q - s * s AS DOUBLE)) ELSE 0.0 END AS z FROM s)
    SELECT tenant_id, event_type, window_start, count, round(z, 6) AS z_score, z > 3.0 AS is_anomaly FROM z
    """, "hourly", "clock"))
def stream_zscore(spark, sf_dir):
    """Hourly windows of one stream scored by a second, stateful one reading their table."""
    out = shared_dir(spark, "stream-windows")
    hour = {"tumbling_1h": HOUR}
    jobs.use_rocksdb(spark)
    jobs.run_available(
        jobs.start_window_metrics(_event_stream(spark, sf_dir), f"{out}/data", f"{out}/checkpoint", hour)
    )
    stored = spark.read.parquet(f"{out}/data").schema
    scored = stateful.score_windows(read_files(spark, f"{out}/data", stored))
    return _run(spark, scored, "stream-scores").withColumn("z_score", F.round("z_score", 6))


@query("stream_cooldown", check_sql("SELECT rule_id, tenant_id, fired_at FROM fired", "fired"))
def stream_cooldown(spark, sf_dir):
    """Rule candidates, written as a table, pass the stateful cooldown."""
    path = shared_dir(spark, "candidates")
    rows = candidates(spark, sf_dir).select("rule_id", "tenant_id", "fired_at")
    rows.write.parquet(path)
    fired = stateful.apply_cooldown(read_files(spark, path, spark.read.parquet(path).schema))
    return _run(spark, fired, "stream-fired")


@query("stream_hot_windows", check_sql(f"""
    , closed AS (SELECT metrics.* FROM metrics, clock WHERE window_end <= {_CLOSED})
    SELECT * FROM closed WHERE window_end >= (SELECT max(window_end) FROM closed) - 7200000""", "metrics", "clock"))
def stream_hot_windows(spark, sf_dir):
    return jobs.hot_windows(stream_window_metrics(spark, sf_dir))


@query("stream_ingest_chain", check_sql(f"""
    , v AS (SELECT seq, CASE WHEN seq % 50 = 4 THEN timestamp + (seq % 20) * 60000 ELSE timestamp END AS ts,
                   seq % 50 = 4 OR (seq % 20) * 60000 <= 300000 AS on_time FROM canon WHERE seq % 50 > 2),
    w AS (SELECT ts - ts % 3600000 + 3600000 AS window_end, count(*) AS n FROM v WHERE on_time GROUP BY ALL)
    SELECT 'events' AS target, '' AS error, count(*) AS rows FROM v
    UNION ALL SELECT 'dlq', ['tenant_id is required', 'invalid event', 'invalid JSON'][seq % 50 + 1], count(*)
              FROM canon WHERE seq % 50 < 3 GROUP BY ALL
    UNION ALL SELECT 'windows', '', sum(n)::BIGINT FROM w WHERE window_end <= (SELECT max(ts) FROM v WHERE on_time) - 300000"""))
def stream_ingest_chain(spark, sf_dir):
    """Messages in five parts, some sent twice, through the chained streams: rows stored, refused and counted in closed hours."""
    use_utc(spark)
    out = shared_dir(spark, "stream-chain")
    write_messages(load_events(spark, sf_dir), f"{out}/messages")
    messages = spark.read.parquet(f"{out}/messages")
    chain = read_chain(spark, f"{out}/messages", messages.schema, out, max_files=max(1, len(messages.inputFiles()) // 5))
    chain.run_available({"tumbling_1h": HOUR})
    tables = {
        "events": chain.read("events").select(F.lit("").alias("error"), F.lit(1).alias("n")),
        "dlq": chain.read("dlq").select("error", F.lit(1).alias("n")),
        "windows": chain.read("windows").select(F.lit("").alias("error"), F.col("count").alias("n")),
    }
    parts = [df.groupBy("error").agg(F.sum("n").alias("rows")).select(F.lit(name).alias("target"), "error", "rows") for name, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def write_messages(events, path, parts=5):
    """The events as JSON messages with their arrival, every tenth sent again half an hour later, in parts by arrival, each of as many files as it takes."""
    received = F.col("timestamp") + F.pmod("seq", F.lit(20)) * 60000
    rows = dirty(events.withColumn("received_at", received))
    text = F.to_json(F.struct("id", "tenant_id", "user_id", "event_type", "source", "timestamp"))
    payload = F.when(F.pmod("seq", F.lit(50)) == 2, F.lit("[1]")).otherwise(F.coalesce("payload", F.lit("null")))
    message = F.concat(F.expr("substring(_t, 1, length(_t) - 1)"), F.lit(',"payload":'), payload, F.lit("}"))
    sent = rows.withColumn("_t", text).select("seq", "received_at", message.alias("value"))
    again = sent.where("pmod(seq, 10) = 5").withColumn("received_at", F.col("received_at") + 1_800_000)
    sent = sent.unionByName(again).select("received_at", "value")
    lo, hi = sent.select(F.min("received_at"), F.max("received_at") + 1).first()
    cuts = [lo + (hi - lo) * i // parts for i in range(parts + 1)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        sent.where((F.col("received_at") >= start) & (F.col("received_at") < end)).write.mode("append").parquet(path)
