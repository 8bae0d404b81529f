"""Streaming jobs: windows, duplicates, raw storage, views.

One query has one watermark. Duplicates need a day of it and windows five minutes, so they are
separate queries with a table in between; late events are dropped by the windows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.timing import HOUR, TUMBLING, to_ms, to_ts, with_calendar
from ..operators.dedup import DEDUP_TTL
from ..operators.ingest import apply_defaults, flag_late, validate
from ..operators.views import minute_partials, revenue_per_hour
from ..operators.windows import KEYS, window_metrics
from ..sources.tables import to_dead_letters
from . import stateful
from .sources import FLUSH_INTERVAL

LATENESS = "5 minutes"
DEDUP_HORIZON = "24 hours"
HOT_SPAN = 2 * HOUR
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State on local disk with changes saved to the checkpoint, not on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def with_event_time(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return events.withColumn("event_ts", to_ts("timestamp")).withWatermark("event_ts", lateness)


def _seconds(ms: int) -> str:
    return f"{ms // 1000} seconds"


def value_counts(events: DataFrame, durations: dict[str, int] = TUMBLING, lateness: str = LATENESS) -> DataFrame:
    """Closed windows as (key, window, value) -> number of events, in append mode.

    Keeping the value in the key makes state small rows spread over all partitions, also for a
    hot window, where a percentile aggregate would hold all values of a window in one row.
    """
    timed = with_event_time(events, lateness)
    parts = []
    for name, ms in durations.items():
        counted = timed.groupBy(*KEYS, F.window("event_ts", _seconds(ms)).alias("w"), "value").agg(
            F.count("*").alias("n")
        )
        parts.append(
            counted.select(
                *KEYS, F.lit(name).alias("window_type"), to_ms(F.col("w.start")).alias("window_start"), "value", "n"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def finish_metrics(counts: DataFrame, durations: dict[str, int] = TUMBLING) -> DataFrame:
    """Metrics of closed windows from their value counts, with the batch operator."""
    length = F.create_map(*[F.lit(x) for pair in durations.items() for x in pair])
    rows = counts.select(
        *KEYS, F.col("window_type").alias("kind"), F.col("window_start").alias("timestamp"), "value", "n"
    )
    done = window_metrics(rows, {"closed": min(durations.values())}, [*KEYS, "kind"], weight="n")
    return done.select(
        *KEYS,
        F.col("kind").alias("window_type"),
        "window_start",
        (F.col("window_start") + F.element_at(length, F.col("kind"))).alias("window_end"),
        "count",
        "sum",
        "avg",
        "p99",
    )


def staged(batch: DataFrame, path: str) -> DataFrame:
    """A micro-batch written out and read back, for work that needs it more than once."""
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def per_batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None, **options: str):
    """foreachBatch function that can be repeated: a batch owns its `batch_id` partition.

    A batch that ran before a failure writes the same partition again, so retries after
    at-least-once delivery leave no copies.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        (
            out.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**options)
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def start_window_metrics(
    events: DataFrame, path: str, checkpoint: str, durations: dict[str, int] = TUMBLING, lateness: str = LATENESS
) -> DataStreamWriter:
    """Continuous 1m/5m/1h metrics: closed windows are finished and stored per micro-batch.

    The value counts of a micro-batch are written before they are used: each further use of the
    batch itself would run its stateful aggregation again.
    """
    finish = per_batch_writer(path, lambda counts: finish_metrics(counts, durations))

    def write(batch: DataFrame, batch_id: int) -> None:
        finish(staged(batch, f"{path}/_staged/batch={batch_id}"), batch_id)

    return (
        value_counts(events, durations, lateness)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def sliding_counts(events: DataFrame, size: str = "5 minutes", slide: str = "30 seconds", lateness: str = LATENESS) -> DataFrame:
    """Closed sliding windows of a stream."""
    return (
        with_event_time(events, lateness)
        .groupBy(*KEYS, F.window("event_ts", size, slide).alias("w"))
        .agg(F.count("*").alias("count"))
        .select(*KEYS, to_ms(F.col("w.start")).alias("window_start"), to_ms(F.col("w.end")).alias("window_end"), "count")
    )


def session_windows(events: DataFrame, gap: str = "30 minutes", lateness: str = LATENESS) -> DataFrame:
    """Closed sessions per tenant and user of a stream."""
    return (
        with_event_time(events, lateness)
        .groupBy("tenant_id", "user_id", F.session_window("event_ts", gap).alias("w"))
        .agg(F.count("*").alias("count"))
        .select(
            "tenant_id",
            "user_id",
            to_ms(F.col("w.start")).alias("session_start"),
            to_ms(F.col("w.end")).alias("session_end"),
            "count",
        )
    )


def drop_duplicates(events: DataFrame, keys: list[str], horizon: str = DEDUP_HORIZON) -> DataFrame:
    """First arrival of a key within the horizon; copies do not extend it."""
    return with_event_time(events, horizon).dropDuplicatesWithinWatermark(keys)


def start_exact_dedup(
    events: DataFrame, keys: list[str], path: str, checkpoint: str, seq: str = "seq", ttl_ms: int = DEDUP_TTL, lateness: str = stateful.LATENESS,
    buckets: int | None = None,
) -> DataStreamWriter:
    """Accepted events under the exact rule: a key is free again `ttl_ms` after its last acceptance.

    State per key takes the place of the accepted table, which the job only writes. (drop_duplicates keeps less state
    but frees a key only once the watermark has passed, up to another horizon later.) With many keys, `buckets` of them
    share a state row: see `stateful.drop_duplicates_exact`.
    """
    use_rocksdb(events.sparkSession)  # the state store that keyed state and timers need
    accepted = stateful.drop_duplicates_exact(events, keys, seq=seq, ttl_ms=ttl_ms, lateness=lateness, buckets=buckets)
    return (
        accepted.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(per_batch_writer(f"{path}/accepted"))
    )


def start_raw_sink(
    events: DataFrame, events_path: str, dlq_path: str, checkpoint: str, received_at: str = "received_at"
) -> DataStreamWriter:
    """Complete, validate and store every event, late ones too, with their label; the rest to the DLQ.

    A missing time is the arrival time.

    The batch is parsed once: it is written with its error column, then read back to be split.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        checked = flag_late(validate(apply_defaults(batch, F.col(received_at))), received_at)
        rows = staged(checked, f"{events_path}/_staged/batch={batch_id}")
        good = with_calendar(rows.where("error IS NULL").drop("error", "is_late"))
        (
            good.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .repartitionByRange("tenant_id", "event_date", "event_type", "timestamp")
            .sortWithinPartitions("tenant_id", "event_date", "event_type", "timestamp")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", "tenant_id", "event_date")
            .parquet(f"{events_path}/events")
        )
        per_batch_writer(dlq_path)(to_dead_letters(rows, "error", received_at), batch_id)

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(route)


def start_views(events: DataFrame, minutes_path: str, revenue_path: str, checkpoint: str) -> DataStreamWriter:
    """Incremental views: each micro-batch adds its partial rows, merged by readers."""

    def write(batch: DataFrame, batch_id: int) -> None:
        per_batch_writer(minutes_path)(minute_partials(batch), batch_id)
        per_batch_writer(revenue_path)(revenue_per_hour(batch), batch_id)

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def hot_windows(metrics: DataFrame, now_ms: int | None = None, span_ms: int = HOT_SPAN) -> DataFrame:
    """Windows the hot table still serves: those that ended within the span before now.

    Without `now_ms` the newest window end stands for now.
    """
    now = F.lit(now_ms).cast("bigint") if now_ms is not None else metrics.select(F.max("window_end")).scalar()
    return metrics.where(F.col("window_end") >= now - F.lit(span_ms))


def route_by_tenant(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Group a micro-batch by its routing key before writing, as the topic does."""
    key = "route_key" if "route_key" in events.columns else "tenant_id"
    return events.repartition(partitions, key) if partitions else events.repartition(key)


def micro_batches(writer: DataStreamWriter, interval: str = FLUSH_INTERVAL) -> DataStreamWriter:
    """Flush by time; the size bound is the source's `max_files` or `max_offsets`."""
    return writer.trigger(processingTime=interval)


def run_available(writer: DataStreamWriter) -> None:
    """Process what the source holds now, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()

