"""Pre-aggregated views: partial rows that are appended per increment and merged on read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timing import HOUR, MINUTE, floor_ms, to_ts
from ..sources.files import Folder

VIEW_KEYS = ["tenant_id", "event_type", "window_start"]


def _month(ms: str):
    return F.date_format(to_ts(ms), "yyyyMM")


def events_per_minute(events: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """Count, sum of ones and exact distinct users per tenant, type and minute.

    Spark first removes repeated (key, user) pairs, shuffled by the pair, so a hot key is spread
    over its users before its count is taken.
    """
    return events.groupBy("tenant_id", "event_type", floor_ms("timestamp", step_ms).alias("window_start")).agg(
        F.count("*").alias("count"),
        F.sum(F.lit(1.0)).alias("sum"),
        F.countDistinct("user_id").alias("unique_users"),
    )


def minute_partials(events: DataFrame, step_ms: int = MINUTE) -> DataFrame:
    """Mergeable state of the view above: two sums and an HLL sketch of the users."""
    return events.groupBy("tenant_id", "event_type", floor_ms("timestamp", step_ms).alias("window_start")).agg(
        F.count("*").alias("count_state"),
        F.sum(F.lit(1.0)).alias("sum_state"),
        F.hll_sketch_agg("user_id").alias("users_state"),
    )


def compact_minute_partials(partials: DataFrame) -> DataFrame:
    """Fewer partial rows with the same meaning."""
    return partials.groupBy(*VIEW_KEYS).agg(
        F.sum("count_state").alias("count_state"),
        F.sum("sum_state").alias("sum_state"),
        F.hll_union_agg("users_state").alias("users_state"),
    )


def merge_minute_partials(partials: DataFrame) -> DataFrame:
    """The view as its readers see it."""
    return compact_minute_partials(partials).select(
        *VIEW_KEYS,
        F.col("count_state").alias("count"),
        F.col("sum_state").alias("sum"),
        F.hll_sketch_estimate("users_state").alias("unique_users"),
    )


def revenue_per_hour(events: DataFrame) -> DataFrame:
    """Purchase amounts per tenant and hour; hours with events but no purchase show 0."""
    revenue = F.when(F.col("event_type") == "purchase", F.col("amount")).otherwise(F.lit(0.0))
    return events.groupBy("tenant_id", floor_ms("timestamp", HOUR).alias("hour")).agg(
        F.sum(revenue).alias("revenue")
    )


def merge_revenue(rows: DataFrame) -> DataFrame:
    """Rows of the same key collapse by addition."""
    return rows.groupBy("tenant_id", "hour").agg(F.sum("revenue").alias("revenue"))


def append_partials(partials: DataFrame, path: str, time_column: str = "window_start") -> None:
    """Add an increment to a view table, partitioned by month."""
    partials.withColumn("month", _month(time_column)).write.mode("append").partitionBy("month").parquet(path)


def compact_months(spark: SparkSession, source: str, target: str, merge, months: list[str] | None = None) -> None:
    """Rewrite months of a view table into `target`, replacing just those partitions there.

    Source and target differ because a job must not overwrite files it is still reading. The tables of streams, which
    are partitioned by batch, can be a source too; their months come from the rows.
    """
    rows = spark.read.parquet(source).drop("batch_id")
    time_column = "window_start" if "window_start" in rows.columns else "hour"
    if "month" not in rows.columns:
        rows = rows.withColumn("month", _month(time_column))
    if months:
        rows = rows.where(F.col("month").isin(months))
    (
        merge(rows.drop("month"))
        .withColumn("month", _month(time_column))
        .repartitionByRange("month", "tenant_id", time_column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(target)
    )


def _compacted(spark: SparkSession, target: str) -> tuple[int | None, str | None]:
    """The last batch in the compacted part, and the folder that holds it: the newest version that was written to its end."""
    table = Folder(spark, target)
    done = [v for v in table.folders() if v.startswith("upto=") and table.has(f"{v}/_SUCCESS")]
    newest = max(done, key=lambda v: int(v.removeprefix("upto=")), default=None)
    return (int(newest.removeprefix("upto=")), f"{target}/{newest}") if newest else (None, None)


def _batches(spark: SparkSession, source: str) -> list[int]:
    return sorted(int(b.removeprefix("batch_id=")) for b in Folder(spark, source).folders() if b.startswith("batch_id="))


def _rows(spark: SparkSession, source: str, target: str, newest: int | None = None) -> DataFrame:
    upto, folder = _compacted(spark, target)
    if upto is not None and all(b <= upto for b in _batches(spark, source)):
        return spark.read.parquet(folder)
    raw = spark.read.parquet(source)
    if newest is not None:
        raw = raw.where(F.col("batch_id") <= newest)
    if upto is None:
        return raw.drop("batch_id")
    return spark.read.parquet(folder).unionByName(raw.where(F.col("batch_id") > upto).drop("batch_id"))


def read_view(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Partial rows of a view that a stream writes: the compacted part up to its last batch, and the raw batches beyond."""
    return _rows(spark, source, target)


def compact_batches(spark: SparkSession, source: str, target: str, merge) -> int | None:
    """Merges the compacted part and all raw batches beyond it into a new version; returns the last batch in it.

    `merge` collapses partial rows and keeps their columns. A version is named by its last batch and counts once Spark
    has marked it complete, so a run that fails before that changes nothing for readers, and running it again mends
    it. Its mark is the newest batch that another one follows: a stream begins a batch only when the one before is
    committed, so the batch that may still be written again, and all that arrive meanwhile, stay raw.
    """
    upto, _ = _compacted(spark, target)
    newest = max(_batches(spark, source)[:-1], default=None)
    if newest is None or upto is not None and newest <= upto:
        return upto
    merge(_rows(spark, source, target, newest)).write.mode("overwrite").parquet(f"{target}/upto={newest}")
    return newest


def drop_compacted(spark: SparkSession, source: str, target: str) -> list[str]:
    """Removes raw batches and older versions that the newest version holds; returns their names. Readers must have moved on."""
    upto, folder = _compacted(spark, target)
    if upto is None:
        return []
    raw, versions = Folder(spark, source), Folder(spark, target)
    old = [b for b in raw.folders() if b.startswith("batch_id=") and int(b.removeprefix("batch_id=")) <= upto]
    older = [v for v in versions.folders() if v.startswith("upto=") and f"{target}/{v}" != folder]
    for b in old:
        raw.remove(b)
    for v in older:
        versions.remove(v)
    return old + older
