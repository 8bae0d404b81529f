"""Adapter from the plain `events` table to the event record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timing import to_ms
from ..session import use_utc

# Tenant names, chosen by user_id modulo their number.
TENANTS = ["tenant-acme", "tenant-globex", "tenant-initech"]


def _tenant(user_id: Column) -> Column:
    names = F.array(*[F.lit(t) for t in TENANTS])
    return F.element_at(names, F.pmod(user_id, F.lit(len(TENANTS))).cast("int") + 1)


def as_events(raw: DataFrame) -> DataFrame:
    """Event record plus the two measures kept as columns; unused ones are pruned by Catalyst."""
    purchase = F.col("event_type") == "purchase"
    return raw.select(
        F.col("event_id").cast("string").alias("id"),
        _tenant(F.col("user_id")).alias("tenant_id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("event_type"),
        F.lit("web").alias("source"),
        to_ms("ts").alias("timestamp"),
        F.lit(1).alias("version"),
        F.to_json(
            F.struct(F.col("value"), F.when(purchase, F.col("value")).alias("amount"))
        ).alias("payload"),
        F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("labels"),
        F.col("value"),
        F.when(purchase, F.col("value")).otherwise(F.lit(0.0)).alias("amount"),
        F.col("event_id").alias("seq"),
    )


def load_events(spark: SparkSession, sf_dir: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """Events with start_ms <= time <= end_ms; the bounds reach the file scan, as the time column does not after conversion."""
    use_utc(spark)
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = raw.schema["ts"].dataType.simpleString()
    if start_ms is not None:
        raw = raw.where(F.col("ts") >= F.timestamp_millis(F.lit(start_ms).cast("bigint")).cast(kind))
    if end_ms is not None:
        raw = raw.where(F.col("ts") < F.timestamp_millis(F.lit(end_ms + 1).cast("bigint")).cast(kind))
    return as_events(raw)


def latest_ms(events: DataFrame, ts: str = "timestamp") -> Column:
    """Newest event time as a scalar subquery: the clock of the checked queries."""
    return events.select(F.max(ts)).scalar()
