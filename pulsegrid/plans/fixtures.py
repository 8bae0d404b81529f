"""Inputs derived from the events table for queries that need faulty, batched or operational data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timing import HOUR, floor_ms
from ..operators.alerts import fire, rule_candidates, rules_frame
from ..operators.ingest import apply_defaults, ingest_status, resolve_tenant, validate
from ..operators.routing import shard_of
from ..operators.windows import window_metrics
from ..sources.canonical import latest_ms, load_events

# The rules of the checked queries; the first one is the built-in default.
RULES = [
    {},
    {"id": "rule-any-error", "name": "Any error", "operator": "gte", "threshold": 1.0, "severity": "warning"},
    {"id": "rule-acme-clicks", "tenant_id": "tenant-acme", "name": "Busy clicks", "event_type": "click",
     "metric": "rate", "threshold": 0.0005, "window": "1h", "severity": "info"},
    {"id": "rule-globex-p99", "tenant_id": "tenant-globex", "name": "Large purchase", "event_type": "purchase",
     "metric": "p99_latency", "threshold": 200.0, "window": "5m"},
    {"id": "rule-few-views", "name": "Few views", "event_type": "view", "operator": "lt", "threshold": 2.0,
     "window": "1h", "severity": "warning"},
    {"id": "rule-few-signups", "tenant_id": "tenant-initech", "name": "Few signups", "event_type": "signup",
     "operator": "lte", "threshold": 1.0, "window": "5m", "severity": "info"},
    {"id": "rule-off", "name": "Switched off", "event_type": "click", "operator": "gte", "threshold": 1.0,
     "enabled": False},
    {"id": "rule-odd", "name": "Unknown operator", "event_type": "click", "operator": "neq", "threshold": 1.0},
]


def text_of(c: str | Column, sep: str = "|") -> Column:
    return F.array_join(c, sep)


def tidy(metrics: DataFrame) -> DataFrame:
    """Sums of doubles depend on the order of addition in their last bits: round them away."""
    return metrics.withColumn("sum", F.round("sum", 4)).withColumn("avg", F.col("sum") / F.col("count"))


def dirty(events: DataFrame) -> DataFrame:
    """Events with blank tenants, types, ids, times, broken payloads and tenants from headers."""
    m = F.pmod("seq", F.lit(50))
    header = F.when(F.pmod("seq", F.lit(7)) == 0, F.lit("tenant-header")).otherwise(F.lit(""))
    return (
        events.withColumn("tenant_id", F.when(m == 0, F.lit("")).otherwise(resolve_tenant(header, "tenant_id")))
        .withColumn("event_type", F.when(m == 1, F.lit("")).otherwise(F.col("event_type")))
        .withColumn("payload", F.when(m == 2, F.lit("{broken")).otherwise(F.col("payload")))
        .withColumn("id", F.when(m == 3, F.lit("")).otherwise(F.col("id")))
        .withColumn("timestamp", F.when(m == 4, F.lit(0).cast("bigint")).otherwise(F.col("timestamp")))
        .withColumn("version", F.lit(0))
    )


def completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load_events(spark, sf_dir)
    new_id = F.sha2(F.concat_ws(":", "user_id", F.col("seq").cast("string")), 256)
    return apply_defaults(dirty(events), latest_ms(events), new_id)


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(completed(spark, sf_dir))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest outcome with the user and type as key, so that there are duplicates."""
    keyed = completed(spark, sf_dir).withColumn("dedup_key", F.concat_ws(":", "user_id", "event_type"))
    return ingest_status(keyed, key="dedup_key")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_metrics(load_events(spark, sf_dir))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_candidates(load_events(spark, sf_dir), rules_frame(spark, RULES))


def fired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fire(candidates(spark, sf_dir))


def counter_samples(events: DataFrame) -> DataFrame:
    """A counter per tenant, sampled hourly, that restarts every 7 days."""
    week = F.expr("(ts - pmod(ts, 604800000L)) div 604800000L")
    hourly = events.groupBy("tenant_id", floor_ms("timestamp", HOUR).alias("ts")).agg(F.count("*").alias("n"))
    upto = W.partitionBy("tenant_id", "week").orderBy("ts").rowsBetween(W.unboundedPreceding, W.currentRow)
    return hourly.withColumn("week", week).select(
        "tenant_id", "ts", F.sum("n").over(upto).cast("double").alias("value")
    )


def offsets(events: DataFrame, partitions: int = 8) -> DataFrame:
    """Hourly log-end and committed offsets per partition: each commit trails by one hour."""
    hourly = events.groupBy(
        floor_ms("timestamp", HOUR).alias("ts"), shard_of("user_id", partitions).alias("partition")
    ).agg(F.count("*").alias("n"))
    order = W.partitionBy("partition").orderBy("ts")
    end = F.sum("n").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    done = F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return hourly.select(F.lit("events").alias("topic"), "ts", "partition", end.alias("log_end"), done.alias("current"))
