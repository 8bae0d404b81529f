"""Hot tenants: share of traffic, sub-keys, shard load and two-phase aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timing import col, floor_ms

HOT_SHARE = 0.10
MIN_HOT_SHARE = 0.001
SHARDS = 8


def shard_of(key: str | Column, shards: int = SHARDS) -> Column:
    """Stable shard from the leading 32 bits of the md5 of the key."""
    head = F.conv(F.substring(F.md5(col(key)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(shards).cast("bigint"))


def tenant_share(events: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """Events, share of all events and hot flag per tenant.

    The total is a scalar subquery over the per-tenant counts, so no task sees all tenants.
    """
    counts = events.groupBy("tenant_id").agg(F.count("*").alias("events"))
    total = counts.select(F.sum("events")).scalar()
    return counts.withColumn("share", F.col("events") / total).withColumn(
        "is_hot", F.col("share") > hot_share
    )


def hot_tenants(events: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """Tenants over the share: fewer than 1/hot_share rows, by arithmetic."""
    if hot_share < MIN_HOT_SHARE:
        raise ValueError(f"hot_share must be at least {MIN_HOT_SHARE}, to bound the number of hot tenants")
    return tenant_share(events, hot_share).where("is_hot").select("tenant_id", "is_hot")


def with_route(
    events: DataFrame, hot: DataFrame, shards: int = SHARDS, by_user: bool = False
) -> DataFrame:
    """Routing key: `tenant` for quiet tenants, `tenant:shard` (or `tenant:user`) for hot ones.

    `hot` comes from hot_tenants, which bounds it to fewer than 1,000 rows, hence the broadcast.
    """
    sub = F.col("user_id") if by_user else shard_of("user_id", shards).cast("string")
    joined = events.join(F.broadcast(hot.select("tenant_id", "is_hot")), "tenant_id", "left")
    return joined.withColumn(
        "route_key",
        F.when(F.col("is_hot"), F.concat_ws(":", "tenant_id", sub)).otherwise(F.col("tenant_id")),
    ).drop("is_hot")


def partition_load(df: DataFrame, key: str, partitions: int = SHARDS) -> DataFrame:
    """Events and share per partition when partitioned by `key`, idle partitions included."""
    load = df.groupBy(shard_of(key, partitions).alias("partition")).agg(F.count("*").alias("events"))
    every = df.sparkSession.range(partitions).select(F.col("id").alias("partition"))
    full = every.join(load, "partition", "left").withColumn(
        "events", F.coalesce("events", F.lit(0).cast("bigint"))
    )
    total = load.select(F.sum("events")).scalar()
    return full.withColumn("share", F.col("events") / total).withColumn("is_idle", F.col("events") == 0)


def salted_window_aggregate(
    events: DataFrame, duration_ms: int, shards: int = SHARDS, sketches: bool = False
) -> DataFrame:
    """Count, sum, lowest and highest value (and sketches) per window in two phases.

    First per (window, shard of the user), then per window: state that cannot be combined on
    the map side, such as sketches of a hot window, is built by `shards` tasks instead of one.
    """
    keys = ["tenant_id", "event_type", "window_start"]
    first = [
        F.count("*").alias("count"), F.sum("value").alias("sum"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    ]
    second = [
        F.sum("count").alias("count"), F.sum("sum").alias("sum"),
        F.min("min").alias("min"), F.max("max").alias("max"),
    ]
    if sketches:
        first += [F.hll_sketch_agg("user_id").alias("users"), F.kll_sketch_agg_double("value").alias("values")]
        second += [F.hll_union_agg("users").alias("users"), F.kll_merge_agg_double("values").alias("values")]
    salted = (
        events.withColumn("window_start", floor_ms("timestamp", duration_ms))
        .groupBy(*keys, shard_of("user_id", shards).alias("_shard"))
        .agg(*first)
    )
    return salted.groupBy(*keys).agg(*second)
