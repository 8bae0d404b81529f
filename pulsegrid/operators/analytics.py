"""Dashboard reads: counts, rates, revenue, top lists, gaps, hot and cold serving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.requests import clamp_minutes_value
from ..functions.timing import DAY, HOUR, MINUTE, between_ms, event_date, floor_ms
from .windows import window_metrics

HOT_SPAN = 2 * HOUR


def _ms(x: int | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("bigint")


def for_tenant(df: DataFrame, tenant: str) -> DataFrame:
    """Rows of one tenant; the tenant is required. Prunes partitions of a stored table."""
    if not tenant:
        raise ValueError("tenant_id is required")
    return df.where(F.col("tenant_id") == tenant)


def rate_per_second(count: Column, start: int | Column, end: int | Column) -> Column:
    seconds = (_ms(end) - _ms(start)) / F.lit(1000.0)
    return F.when(seconds > 0, count / seconds).otherwise(F.lit(0.0))


def event_count(
    events: DataFrame, tenant: str, event_type: str, start: int | Column, end: int | Column
) -> DataFrame:
    """Events of a tenant in [start, end] and their rate; an empty type means all types."""
    rows = between_ms(for_tenant(events, tenant), start, end)
    if event_type:
        rows = rows.where(F.col("event_type") == event_type)
    return rows.agg(F.count("*").alias("count")).select(
        F.lit(tenant).alias("tenant_id"),
        F.lit(event_type).alias("event_type"),
        "count",
        rate_per_second(F.col("count"), start, end).alias("rate_per_second"),
        _ms(start).alias("from"),
        _ms(end).alias("to"),
    )


def revenue_last(events: DataFrame, tenant: str, minutes: int, now: int | Column) -> DataFrame:
    """Purchase amounts after now - minutes (the bound itself is out)."""
    used = clamp_minutes_value(minutes)
    rows = for_tenant(events, tenant).where(
        (F.col("event_type") == "purchase") & (F.col("timestamp") > _ms(now) - F.lit(used * MINUTE))
    )
    return rows.agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias("revenue")).select(
        F.lit(tenant).alias("tenant_id"), "revenue", F.lit(used).cast("bigint").alias("window_minutes")
    )


def metrics_lookup(metrics: DataFrame, tenant: str, event_type: str, window: str = "") -> DataFrame:
    """Stored window metrics of a tenant and type, in time order."""
    return (
        for_tenant(metrics, tenant)
        .where((F.col("event_type") == event_type) & (F.col("window_type") == (window or "tumbling_1m")))
        .orderBy("window_start")
    )


def daily_counts(events: DataFrame, tenant: str, days: int = 14) -> DataFrame:
    """Events per day of a tenant, newest days first."""
    return (
        for_tenant(events, tenant)
        .groupBy(event_date("timestamp").alias("day"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("day").desc())
        .limit(days)
    )


def missing_days(events: DataFrame, keys: list[str] = ["tenant_id"]) -> DataFrame:
    """Days without any event between the first and last day seen over all keys."""
    per_day = events.groupBy(*keys, floor_ms("timestamp", DAY).alias("day_ms")).agg(F.count("*").alias("n"))
    span = per_day.agg(F.min("day_ms").alias("a"), F.max("day_ms").alias("b"))
    a, b = span.select("a").scalar(), span.select("b").scalar()
    expected = (
        per_day.select(*keys)
        .distinct()
        .withColumn("day_ms", F.explode(F.sequence(a, b, F.lit(DAY).cast("bigint"))))
    )
    return expected.join(per_day, [*keys, "day_ms"], "left_anti")


def top_users(events: DataFrame, tenant: str, now: int | Column, span_ms: int = HOUR, n: int = 10) -> DataFrame:
    """Most active users after now - span; ties go to the smaller user id."""
    return (
        for_tenant(events, tenant)
        .where(F.col("timestamp") > _ms(now) - F.lit(span_ms))
        .groupBy("user_id")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.col("cnt").desc(), "user_id")
        .limit(n)
    )


def recent_rates(minute_view: DataFrame, tenant: str, event_type: str, n: int = 60) -> DataFrame:
    """Newest rows of the per-minute view."""
    return (
        for_tenant(minute_view, tenant)
        .where(F.col("event_type") == event_type)
        .select("window_start", "count", "unique_users")
        .orderBy(F.col("window_start").desc())
        .limit(n)
    )


def recent_events(events: DataFrame, tenant: str, event_type: str = "", n: int = 100) -> DataFrame:
    rows = for_tenant(events, tenant)
    if event_type:
        rows = rows.where(F.col("event_type") == event_type)
    return rows.orderBy(F.col("timestamp").desc(), "id").limit(n)


def dashboard(
    events: DataFrame, metrics: DataFrame, alerts: DataFrame, start: int | Column, end: int | Column,
    revenue_minutes: int = 5, window: str = "tumbling_5m",
) -> DataFrame:
    """One row per tenant: counts, rate, revenue, users, latest window, alerts.

    `metrics` needs tenant, window type, window start and count: the stored window metrics, or counts.
    The event table is read once: every event figure is a conditional aggregate of one pass.
    """
    used = clamp_minutes_value(revenue_minutes)
    in_range = F.col("timestamp").between(_ms(start), _ms(end))
    earning = (F.col("event_type") == "purchase") & (F.col("timestamp") > _ms(end) - F.lit(used * MINUTE))
    facts = events.groupBy("tenant_id").agg(
        F.count_if(in_range).alias("count"),
        F.sum(F.when(earning, F.col("amount")).otherwise(F.lit(0.0))).alias("revenue"),
        F.countDistinct(F.when(in_range, F.col("user_id"))).alias("unique_users"),
    )
    per_window = (
        metrics.where(F.col("window_type") == window)
        .groupBy("tenant_id", "window_start")
        .agg(F.sum("count").alias("n"))
    )
    latest = per_window.groupBy("tenant_id").agg(
        F.max("window_start").alias("latest_window_start"),
        F.max_by("n", "window_start").alias("latest_window_count"),
    )
    fired = alerts.groupBy("tenant_id").agg(F.count("*").alias("n"))
    return (
        facts.join(latest, "tenant_id", "left")
        .join(fired.withColumnRenamed("n", "alert_count"), "tenant_id", "left")
        .select(
            "tenant_id",
            "count",
            rate_per_second(F.col("count"), start, end).alias("rate_per_second"),
            "revenue",
            "unique_users",
            "latest_window_start",
            "latest_window_count",
            F.coalesce("alert_count", F.lit(0).cast("bigint")).alias("alert_count"),
        )
    )


def incident_impact(events: DataFrame, start: int | Column, end: int | Column) -> DataFrame:
    """Extent of an incident: events, types, tenants and purchases in a time range."""
    return between_ms(events, start, end).agg(
        F.count("*").alias("events"),
        F.countDistinct("event_type").alias("event_types"),
        F.countDistinct("tenant_id").alias("tenants"),
        F.count_if(F.col("event_type") == "purchase").alias("revenue_events"),
    )


def hot_and_cold(
    hot: DataFrame, cold: DataFrame, now: int | Column, span_ms: int = HOT_SPAN, hot_available: bool = True
) -> DataFrame:
    """Windows from `now - span` on from the hot table, older ones from history, none twice.

    Without the hot table all comes from history.
    """
    if not hot_available:
        return cold
    cut = _ms(now) - F.lit(span_ms)
    return hot.where(F.col("window_start") >= cut).unionByName(cold.where(F.col("window_start") < cut))


def merge_replayed(stored: DataFrame, replayed: DataFrame, key: str = "id") -> DataFrame:
    """Stored events plus those of a replay that are not stored yet.

    The replay's own copies are reduced to one first, on the map side, so that a key repeated
    many times does not travel as many rows.
    """
    columns = [c for c in replayed.columns if c != key]
    once = replayed.groupBy(key).agg(F.min_by(F.struct(*columns), "timestamp").alias("_r"))
    fresh = once.join(stored.select(key), key, "left_anti").select(key, "_r.*")
    return stored.unionByName(fresh.select(stored.columns))


def metrics_for(events: DataFrame, tenant: str) -> DataFrame:
    return window_metrics(for_tenant(events, tenant))
