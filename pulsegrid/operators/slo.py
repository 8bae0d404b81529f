"""Operational jobs: quotas, breaches, counter rates, quantiles, lag, load forecast.

Series handled here have one row per step (a scrape or a window), so a series is bounded by time;
raw events are reduced to such rows before any ordered work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timing import HOUR, MINUTE, SECOND, floor_ms
from .windows import fill_empty, sliding_counts, window_counts

QUOTA = 10_000
LAG_WARN, LAG_CRITICAL = 10_000, 50_000
DRAIN_LOW, DRAIN_HIGH = 5_000, 10_000
EVENTS_PER_REPLICA, MIN_REPLICAS, MAX_REPLICAS = 5_000, 3, 20


def rate_limited(
    events: DataFrame, limit: int = QUOTA, span_ms: int = SECOND, key: str = "tenant_id", ts: str = "timestamp"
) -> DataFrame:
    """Flag arrivals over the quota: more than `limit` of the key within the last `span_ms`.

    All arrivals count, admitted or not, and those of one millisecond together. Arrivals are
    counted per millisecond first; these counts are then summed per (key, span), each span also
    seeing the one before it, so a busy key is cut into spans of at most 2 x span_ms rows.
    """
    per_ms = events.groupBy(key, F.col(ts).alias("_t")).agg(F.count("*").alias("_n"))
    own = floor_ms("_t", span_ms)
    spread = per_ms.withColumn(
        "_s",
        F.explode(F.array(F.struct(own.alias("span"), F.lit(True).alias("own")),
                          F.struct((own + F.lit(span_ms)).alias("span"), F.lit(False).alias("own")))),
    ).select(key, "_t", "_n", "_s.span", "_s.own")
    recent = W.partitionBy(key, "span").orderBy("_t").rangeBetween(-(span_ms - 1), W.currentRow)
    counts = spread.withColumn("recent_count", F.sum("_n").over(recent)).where("own")
    counts = counts.select(F.col(key).alias("_key"), "_t", "recent_count")
    same = events[key].eqNullSafe(counts["_key"]) & events[ts].eqNullSafe(counts["_t"])
    return (
        events.join(counts, same, "left")
        .drop("_key", "_t")
        .withColumn("is_limited", F.coalesce(F.col("recent_count") > limit, F.lit(False)))
        .withColumn("http_status", F.when(F.col("is_limited"), F.lit(429)).otherwise(F.lit(202)))
    )


def sustained_breaches(
    series: DataFrame, keys: list[str], step_ms: int, for_ms: int, ts: str = "window_start",
    breach: str = "breach",
) -> DataFrame:
    """Runs of consecutive breaching steps lasting at least `for_ms`."""
    rows = series.where(F.col(breach))
    order = W.partitionBy(*keys).orderBy(ts)
    island = F.col(ts) - F.row_number().over(order).cast("bigint") * F.lit(step_ms)
    return (
        rows.withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(
            F.min(ts).alias("breach_start"),
            (F.max(ts) + F.lit(step_ms)).alias("breach_end"),
            F.count("*").alias("steps"),
        )
        .drop("_island")
        .where(F.col("breach_end") - F.col("breach_start") >= for_ms)
    )


def counter_rate(
    samples: DataFrame, keys: list[str], span_ms: int = 5 * MINUTE, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Increase per second of a counter over the trailing span.

    A value below the one before it is a restart from zero: all of it is increase. The plain
    definition, without extrapolation to the edges of the span.
    """
    order = W.partitionBy(*keys).orderBy(ts)
    before = F.lag(value).over(order)
    step = (
        F.when(before.isNull(), F.lit(0.0))
        .when(F.col(value) >= before, F.col(value) - before)
        .otherwise(F.col(value))
    )
    recent = order.rangeBetween(-(span_ms - 1), W.currentRow)
    return (
        samples.withColumn("increase", step.cast("double"))
        .withColumn("rate", F.sum("increase").over(recent) / F.lit(span_ms / 1000.0))
    )


def histogram_buckets(df: DataFrame, keys: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Cumulative bucket counts (`le`, `cum`) of a measure, the +Inf bucket last."""
    aggs = [F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(*keys).agg(*aggs, F.count("*").alias("b_inf"))
    entries = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("cum")) for i, b in enumerate(bounds)
    ]
    entries.append(F.struct(F.lit(float("inf")).alias("le"), F.col("b_inf").alias("cum")))
    return wide.select(*keys, F.inline(F.array(*entries)))


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket.

    The lowest bucket starts at zero; a quantile in the +Inf bucket is the highest finite bound. A series
    without samples has a null quantile; the quantile 0 is where the first bucket with samples starts. For a
    quantile of rates, give the buckets of a trailing span: a rate is their count over one length.
    """
    order = W.partitionBy(*keys).orderBy("le")
    rows = (
        buckets.withColumn("_target", F.lit(q) * F.max("cum").over(W.partitionBy(*keys)))
        .withColumn("_low", F.coalesce(F.lag("le").over(order), F.lit(0.0)))
        .withColumn("_under", F.coalesce(F.lag("cum").over(order), F.lit(0)))
    )
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * (F.col("_target") - F.col("_under")) / F.nullif(
        F.col("cum") - F.col("_under"), F.lit(0)
    )
    value = F.when(F.col("le") == float("inf"), F.col("_low")).otherwise(inside)
    holds = (F.col("cum") >= F.col("_target")) & (F.col("cum") > 0)
    return rows.groupBy(*keys).agg(F.min_by(value, F.when(holds, F.col("le"))).alias("quantile"))


def error_ratio(
    events: DataFrame, is_error: Column, keys: list[str], span_ms: int = 5 * MINUTE, slide_ms: int = MINUTE,
    limit: float = 0.001, target: float = 0.999,
) -> DataFrame:
    """Errors / all per sliding span, with the ratio breach and the availability objective."""
    marked = events.withColumn("_err", F.when(is_error, F.lit(1)).otherwise(F.lit(0)))
    return (
        sliding_counts(marked, span_ms, slide_ms, keys, value="_err")
        .withColumn("error_ratio", F.col("sum") / F.col("count"))
        .withColumn("availability", F.lit(1.0) - F.col("error_ratio"))
        .withColumn("breach", F.col("error_ratio") > limit)
        .withColumn("meets_target", F.col("availability") >= target)
        .withColumnRenamed("sum", "errors")
    )


def throughput(
    events: DataFrame, step_ms: int, keys: list[str], threshold: float, below: bool, per_ms: int = SECOND,
    ts: str = "timestamp",
) -> DataFrame:
    """Event rate per `per_ms` of every step, empty steps included, against a threshold.

    Steps run on to the newest step of any key, so a key that has fallen silent is seen as well.
    """
    rate = F.col("count") * F.lit(per_ms / step_ms)
    newest = events.select(F.max(floor_ms(ts, step_ms))).scalar()
    return fill_empty(window_counts(events, step_ms, keys, ts), step_ms, keys, newest).withColumn("rate", rate).withColumn(
        "breach", (rate < threshold) if below else (rate > threshold)
    )


def over_limit(table: DataFrame, limit: int, name: str = "rows") -> DataFrame:
    """One row saying whether a table (a dead-letter table, for one) holds more rows than allowed."""
    return table.agg(F.count("*").alias(name)).withColumn("breach", F.col(name) > limit)


def consumer_lag(
    offsets: DataFrame, drainers: int = 1, warn: int = LAG_WARN, critical: int = LAG_CRITICAL
) -> DataFrame:
    """Total lag per topic and time from `offsets(topic, ts, partition, current, log_end)`.

    The recovery time range assumes each processor drains 5,000 to 10,000 messages a second.
    """
    total = offsets.groupBy("topic", "ts").agg(
        F.sum(F.col("log_end") - F.col("current")).alias("lag"),
        F.max(F.col("log_end") - F.col("current")).alias("max_partition_lag"),
    )
    before = F.lag("lag").over(W.partitionBy("topic").orderBy("ts"))
    return (
        total.withColumn("_before", before)
        .withColumn(
            "trend",
            F.when(F.col("_before").isNull(), "unknown")
            .when(F.col("lag") > F.col("_before"), "growing")
            .otherwise("stable"),
        )
        .withColumn(
            "severity",
            F.when(F.col("lag") > critical, "critical").when(F.col("lag") > warn, "warning").otherwise("ok"),
        )
        .withColumn("eta_seconds_best", F.col("lag") / F.lit(float(DRAIN_HIGH * drainers)))
        .withColumn("eta_seconds_worst", F.col("lag") / F.lit(float(DRAIN_LOW * drainers)))
        .drop("_before")
    )


def forecast_replicas(
    counts: DataFrame, keys: list[str], step_ms: int, now: Column, ahead_ms: int = 15 * MINUTE, span_ms: int = HOUR
) -> DataFrame:
    """Linear traffic trend per key, its value `ahead_ms` after `now`, and the replicas it needs.

    The trend is that of the closed steps of the last `span_ms`. A step without events counts as zero from the key's
    first step on: what came before a tenant's first event is no traffic of it. With one closed step the trend is
    flat; a key whose first step is still open has no row.
    """
    last = now - F.pmod(now, F.lit(step_ms).cast("bigint"))
    step = F.lit(step_ms).cast("bigint")
    first = F.greatest(F.min("window_start"), last - F.lit(span_ms)).alias("_first")
    spans = counts.groupBy(*keys).agg(first).where(F.col("_first") < last)
    grid = spans.select(*keys, F.explode(F.sequence("_first", last - step, step)).alias("window_start"))
    recent = counts.where((F.col("window_start") >= last - F.lit(span_ms)) & (F.col("window_start") < last))
    counts = grid.join(recent, [*keys, "window_start"], "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))
    x = (F.col("window_start") - now) / F.lit(float(MINUTE))
    y = F.col("count") / F.lit(step_ms / 1000.0)
    fit = counts.select(*keys, x.alias("x"), y.alias("y")).groupBy(*keys).agg(
        F.coalesce(F.regr_slope("y", "x"), F.lit(0.0)).alias("slope_per_minute"),
        F.coalesce(F.regr_intercept("y", "x"), F.avg("y")).alias("rate_now"),
    )
    ahead = F.greatest(F.col("rate_now") + F.col("slope_per_minute") * F.lit(ahead_ms / MINUTE), F.lit(0.0))
    needed = F.ceil(F.col("forecast_rate") / F.lit(float(EVENTS_PER_REPLICA)))
    return fit.withColumn("forecast_rate", ahead).withColumn(
        "replicas", F.least(F.greatest(needed, F.lit(MIN_REPLICAS)), F.lit(MAX_REPLICAS)).cast("bigint")
    )
