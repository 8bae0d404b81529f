"""Quotas, service levels, lag and load forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timing import HOUR, MINUTE, floor_ms
from ..operators import slo
from ..operators.windows import window_counts
from ..sources.canonical import latest_ms, load_events
from ..sources.tables import to_dead_letters
from .fixtures import checked, counter_samples, offsets
from .registry import check_sql, query

BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0]


@query("rate_limited", check_sql("""
    SELECT id, recent AS recent_count, recent > 2 AS is_limited,
           CAST(CASE WHEN recent > 2 THEN 429 ELSE 202 END AS INTEGER) AS http_status
    FROM (SELECT id, count(*) OVER (PARTITION BY tenant_id ORDER BY timestamp
                 RANGE BETWEEN 599999 PRECEDING AND CURRENT ROW) AS recent FROM canon)"""))
def rate_limited(spark, sf_dir):
    """The default quota never binds on this data: 2 per 10 minutes instead."""
    flagged = slo.rate_limited(load_events(spark, sf_dir), limit=2, span_ms=10 * MINUTE)
    return flagged.select("id", "recent_count", "is_limited", "http_status")


_HOURS = """
    , f AS (SELECT tenant_id, unnest(range(min(timestamp // 3600000), (SELECT max(timestamp // 3600000) FROM canon) + 1)) AS h FROM canon GROUP BY tenant_id),
    c AS (SELECT tenant_id, timestamp // 3600000 AS h, count(*) AS n FROM canon GROUP BY ALL),
    s AS (SELECT f.tenant_id, f.h * 3600000 AS window_start, coalesce(n, 0) AS count FROM f LEFT JOIN c USING (tenant_id, h))
    """


@query("throughput_drop", check_sql(_HOURS + """
    SELECT tenant_id, window_start, count, count * (1000 / 3600000.0) AS rate, count * (1000 / 3600000.0) < 0.001 AS breach
    FROM s"""))
def throughput_drop(spark, sf_dir):
    return slo.throughput(load_events(spark, sf_dir), HOUR, ["tenant_id"], 0.001, below=True)


@query("error_burst", check_sql("""
    , e AS (SELECT * FROM canon WHERE event_type = 'error'),
    f AS (SELECT tenant_id, unnest(range(min(timestamp // 3600000), (SELECT max(timestamp // 3600000) FROM e) + 1)) AS h FROM e GROUP BY tenant_id),
    c AS (SELECT tenant_id, timestamp // 3600000 AS h, count(*) AS n FROM e GROUP BY ALL)
    SELECT f.tenant_id, f.h * 3600000 AS window_start, coalesce(n, 0) AS count,
           coalesce(n, 0) * (3600000 / 3600000.0) AS rate, coalesce(n, 0) * 1.0 > 3.0 AS breach
    FROM f LEFT JOIN c USING (tenant_id, h)"""))
def error_burst(spark, sf_dir):
    errors = load_events(spark, sf_dir).where(F.col("event_type") == "error")
    return slo.throughput(errors, HOUR, ["tenant_id"], 3.0, below=False, per_ms=HOUR)


@query("sustained_breach", check_sql(_HOURS + """
    , b AS (SELECT *, window_start - row_number() OVER (PARTITION BY tenant_id ORDER BY window_start) * 3600000 AS island
            FROM s WHERE count * (1000 / 3600000.0) < 0.001)
    SELECT tenant_id, min(window_start) AS breach_start, max(window_start) + 3600000 AS breach_end, count(*) AS steps
    FROM b GROUP BY tenant_id, island HAVING max(window_start) + 3600000 - min(window_start) >= 10800000"""))
def sustained_breach(spark, sf_dir):
    steps = slo.throughput(load_events(spark, sf_dir), HOUR, ["tenant_id"], 0.001, below=True)
    return slo.sustained_breaches(steps, ["tenant_id"], HOUR, 3 * HOUR)


@query("dlq_growing", check_sql("""
    SELECT count(*) AS rows, count(*) > 1000 AS breach FROM checked WHERE error <> ''""", "checked"))
def dlq_growing(spark, sf_dir):
    dlq = to_dead_letters(checked(spark, sf_dir), "error", latest_ms(load_events(spark, sf_dir)))
    return slo.over_limit(dlq, 1000)


@query("counter_rate", check_sql("""
    , h AS (SELECT tenant_id, timestamp - timestamp % 3600000 AS ts, count(*) AS n FROM canon GROUP BY ALL),
    c AS (SELECT tenant_id, ts, CAST(sum(n) OVER (PARTITION BY tenant_id, ts // 604800000 ORDER BY ts) AS DOUBLE) AS value FROM h),
    i AS (SELECT *, lag(value) OVER (PARTITION BY tenant_id ORDER BY ts) AS p FROM c),
    j AS (SELECT tenant_id, ts, value, CASE WHEN p IS NULL THEN 0.0 WHEN value >= p THEN value - p ELSE value END AS increase FROM i)
    SELECT *, sum(increase) OVER (PARTITION BY tenant_id ORDER BY ts RANGE BETWEEN 21599999 PRECEDING AND CURRENT ROW)
              / 21600.0 AS rate FROM j"""))
def counter_rate(spark, sf_dir):
    return slo.counter_rate(counter_samples(load_events(spark, sf_dir)), ["tenant_id"], 6 * HOUR)


_LE = ", ".join(f"({b})" for b in BOUNDS)


@query("histogram_quantile", check_sql(f"""
    , b AS (SELECT event_type, le, count(*) FILTER (value <= le) AS cum
            FROM canon, (VALUES {_LE}, (CAST('inf' AS DOUBLE))) t(le) GROUP BY ALL),
    w AS (SELECT *, coalesce(lag(le) OVER o, 0.0) AS lo, coalesce(lag(cum) OVER o, 0) AS under,
                 0.99 * max(cum) OVER (PARTITION BY event_type) AS target
          FROM b WINDOW o AS (PARTITION BY event_type ORDER BY le))
    SELECT event_type, round(CAST(CASE WHEN isinf(le) THEN lo ELSE lo + (le - lo) * (target - under) / (cum - under) END
                                  AS DOUBLE), 6) AS quantile
    FROM w WHERE cum >= target AND under < target"""))
def histogram_quantile(spark, sf_dir):
    buckets = slo.histogram_buckets(load_events(spark, sf_dir), ["event_type"], "value", BOUNDS)
    return slo.histogram_quantile(buckets, ["event_type"], 0.99).withColumn("quantile", F.round("quantile", 6))


@query("histogram_quantile_rates", check_sql(f"""
    , p AS (SELECT tenant_id, timestamp - timestamp % 3600000 - i * 3600000 AS window_start, value FROM canon, range(6) r(i)),
    b AS (SELECT tenant_id, window_start, le, count(*) FILTER (value <= le) AS cum
          FROM p, (VALUES {_LE}, (CAST('inf' AS DOUBLE))) t(le) GROUP BY ALL),
    w AS (SELECT *, coalesce(lag(le) OVER o, 0.0) AS lo, coalesce(lag(cum) OVER o, 0) AS under,
                 0.99 * max(cum) OVER (PARTITION BY tenant_id, window_start) AS target
          FROM b WINDOW o AS (PARTITION BY tenant_id, window_start ORDER BY le))
    SELECT tenant_id, window_start, round(CAST(CASE WHEN isinf(le) THEN lo ELSE lo + (le - lo) * (target - under) / (cum - under) END
                                               AS DOUBLE), 6) AS quantile
    FROM w WHERE cum >= target AND under < target"""))
def histogram_quantile_rates(spark, sf_dir):
    """The quantile over the buckets of every trailing six hours, moved on by the hour."""
    spans = load_events(spark, sf_dir).select("tenant_id", "value", F.explode(F.sequence(
        floor_ms("timestamp", HOUR) - F.lit(5 * HOUR), floor_ms("timestamp", HOUR), F.lit(HOUR).cast("bigint"))).alias("window_start"))
    keys = ["tenant_id", "window_start"]
    quantiles = slo.histogram_quantile(slo.histogram_buckets(spans, keys, "value", BOUNDS), keys, 0.99)
    return quantiles.withColumn("quantile", F.round("quantile", 6))


@query("slo_ratio", check_sql("""
    , w AS (SELECT tenant_id, timestamp - timestamp % 3600000 - i * 3600000 AS window_start, count(*) AS count,
                   count(*) FILTER (event_type = 'error') AS errors
            FROM canon, range(6) r(i) GROUP BY ALL)
    SELECT tenant_id, window_start, window_start + 21600000 AS window_end, count, errors,
           errors / count AS error_ratio, 1.0 - errors / count AS availability, errors / count > 0.001 AS breach,
           1.0 - errors / count >= 0.999 AS meets_target FROM w"""))
def slo_ratio(spark, sf_dir):
    return slo.error_ratio(
        load_events(spark, sf_dir), F.col("event_type") == "error", ["tenant_id"], 6 * HOUR, HOUR
    )


@query("consumer_lag", check_sql("""
    , h AS (SELECT timestamp - timestamp % 3600000 AS ts, CAST(('0x' || substr(md5(user_id), 1, 8)) AS BIGINT) % 8 AS p,
                   count(*) AS n FROM canon GROUP BY ALL),
    o AS (SELECT ts, p, CAST(sum(n) OVER (PARTITION BY p ORDER BY ts) AS BIGINT) AS log_end,
                 CAST(coalesce(sum(n) OVER (PARTITION BY p ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cur
          FROM h),
    t AS (SELECT ts, CAST(sum(log_end - cur) AS BIGINT) AS lag, max(log_end - cur) AS max_partition_lag FROM o GROUP BY ts),
    l AS (SELECT *, lag(lag) OVER (ORDER BY ts) AS p FROM t)
    SELECT 'events' AS topic, ts, lag, max_partition_lag,
           CASE WHEN p IS NULL THEN 'unknown' WHEN lag > p THEN 'growing' ELSE 'stable' END AS trend,
           CASE WHEN lag > 10 THEN 'critical' WHEN lag > 5 THEN 'warning' ELSE 'ok' END AS severity,
           lag / 40000.0 AS eta_seconds_best, lag / 20000.0 AS eta_seconds_worst FROM l"""))
def consumer_lag(spark, sf_dir):
    """Thresholds scaled down to the traffic of the test data."""
    return slo.consumer_lag(offsets(load_events(spark, sf_dir)), drainers=4, warn=5, critical=10)


@query("forecast_scaling", check_sql("""
    , w AS (SELECT tenant_id, timestamp - timestamp % 300000 AS s, count(*) AS n FROM canon GROUP BY ALL),
    k AS (SELECT tenant_id, min(s) AS since FROM w GROUP BY tenant_id),
    g AS (SELECT tenant_id, now, now - now % 300000 - i * 300000 AS s FROM k, clock, range(1, 13) r(i)
          WHERE now - now % 300000 - i * 300000 >= since),
    y AS (SELECT g.tenant_id, (g.s - now) / 60000.0 AS x, coalesce(n, 0) / 300.0 AS y FROM g LEFT JOIN w USING (tenant_id, s)),
    f AS (SELECT tenant_id, CASE WHEN count(*) > 1 THEN regr_slope(y, x) ELSE 0.0 END AS slope,
                 CASE WHEN count(*) > 1 THEN regr_intercept(y, x) ELSE avg(y) END AS at_now FROM y GROUP BY tenant_id)
    SELECT tenant_id, round(slope, 9) AS slope_per_minute, round(at_now, 6) AS rate_now,
           round(greatest(at_now + slope * 15, 0.0), 6) AS forecast_rate,
           CAST(least(greatest(ceil(greatest(at_now + slope * 15, 0.0) / 5000.0), 3), 20) AS BIGINT) AS replicas
    FROM f""", "clock"))
def forecast_scaling(spark, sf_dir):
    events = load_events(spark, sf_dir)
    counts = window_counts(events, 5 * MINUTE, ["tenant_id"])
    return slo.forecast_replicas(counts, ["tenant_id"], 5 * MINUTE, latest_ms(events)).select(
        "tenant_id",
        F.round("slope_per_minute", 9).alias("slope_per_minute"),
        F.round("rate_now", 6).alias("rate_now"),
        F.round("forecast_rate", 6).alias("forecast_rate"),
        "replicas",
    )
