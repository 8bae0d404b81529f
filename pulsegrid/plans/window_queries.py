"""Window metrics, views and dashboard reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timing import DAY, HOUR, MINUTE, SECOND, TUMBLING
from ..operators import analytics, routing, views
from ..operators.ingest import flag_late, for_windows
from ..operators.sessions import session_windows
from ..operators.windows import approx_metrics, explode_windows, finish_approx, sliding_counts, window_counts, window_metrics
from ..sources.canonical import latest_ms, load_events
from .fixtures import fired, metrics, tidy
from .registry import check_sql, query

ACME = "tenant-acme"


@query("window_metrics_1m_5m_1h", check_sql("SELECT * FROM metrics", "metrics"))
def window_metrics_1m_5m_1h(spark, sf_dir):
    return tidy(metrics(spark, sf_dir))


@query("window_metrics_missing_values", check_sql("""
    SELECT tenant_id, event_type, window_type, timestamp - timestamp % ms AS window_start,
           timestamp - timestamp % ms + ms AS window_end, count(*) AS count, round(sum(v), 4) AS sum,
           round(sum(v), 4) / count(*) AS avg, quantile_disc(v, 0.99) AS p99
    FROM (SELECT *, CASE WHEN seq % 5 IN (0, 1) THEN 1.0 ELSE value END AS v FROM canon), lengths GROUP BY ALL""", "canon", "lengths"))
def window_metrics_missing_values(spark, sf_dir):
    """An event without a value, or with one that is no finite number, counts as 1.0 like any other."""
    value = F.when(F.col("seq") % 5 == 0, F.lit(None)).when(F.col("seq") % 5 == 1, F.lit(float("nan"))).otherwise(F.col("value"))
    return tidy(window_metrics(load_events(spark, sf_dir).withColumn("value", value)))


@query("window_metrics_on_time", check_sql("""
    SELECT tenant_id, event_type, window_type, timestamp - timestamp % ms AS window_start,
           timestamp - timestamp % ms + ms AS window_end, count(*) AS count, round(sum(value), 4) AS sum,
           round(sum(value), 4) / count(*) AS avg, quantile_disc(value, 0.99) AS p99
    FROM canon, lengths WHERE (seq % 20) * 60000 <= 300000 GROUP BY ALL""", "canon", "lengths"))
def window_metrics_on_time(spark, sf_dir):
    """Windows without events that arrived more than five minutes late."""
    received = load_events(spark, sf_dir).withColumn(
        "received_at", F.col("timestamp") + F.pmod("seq", F.lit(20)) * 60000
    )
    return tidy(window_metrics(for_windows(flag_late(received), "exclude")))


@query("window_metrics_large", check_sql("""
    SELECT tenant_id, event_type, w AS window_type, timestamp - timestamp % ms AS window_start,
           timestamp - timestamp % ms + ms AS window_end, count(*) AS count, round(sum(value), 4) AS sum,
           round(sum(value), 4) / count(*) AS avg, quantile_disc(value, 0.99) AS p99
    FROM canon, (VALUES ('day', 86400000), ('ten_days', 864000000)) t(w, ms) GROUP BY ALL"""))
def window_metrics_large(spark, sf_dir):
    """Windows of hundreds of events and more, where the percentile lies inside a band."""
    return tidy(window_metrics(load_events(spark, sf_dir), {"day": DAY, "ten_days": 10 * DAY}))


def _rank_ok(approx, events, durations, error=0.02):
    """`p99_ok`: the share of a window's values up to the approximate percentile is 0.99, but for the sketch's error."""
    keys = ["tenant_id", "event_type", "window_type", "window_start"]
    values = explode_windows(events.select("tenant_id", "event_type", "timestamp", "value"), durations, "timestamp")
    p, v = F.col("p99"), F.col("value")
    shares = values.join(approx.select(*keys, "p99"), keys).groupBy(*keys).agg(
        (F.sum((v <= p).cast("int")) / F.count("*")).alias("upto"), (F.sum((v < p).cast("int")) / F.count("*")).alias("below")
    )
    ok = (F.col("upto") >= 0.99 - error) & (F.col("below") <= 0.99 + error)
    return approx.join(shares, keys).withColumn("p99_ok", ok).select(*keys, "count", "p99_ok")


def _users_ok(estimate, exact):
    """Whether an HLL estimate is within 6 % (four deviations) or two of the exact number."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(2.0), 0.06 * exact)


@query("window_metrics_approx", check_sql("""
    SELECT tenant_id, event_type, window_type, window_start, count, true AS p99_ok FROM metrics""", "metrics"))
def window_metrics_approx(spark, sf_dir):
    """Counts and approximate percentiles, these held against the exact ranks."""
    events = load_events(spark, sf_dir)
    return _rank_ok(finish_approx(approx_metrics(events)), events, TUMBLING)


@query("window_metrics_lookup", check_sql("""
    SELECT * FROM metrics WHERE tenant_id = 'tenant-acme' AND event_type = 'purchase' AND window_type = 'tumbling_1h'
    """, "metrics"))
def window_metrics_lookup(spark, sf_dir):
    return analytics.metrics_lookup(tidy(metrics(spark, sf_dir)), ACME, "purchase", "tumbling_1h")


@query("sliding_counts", check_sql("""
    SELECT tenant_id, event_type, timestamp - timestamp % 30000 - i * 30000 AS window_start,
           timestamp - timestamp % 30000 - i * 30000 + 300000 AS window_end, count(*) AS count
    FROM canon, range(10) r(i) GROUP BY ALL"""))
def sliding_counts_query(spark, sf_dir):
    return sliding_counts(load_events(spark, sf_dir), 5 * MINUTE, 30 * SECOND)


@query("session_windows", check_sql("""
    , s AS (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w >= 1800000 THEN 1 ELSE 0 END AS cut FROM canon
            WINDOW w AS (PARTITION BY tenant_id, user_id ORDER BY timestamp)),
    g AS (SELECT *, sum(cut) OVER (PARTITION BY tenant_id, user_id ORDER BY timestamp) AS grp FROM s)
    SELECT tenant_id, user_id, min(timestamp) AS session_start, max(timestamp) + 1800000 AS session_end,
           count(*) AS count FROM g GROUP BY tenant_id, user_id, grp"""))
def session_windows_query(spark, sf_dir):
    return session_windows(load_events(spark, sf_dir))


@query("events_per_minute", check_sql("""
    SELECT tenant_id, event_type, timestamp - timestamp % 60000 AS window_start, count(*) AS count,
           CAST(count(*) AS DOUBLE) AS sum, count(DISTINCT user_id) AS unique_users FROM canon GROUP BY ALL"""))
def events_per_minute(spark, sf_dir):
    return views.events_per_minute(load_events(spark, sf_dir))


@query("events_per_minute_merged", check_sql("""
    SELECT tenant_id, event_type, timestamp - timestamp % 60000 AS window_start, count(*) AS count,
           CAST(count(*) AS DOUBLE) AS sum, count(DISTINCT user_id) AS unique_users FROM canon GROUP BY ALL"""))
def events_per_minute_merged(spark, sf_dir):
    """Four increments of partial rows, merged on read."""
    events = load_events(spark, sf_dir)
    increments = [views.minute_partials(events.where(F.pmod("seq", F.lit(4)) == i)) for i in range(4)]
    table = increments[0]
    for more in increments[1:]:
        table = table.unionByName(more)
    return views.merge_minute_partials(table)


@query("daily_users_sketch", check_sql("""
    SELECT tenant_id, event_type, timestamp - timestamp % 86400000 AS window_start, count(*) AS count, true AS users_ok
    FROM canon GROUP BY ALL"""))
def daily_users_sketch(spark, sf_dir):
    """Per-minute partials rolled up to days: distinct users from sketches, held against the exact number."""
    daily = views.minute_partials(load_events(spark, sf_dir)).withColumn(
        "window_start", F.col("window_start") - F.pmod("window_start", F.lit(DAY))
    )
    keys = ["tenant_id", "event_type", "window_start"]
    exact = views.events_per_minute(load_events(spark, sf_dir), DAY).select(*keys, F.col("unique_users").alias("exact"))
    merged = views.merge_minute_partials(daily).join(exact, keys)
    return merged.select(*keys, "count", _users_ok(F.col("unique_users"), F.col("exact")).alias("users_ok"))


@query("revenue_per_hour", check_sql("""
    SELECT tenant_id, timestamp - timestamp % 3600000 AS hour, round(sum(amount), 4) AS revenue
    FROM canon GROUP BY ALL"""))
def revenue_per_hour(spark, sf_dir):
    return views.revenue_per_hour(load_events(spark, sf_dir)).withColumn("revenue", F.round("revenue", 4))


@query("revenue_per_hour_merged", check_sql("""
    SELECT tenant_id, timestamp - timestamp % 3600000 AS hour, round(sum(amount), 4) AS revenue
    FROM canon GROUP BY ALL"""))
def revenue_per_hour_merged(spark, sf_dir):
    events = load_events(spark, sf_dir)
    parts = [views.revenue_per_hour(events.where(F.pmod("seq", F.lit(2)) == i)) for i in range(2)]
    return views.merge_revenue(parts[0].unionByName(parts[1])).withColumn("revenue", F.round("revenue", 4))


@query("event_count_rate", check_sql("""
    SELECT tenant_id, CAST('' AS VARCHAR) AS event_type, count(*) AS count, count(*) / 86400.0 AS rate_per_second,
           any_value(now) - 86400000 AS "from", any_value(now) AS "to"
    FROM canon, clock WHERE tenant_id = 'tenant-acme' AND timestamp BETWEEN now - 86400000 AND now GROUP BY tenant_id
    UNION ALL
    SELECT tenant_id, 'purchase', count(*), count(*) / 86400.0, any_value(now) - 86400000, any_value(now)
    FROM canon, clock WHERE tenant_id = 'tenant-globex' AND event_type = 'purchase'
         AND timestamp BETWEEN now - 86400000 AND now GROUP BY tenant_id
    UNION ALL
    SELECT 'tenant-acme', 'click', count(*), 0.0, (SELECT now FROM clock), (SELECT now FROM clock)
    FROM canon WHERE tenant_id = 'tenant-acme' AND event_type = 'click' AND timestamp = (SELECT now FROM clock)
    """, "clock"))
def event_count_rate(spark, sf_dir):
    events = load_events(spark, sf_dir)
    now = latest_ms(events)
    start = now - F.lit(DAY)
    return (
        analytics.event_count(events, ACME, "", start, now)
        .unionByName(analytics.event_count(events, "tenant-globex", "purchase", start, now))
        .unionByName(analytics.event_count(events, ACME, "click", now, now))
    )


@query("revenue_last_n", check_sql("""
    SELECT 'tenant-acme' AS tenant_id, CAST(1439 AS BIGINT) AS window_minutes, coalesce(round(sum(amount), 4), 0.0) AS revenue
    FROM canon, clock WHERE tenant_id = 'tenant-acme' AND timestamp > now - 1439 * 60000
    UNION ALL
    SELECT 'tenant-globex', CAST(5 AS BIGINT), coalesce(round(sum(amount), 4), 0.0)
    FROM canon, clock WHERE tenant_id = 'tenant-globex' AND timestamp > now - 5 * 60000""", "clock"))
def revenue_last_n(spark, sf_dir):
    events = load_events(spark, sf_dir)
    now = latest_ms(events)
    day = analytics.revenue_last(events, ACME, 1439, now)
    clamped = analytics.revenue_last(events, "tenant-globex", 1440, now)
    return day.unionByName(clamped).withColumn("revenue", F.round("revenue", 4))


@query("daily_counts", check_sql("""
    SELECT strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS day, count(*) AS count
    FROM canon WHERE tenant_id = 'tenant-acme' GROUP BY 1 ORDER BY 1 DESC LIMIT 14"""))
def daily_counts(spark, sf_dir):
    return analytics.daily_counts(load_events(spark, sf_dir), ACME).withColumn("day", F.col("day").cast("string"))


@query("dashboard", check_sql("""
    , facts AS (
      SELECT tenant_id, count(*) FILTER (timestamp >= now - 86400000) AS count,
             count(*) FILTER (timestamp >= now - 86400000) / 86400.0 AS rate_per_second,
             round(coalesce(sum(amount) FILTER (timestamp > now - 1439 * 60000), 0.0), 4) AS revenue,
             count(DISTINCT user_id) FILTER (timestamp >= now - 86400000) AS unique_users
      FROM canon, clock GROUP BY tenant_id),
    latest AS (SELECT tenant_id, max(window_start) AS s FROM metrics WHERE window_type = 'tumbling_5m' GROUP BY 1)
    SELECT f.*, l.s AS latest_window_start,
           (SELECT CAST(sum(m.count) AS BIGINT) FROM metrics m WHERE m.tenant_id = f.tenant_id AND m.window_start = l.s
            AND m.window_type = 'tumbling_5m') AS latest_window_count,
           (SELECT count(*) FROM fired x WHERE x.tenant_id = f.tenant_id) AS alert_count
    FROM facts f JOIN latest l ON l.tenant_id = f.tenant_id""", "clock", "metrics", "fired"))
def dashboard(spark, sf_dir):
    events = load_events(spark, sf_dir)
    now = latest_ms(events)
    windows = window_counts(events, 5 * MINUTE).withColumn("window_type", F.lit("tumbling_5m"))
    board = analytics.dashboard(events, windows, fired(spark, sf_dir), now - F.lit(DAY), now, 1439)
    return board.withColumn("revenue", F.round("revenue", 4))


@query("incident_impact", check_sql("""
    SELECT count(*) AS events, count(DISTINCT event_type) AS event_types, count(DISTINCT tenant_id) AS tenants,
           count(*) FILTER (event_type = 'purchase') AS revenue_events
    FROM canon, clock WHERE timestamp BETWEEN now - 259200000 AND now - 86400000""", "clock"))
def incident_impact(spark, sf_dir):
    events = load_events(spark, sf_dir)
    now = latest_ms(events)
    return analytics.incident_impact(events, now - F.lit(3 * DAY), now - F.lit(DAY))


@query("top_users", check_sql("""
    SELECT user_id, count(*) AS cnt FROM canon, clock
    WHERE tenant_id = 'tenant-acme' AND timestamp > now - 3600000 GROUP BY user_id
    ORDER BY cnt DESC, user_id LIMIT 10""", "clock"))
def top_users(spark, sf_dir):
    events = load_events(spark, sf_dir)
    return analytics.top_users(events, ACME, latest_ms(events))


@query("top_users_month", check_sql("""
    SELECT user_id, count(*) AS cnt FROM canon WHERE tenant_id = 'tenant-globex' GROUP BY user_id
    ORDER BY cnt DESC, user_id LIMIT 10"""))
def top_users_month(spark, sf_dir):
    events = load_events(spark, sf_dir)
    return analytics.top_users(events, "tenant-globex", latest_ms(events), 31 * DAY)


@query("recent_minutes", check_sql("""
    SELECT timestamp - timestamp % 60000 AS window_start, count(*) AS count, count(DISTINCT user_id) AS unique_users
    FROM canon WHERE tenant_id = 'tenant-acme' AND event_type = 'purchase' GROUP BY 1 ORDER BY 1 DESC LIMIT 60"""))
def recent_minutes(spark, sf_dir):
    return analytics.recent_rates(views.events_per_minute(load_events(spark, sf_dir)), ACME, "purchase")


@query("recent_events", check_sql("""
    SELECT id, user_id, timestamp, value FROM canon WHERE tenant_id = 'tenant-initech' AND event_type = 'error'
    ORDER BY timestamp DESC, id LIMIT 100"""))
def recent_events(spark, sf_dir):
    rows = analytics.recent_events(load_events(spark, sf_dir), "tenant-initech", "error", 100)
    return rows.select("id", "user_id", "timestamp", "value")


@query("gap_days", check_sql("""
    , kept AS (SELECT tenant_id, timestamp // 86400000 AS d FROM canon
               WHERE NOT (tenant_id = 'tenant-acme' AND (timestamp // 86400000) % 7 = 3
                          OR tenant_id = 'tenant-globex' AND (timestamp // 86400000) % 11 = 5)),
    span AS (SELECT min(d) AS a, max(d) AS b FROM kept)
    SELECT tenant_id, d * 86400000 AS day_ms FROM
      (SELECT t.tenant_id, unnest(range(a, b + 1)) AS d FROM (SELECT DISTINCT tenant_id FROM kept) t, span)
    EXCEPT SELECT tenant_id, d * 86400000 FROM kept"""))
def gap_days(spark, sf_dir):
    day = F.expr("timestamp div 86400000L")
    lost = ((F.col("tenant_id") == ACME) & (day % 7 == 3)) | ((F.col("tenant_id") == "tenant-globex") & (day % 11 == 5))
    return analytics.missing_days(load_events(spark, sf_dir).where(~lost))


@query("hot_cold_serving", check_sql("""
    SELECT * EXCLUDE (now), window_start >= now - 7200000 AS is_hot FROM metrics, clock""", "metrics", "clock"))
def hot_cold_serving(spark, sf_dir):
    events = load_events(spark, sf_dir)
    now = latest_ms(events)
    recent = events.where(F.col("timestamp") >= now - F.lit(4 * HOUR))
    hot = window_metrics(recent).withColumn("is_hot", F.lit(True))
    cold = window_metrics(events).withColumn("is_hot", F.lit(False))
    return tidy(analytics.hot_and_cold(hot, cold, now))


@query("tenant_share", check_sql("""
    SELECT tenant_id, count(*) AS events, count(*) / (SELECT count(*) FROM canon) AS share,
           count(*) / (SELECT count(*) FROM canon) > 0.10 AS is_hot FROM canon GROUP BY tenant_id"""))
def tenant_share(spark, sf_dir):
    return routing.tenant_share(load_events(spark, sf_dir))


_SHARD = "CAST(('0x' || substr(md5({0}), 1, 8)) AS BIGINT) % 8"


@query("subkey_partitions", check_sql(f"""
    , r AS (SELECT 'before' AS stage, {_SHARD.format('tenant_id')} AS "partition", count(*) AS n FROM canon GROUP BY ALL
            UNION ALL
            SELECT 'after', {_SHARD.format("tenant_id || ':' || CAST(" + _SHARD.format('user_id') + " AS VARCHAR)")}, count(*)
            FROM canon GROUP BY ALL),
    p AS (SELECT stage, i AS "partition" FROM range(8) t(i), (VALUES ('before'), ('after')) s(stage))
    SELECT p.stage, p."partition", coalesce(n, 0) AS events, coalesce(n, 0) / (SELECT count(*) FROM canon) AS share,
           coalesce(n, 0) = 0 AS is_idle
    FROM p LEFT JOIN r ON r.stage = p.stage AND r."partition" = p."partition" """))
def subkey_partitions(spark, sf_dir):
    """Load per partition keyed by tenant, and with hot tenants split by sub-key."""
    events = load_events(spark, sf_dir)
    routed = routing.with_route(events, routing.hot_tenants(events))
    before = routing.partition_load(events, "tenant_id").withColumn("stage", F.lit("before"))
    return before.unionByName(routing.partition_load(routed, "route_key").withColumn("stage", F.lit("after")))


@query("route_keys", check_sql(f"""
    SELECT id, tenant_id || ':' || CAST({_SHARD.format('user_id')} AS VARCHAR) AS route_key FROM canon
    WHERE tenant_id IN (SELECT tenant_id FROM canon GROUP BY 1 HAVING count(*) > 0.335 * (SELECT count(*) FROM canon))
    UNION ALL
    SELECT id, tenant_id FROM canon
    WHERE tenant_id NOT IN (SELECT tenant_id FROM canon GROUP BY 1 HAVING count(*) > 0.335 * (SELECT count(*) FROM canon))
    """))
def route_keys(spark, sf_dir):
    events = load_events(spark, sf_dir)
    return routing.with_route(events, routing.hot_tenants(events, 0.335)).select("id", "route_key")


@query("salted_window_counts", check_sql("""
    SELECT tenant_id, event_type, timestamp - timestamp % 3600000 AS window_start, count(*) AS count,
           round(sum(value), 4) AS sum, min(value) AS min, max(value) AS max FROM canon GROUP BY ALL"""))
def salted_window_counts(spark, sf_dir):
    return routing.salted_window_aggregate(load_events(spark, sf_dir), HOUR).withColumn("sum", F.round("sum", 4))


@query("salted_window_sketches", check_sql("""
    SELECT tenant_id, event_type, timestamp - timestamp % 86400000 AS window_start, count(*) AS count,
           true AS users_ok, true AS p99_ok FROM canon GROUP BY ALL"""))
def salted_window_sketches(spark, sf_dir):
    """Sketches built in two phases, held against exact users and ranks."""
    events, keys = load_events(spark, sf_dir), ["tenant_id", "event_type", "window_start"]
    salted = routing.salted_window_aggregate(load_events(spark, sf_dir), DAY, sketches=True)
    salted = salted.withColumn("users", F.hll_sketch_estimate("users")).withColumn(
        "p99", F.kll_sketch_get_quantile_double("values", F.lit(0.99))
    )
    ranks = _rank_ok(salted.withColumn("window_type", F.lit("day")), events, {"day": DAY}).select(*keys, "p99_ok")
    exact = views.events_per_minute(events, DAY).select(*keys, F.col("unique_users").alias("exact"))
    return salted.join(exact, keys).join(ranks, keys).select(
        *keys, "count", _users_ok(F.col("users"), F.col("exact")).alias("users_ok"), "p99_ok"
    )
