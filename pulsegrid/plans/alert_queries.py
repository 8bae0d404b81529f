"""Anomaly detection, alert rules, alert history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.texts import NO_MODEL_TEXT, anomaly_prompt, fixed, ratio_summary, severity_color
from ..functions.timing import DAY, HOUR
from ..operators import alerts
from ..operators.anomaly import anomaly_burst, anomaly_signals, running_anomalies, running_counts, zscore_running, zscore_windows
from ..operators.explain import explain
from ..operators.windows import fill_empty, window_counts
from ..sources.canonical import latest_ms, load_events
from .fixtures import candidates, fired
from .registry import check_sql, query


def _hourly(spark, sf_dir):
    return window_counts(load_events(spark, sf_dir), HOUR)


def _scored(spark, sf_dir):
    return zscore_windows(_hourly(spark, sf_dir)).withColumn("window_end", F.col("window_start") + F.lit(HOUR))


def _signals(spark, sf_dir):
    return anomaly_signals(_scored(spark, sf_dir))


_RUNNING = check_sql("""
    , r AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, event_type, timestamp // 3600000
                                         ORDER BY timestamp, seq) AS running_count FROM canon),
    h AS (SELECT *, count(*) OVER w AS n, sum(running_count) OVER w AS s, sum(running_count * running_count) OVER w AS q
          FROM r WINDOW w AS (PARTITION BY tenant_id, event_type ORDER BY timestamp, seq
                              ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, CASE WHEN n >= 10 AND n * q - s * s > 0
           THEN CAST(abs(n * running_count - s) AS DOUBLE) / sqrt(CAST(n * q - s * s AS DOUBLE)) ELSE 0.0 END AS z FROM h)
    """)


@query("running_counts", check_sql("""
    SELECT id, timestamp - timestamp % 3600000 AS window_start,
           row_number() OVER (PARTITION BY tenant_id, event_type, timestamp // 3600000 ORDER BY timestamp, seq)
             AS running_count FROM canon"""))
def running_counts_query(spark, sf_dir):
    return running_counts(load_events(spark, sf_dir), HOUR).select("id", "window_start", "running_count")


@query("zscore_running", _RUNNING + """
    SELECT id, running_count, round(z, 6) AS z_score, z > 3.0 AS is_anomaly FROM z""")
def zscore_running_query(spark, sf_dir):
    return zscore_running(load_events(spark, sf_dir), HOUR).select(
        "id", "running_count", F.round("z_score", 6).alias("z_score"), "is_anomaly"
    )


@query("zscore_running_flags", _RUNNING + """
    SELECT tenant_id, event_type, timestamp - timestamp % 3600000 AS window_start, running_count,
           round(z, 6) AS z_score FROM z WHERE z > 3.0""")
def zscore_running_flags(spark, sf_dir):
    return running_anomalies(load_events(spark, sf_dir), HOUR).select(
        "tenant_id", "event_type", "window_start", "running_count", F.round("z_score", 6).alias("z_score")
    )


@query("zscore_windows", check_sql("""
    SELECT tenant_id, event_type, window_start, count, round(z, 6) AS z_score, z > 3.0 AS is_anomaly FROM scored
    """, "scored"))
def zscore_windows_query(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "tenant_id", "event_type", "window_start", "count", F.round("z_score", 6).alias("z_score"), "is_anomaly"
    )


@query("zscore_windows_zero_filled", check_sql("""
    , span AS (SELECT tenant_id, event_type, min(window_start) AS a, (SELECT max(window_start) FROM hourly) AS b
               FROM hourly GROUP BY ALL),
    grid AS (SELECT tenant_id, event_type, unnest(range(a, b + 1, 3600000)) AS window_start FROM span),
    filled AS (SELECT g.*, coalesce(h.count, 0) AS count FROM grid g LEFT JOIN hourly h USING (tenant_id, event_type, window_start)),
    s AS (SELECT *, count(*) OVER w AS n, sum(count) OVER w AS s, sum(count * count) OVER w AS q FROM filled
          WINDOW w AS (PARTITION BY tenant_id, event_type ORDER BY window_start ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, CASE WHEN n >= 10 AND n * q - s * s > 0
           THEN CAST(abs(n * count - s) AS DOUBLE) / sqrt(CAST(n * q - s * s AS DOUBLE)) ELSE 0.0 END AS z FROM s)
    SELECT tenant_id, event_type, window_start, count, round(z, 6) AS z_score, z > 3.0 AS is_anomaly FROM z
    """, "hourly"))
def zscore_windows_zero_filled(spark, sf_dir):
    """Windows without events count as zero, up to the newest window of any key: a key that falls silent is scored too."""
    hourly = _hourly(spark, sf_dir)
    newest = hourly.select(F.max("window_start")).scalar()
    return zscore_windows(fill_empty(hourly, HOUR, until=newest)).select(
        "tenant_id", "event_type", "window_start", "count", F.round("z_score", 6).alias("z_score"), "is_anomaly"
    )


@query("anomaly_burst", check_sql("""
    SELECT window_start - window_start % 86400000 AS step_start, count(*) AS anomalies, count(*) > 10 AS breach
    FROM scored WHERE z > 3.0 GROUP BY ALL""", "scored"))
def anomaly_burst_query(spark, sf_dir):
    """Days with more than ten anomalous windows over all tenants."""
    return anomaly_burst(_scored(spark, sf_dir), DAY)


@query("anomaly_signals", check_sql("""
    SELECT tenant_id, event_type, window_start, 'Anomaly: ' || event_type || ' z=' || printf('%.2f', z) AS message,
           round(z, 6) AS z_score, CAST(count AS DOUBLE) AS current_value, 'warning' AS severity
    FROM scored WHERE z > 3.0""", "scored"))
def anomaly_signals_query(spark, sf_dir):
    return _signals(spark, sf_dir).drop("window_end", "history_avg").withColumn("z_score", F.round("z_score", 6))


@query("anomaly_prompts", check_sql(f"""
    SELECT tenant_id, event_type, window_start,
           'Tenant: ' || tenant_id || ', Event: ' || event_type || ', Z-score: ' || printf('%.2f', z) || ', Current: ' ||
           printf('%.0f', CAST(count AS DOUBLE)) || ', Avg: ' || printf('%.0f', mean) || '. Explain in 2 sentences.' AS prompt,
           '{NO_MODEL_TEXT}' AS summary,
           CASE WHEN mean > 0 THEN printf('%.1f', count / mean) || 'x the usual rate of ' || event_type || ' events'
                ELSE 'first ' || event_type || ' events after a silent period' END AS rule_summary
    FROM scored WHERE z > 3.0""", "scored"))
def anomaly_prompts(spark, sf_dir):
    signals = _signals(spark, sf_dir)
    prompted = signals.withColumn(
        "prompt", anomaly_prompt("tenant_id", "event_type", "z_score", "current_value", "history_avg")
    ).withColumn("rule_summary", ratio_summary("event_type", "current_value", "history_avg"))
    return explain(prompted).select("tenant_id", "event_type", "window_start", "prompt", "summary", "rule_summary")


@query("text_formats", check_sql("""
    SELECT id, printf('%.2f', value / 8.0) AS two, printf('%.0f', value / 2.0) AS whole,
           CASE sev WHEN 'critical' THEN 'danger' WHEN 'warning' THEN 'warning' ELSE 'good' END AS color
    FROM (SELECT *, ['critical', 'warning', 'info', 'other'][CAST(seq % 4 AS INTEGER) + 1] AS sev FROM canon)"""))
def text_formats(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ["critical", "warning", "info", "other"]])
    severity = F.element_at(names, F.pmod("seq", F.lit(4)).cast("int") + 1)
    return load_events(spark, sf_dir).select(
        "id",
        fixed(F.col("value") / 8.0, 2).alias("two"),
        fixed(F.col("value") / 2.0, 0).alias("whole"),
        severity_color(severity).alias("color"),
    )


@query("compare_operators", check_sql("""
    , c AS (SELECT id, ['gt', 'lt', 'gte', 'lte', 'neq'][CAST(seq % 5 AS INTEGER) + 1] AS op, round(value) AS cur, 5.0 AS thr FROM canon)
    SELECT id, CASE op WHEN 'gt' THEN cur > thr WHEN 'lt' THEN cur < thr WHEN 'gte' THEN cur >= thr
                       WHEN 'lte' THEN cur <= thr ELSE false END AS fires FROM c"""))
def compare_operators(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ["gt", "lt", "gte", "lte", "neq"]])
    op = F.element_at(names, F.pmod("seq", F.lit(5)).cast("int") + 1)
    return load_events(spark, sf_dir).select(
        "id", alerts.compare(op, F.round("value"), F.lit(5.0)).alias("fires")
    )


@query("new_rules", check_sql("""
    , r AS (SELECT DISTINCT tenant_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS event_type,
                   CASE WHEN event_type = 'signup' THEN '' ELSE 'gt' END AS operator FROM canon)
    SELECT 'rule-' || md5(tenant_id || ':many ' || event_type || ':' || event_type || ':count:' || operator || ':1m:' || now) AS id,
           tenant_id, 'many ' || event_type AS name, event_type, operator, true AS enabled, now AS created_at
    FROM r, clock WHERE event_type <> '' AND operator <> ''""", "clock"))
def new_rules(spark, sf_dir):
    events = load_events(spark, sf_dir)
    kinds = events.select("tenant_id", "event_type").distinct()
    event_type = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type"))
    requests = kinds.select(
        F.col("tenant_id").alias("header_tenant"),
        F.lit("ignored").alias("tenant_id"),
        F.concat(F.lit("many "), event_type).alias("name"),
        event_type.alias("event_type"),
        F.lit("count").alias("metric"),
        F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.lit("gt")).alias("operator"),
        F.lit(10.0).alias("threshold"),
        F.lit("1m").alias("window"),
        F.lit("warning").alias("severity"),
        F.lit("").alias("slack_url"),
    )
    return alerts.new_rules(requests, latest_ms(events)).select(
        "id", "tenant_id", "name", "event_type", "operator", "enabled", "created_at"
    )


@query("rule_candidates", check_sql("""
    SELECT rule_id, tenant_id, event_type, window_type, current_value, threshold, fired_at FROM candidates
    """, "candidates"))
def rule_candidates(spark, sf_dir):
    return candidates(spark, sf_dir).select(
        "rule_id", "tenant_id", "event_type", "window_type", "current_value", "threshold", "fired_at"
    )


@query("fired_alerts", check_sql("""
    SELECT id, rule_id, tenant_id, rule_name, message, current_value, threshold, severity, fired_at FROM fired
    """, "fired"))
def fired_alerts(spark, sf_dir):
    return alerts.alert_records(fired(spark, sf_dir)).drop("resolved_at")


@query("fired_alerts_per_tenant", check_sql("""
    , steps(rule_id, tenant_id, t) AS (
        SELECT rule_id, tenant_id, min(fired_at) FROM candidates GROUP BY ALL
        UNION ALL
        SELECT f.rule_id, f.tenant_id, min(c.fired_at) FROM steps f JOIN candidates c ON c.rule_id = f.rule_id
               AND c.tenant_id = f.tenant_id AND c.fired_at >= f.t + 300000 GROUP BY f.rule_id, f.tenant_id)
    SELECT rule_id, tenant_id, t AS fired_at FROM steps""", "candidates"))
def fired_alerts_per_tenant(spark, sf_dir):
    return alerts.fire(candidates(spark, sf_dir), per_tenant=True).select("rule_id", "tenant_id", "fired_at")


@query("alert_json_roundtrip", check_sql("""
    SELECT id, message, current_value, fired_at, false AS has_resolved FROM fired""", "fired"))
def alert_json_roundtrip(spark, sf_dir):
    texts = alerts.alerts_to_json(fired(spark, sf_dir))
    flagged = texts.withColumn("has_resolved", F.contains("value", F.lit("resolved_at")))
    decoded = flagged.select("has_resolved", F.from_json("value", alerts.FIRED_ALERT).alias("a"))
    return decoded.select("a.id", "a.message", "a.current_value", "a.fired_at", "has_resolved")


@query("alert_history", check_sql("""
    SELECT id, tenant_id, fired_at, CASE severity WHEN 'critical' THEN 'danger' WHEN 'warning' THEN 'warning' ELSE 'good' END AS color
    FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY fired_at DESC, id) AS r FROM fired) WHERE r <= 1000
    """, "fired"))
def alert_history(spark, sf_dir):
    return alerts.alert_history(fired(spark, sf_dir)).select("id", "tenant_id", "fired_at", "color")


@query("alert_history_global", check_sql("""
    SELECT id, tenant_id, fired_at FROM (SELECT * FROM fired ORDER BY fired_at DESC, id LIMIT 1000)
    WHERE tenant_id = 'tenant-acme'""", "fired"))
def alert_history_global(spark, sf_dir):
    kept = alerts.alert_history(fired(spark, sf_dir), "tenant-acme", scope="global")
    return kept.select("id", "tenant_id", "fired_at")


@query("alerts_rollup", check_sql("""
    SELECT coalesce(tenant_id, '(all)') AS tenant_id, coalesce(severity, '(all)') AS severity,
           CAST(grouping(tenant_id, severity) AS BIGINT) AS level, count(*) AS alerts
    FROM fired GROUP BY ROLLUP (tenant_id, severity)""", "fired"))
def alerts_rollup(spark, sf_dir):
    return alerts.alert_rollup(fired(spark, sf_dir))


@query("alert_groups", check_sql("""
    , s AS (SELECT *, CASE WHEN fired_at - lag(fired_at) OVER (PARTITION BY tenant_id ORDER BY fired_at) > 300000
                           THEN 1 ELSE 0 END AS cut,
                   CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 WHEN 'info' THEN 1 ELSE 0 END AS sev FROM fired),
    g AS (SELECT *, sum(cut) OVER (PARTITION BY tenant_id ORDER BY fired_at) AS grp FROM s),
    r AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, grp ORDER BY sev DESC, fired_at, id) AS rk FROM g)
    SELECT tenant_id, min(fired_at) AS first_at, max(fired_at) AS last_at, count(*) AS alerts,
           max(id) FILTER (rk = 1) AS id, max(rule_id) FILTER (rk = 1) AS rule_id,
           max(severity) FILTER (rk = 1) AS severity, max(message) FILTER (rk = 1) AS message
    FROM r GROUP BY tenant_id, grp""", "fired"))
def alert_groups(spark, sf_dir):
    return alerts.group_alerts(fired(spark, sf_dir))


@query("alert_delay", check_sql("""
    , a AS (SELECT tenant_id, event_type, window_start + 3600000 AS anomaly_at FROM scored WHERE z > 3.0),
    j AS (SELECT a.*, (SELECT min(f.fired_at) FROM fired f WHERE f.tenant_id = a.tenant_id AND f.event_type = a.event_type
                       AND f.fired_at >= a.anomaly_at) AS alert_at FROM a)
    SELECT tenant_id, event_type, anomaly_at, coalesce(alert_at, -1) AS alert_at,
           coalesce(alert_at - anomaly_at, -1) AS delay_ms,
           CASE WHEN alert_at IS NULL THEN 'no alert' WHEN alert_at - anomaly_at > 300000 THEN 'breach'
                WHEN alert_at - anomaly_at >= 120000 THEN 'slow' ELSE 'ok' END AS delay_status
    FROM j""", "scored", "fired"))
def alert_delay(spark, sf_dir):
    found = _signals(spark, sf_dir).withColumn("anomaly_at", F.col("window_end"))
    none = F.lit(-1).cast("bigint")
    return alerts.alert_delay(found, fired(spark, sf_dir)).withColumns(
        {"alert_at": F.coalesce("alert_at", none), "delay_ms": F.coalesce("delay_ms", none)}
    )


