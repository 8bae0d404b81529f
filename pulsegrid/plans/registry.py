"""Named queries, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# Shared parts of the check SQL, in dependency order.
CTES = {
    "canon": """
        SELECT CAST(event_id AS VARCHAR) AS id, event_id AS seq,
               ['tenant-acme', 'tenant-globex', 'tenant-initech'][CAST(user_id % 3 AS INTEGER) + 1] AS tenant_id,
               'user-' || CAST(user_id AS VARCHAR) AS user_id, event_type,
               epoch_us(ts) // 1000 AS timestamp, value,
               CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS amount,
               json_extract_string(props, '$.k') AS k
        FROM events""",
    "clock": "SELECT max(timestamp) AS now FROM canon",
    "lengths": """
        SELECT * FROM (VALUES ('tumbling_1m', 60000), ('tumbling_5m', 300000), ('tumbling_1h', 3600000))
        t(window_type, ms)""",
    "metrics": """
        SELECT tenant_id, event_type, window_type, timestamp - timestamp % ms AS window_start,
               timestamp - timestamp % ms + ms AS window_end, count(*) AS count,
               round(sum(value), 4) AS sum, round(sum(value), 4) / count(*) AS avg,
               quantile_disc(value, 0.99) AS p99
        FROM canon, lengths GROUP BY ALL""",
    "hourly": """
        SELECT tenant_id, event_type, timestamp - timestamp % 3600000 AS window_start, count(*) AS count
        FROM canon GROUP BY ALL""",
    "scored": """
        SELECT *, CASE WHEN n >= 10 AND n * q - s * s > 0
                       THEN CAST(abs(n * count - s) AS DOUBLE) / sqrt(CAST(n * q - s * s AS DOUBLE)) ELSE 0.0 END AS z
        FROM (SELECT *, count(*) OVER w AS n, sum(count) OVER w AS s, sum(count * count) OVER w AS q,
                     CAST(sum(count) OVER w AS DOUBLE) / count(*) OVER w AS mean
              FROM hourly WINDOW w AS (PARTITION BY tenant_id, event_type ORDER BY window_start
                                       ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING))""",
    "dirty": """
        SELECT seq, user_id,
               CASE WHEN seq % 50 = 3 THEN '' ELSE id END AS id,
               CASE WHEN seq % 7 = 0 AND seq % 50 <> 0 THEN 'tenant-header'
                    WHEN seq % 50 = 0 THEN '' ELSE tenant_id END AS tenant_id,
               CASE WHEN seq % 50 = 1 THEN '' ELSE event_type END AS event_type,
               CASE WHEN seq % 50 = 4 THEN 0 ELSE timestamp END AS timestamp,
               seq % 50 = 2 AS bad_payload
        FROM canon""",
    "checked": """
        SELECT seq, user_id, CASE WHEN id = '' THEN sha256(user_id || ':' || seq) ELSE id END AS id,
               tenant_id, event_type, CASE WHEN timestamp = 0 THEN now ELSE timestamp END AS timestamp,
               1 AS version, bad_payload,
               CASE WHEN tenant_id = '' THEN 'tenant_id is required'
                    WHEN event_type = '' OR bad_payload THEN 'invalid event' ELSE '' END AS error
        FROM dirty, clock""",
    "valid": """
        SELECT user_id || ':' || event_type AS key, timestamp, seq FROM checked WHERE error = ''""",
    "chain": """
        SELECT key, min(timestamp) AS t FROM valid GROUP BY key
        UNION ALL
        SELECT c.key, min(v.timestamp) FROM chain c
        JOIN valid v ON v.key = c.key AND v.timestamp >= c.t + 86400000 GROUP BY c.key""",
    "accepted": """
        SELECT v.key, v.timestamp, min(v.seq) AS seq FROM valid v
        JOIN chain c ON v.key = c.key AND v.timestamp = c.t GROUP BY v.key, v.timestamp""",
    "statuses": """
        SELECT k.seq, CASE WHEN k.error <> '' THEN k.error WHEN a.seq IS NULL THEN 'duplicate'
                           ELSE 'accepted' END AS status
        FROM checked k LEFT JOIN accepted a ON a.seq = k.seq""",
    "rules": """
        SELECT * FROM (VALUES
          ('rule-default-error', '*', 'High Error Rate', 'error', 'count', 'gt', 100.0, 'tumbling_1m', 'critical', true),
          ('rule-any-error', '*', 'Any error', 'error', 'count', 'gte', 1.0, 'tumbling_1m', 'warning', true),
          ('rule-acme-clicks', 'tenant-acme', 'Busy clicks', 'click', 'rate', 'gt', 0.0005, 'tumbling_1h', 'info', true),
          ('rule-globex-p99', 'tenant-globex', 'Large purchase', 'purchase', 'p99_latency', 'gt', 200.0, 'tumbling_5m', 'critical', true),
          ('rule-few-views', '*', 'Few views', 'view', 'count', 'lt', 2.0, 'tumbling_1h', 'warning', true),
          ('rule-few-signups', 'tenant-initech', 'Few signups', 'signup', 'count', 'lte', 1.0, 'tumbling_5m', 'info', true),
          ('rule-off', '*', 'Switched off', 'click', 'count', 'gte', 1.0, 'tumbling_1m', 'critical', false),
          ('rule-odd', '*', 'Unknown operator', 'click', 'count', 'neq', 1.0, 'tumbling_1m', 'critical', true)
        ) t(rule_id, rule_tenant, rule_name, event_type, metric, operator, threshold, window_type, severity, enabled)""",
    "candidates": """
        SELECT * FROM (
          SELECT r.rule_id, r.rule_name, m.tenant_id, m.event_type, m.window_type, r.metric, r.operator,
                 CAST(r.threshold AS DOUBLE) AS threshold, r.severity,
                 CASE r.metric WHEN 'count' THEN CAST(m.count AS DOUBLE) WHEN 'rate' THEN m.count / (l.ms / 1000.0)
                      WHEN 'p99_latency' THEN m.p99 END AS current_value, m.window_end AS fired_at
          FROM metrics m JOIN lengths l ON l.window_type = m.window_type
          JOIN rules r ON r.enabled AND r.event_type = m.event_type AND r.window_type = m.window_type
               AND (r.rule_tenant = '*' OR r.rule_tenant = m.tenant_id))
        WHERE CASE operator WHEN 'gt' THEN current_value > threshold WHEN 'lt' THEN current_value < threshold
                            WHEN 'gte' THEN current_value >= threshold WHEN 'lte' THEN current_value <= threshold
                            ELSE false END""",
    "fires": """
        SELECT rule_id, min(fired_at) AS t FROM candidates GROUP BY rule_id
        UNION ALL
        SELECT f.rule_id, min(c.fired_at) FROM fires f
        JOIN candidates c ON c.rule_id = f.rule_id AND c.fired_at >= f.t + 300000 GROUP BY f.rule_id""",
    "fired": """
        SELECT 'alert-' || md5(rule_id || ':' || tenant_id || ':' || fired_at) AS id, *,
               '[' || severity || '] ' || rule_name || ': ' || metric || ' ' || operator || ' ' ||
               printf('%.2f', threshold) || ' (current: ' || printf('%.2f', current_value) || ')' AS message
        FROM (SELECT c.*, row_number() OVER (PARTITION BY c.rule_id, c.fired_at ORDER BY c.tenant_id) AS rn
              FROM candidates c JOIN fires f ON f.rule_id = c.rule_id AND f.t = c.fired_at)
        WHERE rn = 1""",
}

NEEDS = {
    "canon": [],
    "clock": ["canon"],
    "lengths": [],
    "metrics": ["canon", "lengths"],
    "hourly": ["canon"],
    "scored": ["hourly"],
    "dirty": ["canon"],
    "checked": ["dirty", "clock"],
    "valid": ["checked"],
    "chain": ["valid"],
    "accepted": ["valid", "chain"],
    "statuses": ["checked", "accepted"],
    "rules": [],
    "candidates": ["metrics", "lengths", "rules"],
    "fires": ["candidates"],
    "fired": ["candidates", "fires"],
}


def check_sql(body: str, *ctes: str) -> str:
    """`body` behind the named shared parts and what they need."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for n in NEEDS[name]:
            visit(n)
        if name not in wanted:
            wanted.append(name)

    for c in ctes or ("canon",):
        visit(c)
    parts = ",\n".join(
        f"{n}(key, t) AS ({CTES[n]})" if n == "chain" else f"{n}(rule_id, t) AS ({CTES[n]})" if n == "fires"
        else f"{n} AS ({CTES[n]})"
        for n in wanted
    )
    return f"WITH RECURSIVE {parts}\n{body}"
