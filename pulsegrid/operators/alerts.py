"""Alert rules over window metrics: matching, cooldown, history, grouping, delay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.texts import alert_message, severity_color, severity_rank
from ..functions.timing import HOUR, MINUTE, RULE_WINDOWS, TUMBLING, col
from ..schemas import ALERT_RULE, FIRED_ALERT
from .chains import mark_chain
from .sessions import number_by_gap
from .windows import counts_by_length, window_metrics

COOLDOWN = 5 * MINUTE
HISTORY_CAP = 1000
GROUP_GAP = 5 * MINUTE
ANY_TENANT = "*"

# The rule every installation starts with.
DEFAULT_RULE = {
    "id": "rule-default-error",
    "tenant_id": "*",
    "name": "High Error Rate",
    "event_type": "error",
    "metric": "count",
    "operator": "gt",
    "threshold": 100.0,
    "window": "1m",
    "severity": "critical",
    "slack_url": "",
    "enabled": True,
    "created_at": 0,
}


def rules_frame(spark: SparkSession, rules: list[dict]) -> DataFrame:
    """Rules written in code, as a literal relation whose small size the optimizer knows."""
    full = [{**DEFAULT_RULE, **r} for r in rules]
    entries = [
        F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in ALERT_RULE]) for r in full
    ]
    return spark.range(1).select(F.inline(F.array(*entries)))


def new_rules(requests: DataFrame, now_ms: int | Column) -> DataFrame:
    """Rules from creation requests: type and operator are required, new rules are enabled.

    Tenant, id and time are set here whatever the request says.
    """
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
    ok = (F.coalesce("event_type", F.lit("")) != "") & (F.coalesce("operator", F.lit("")) != "")
    body = F.concat_ws(":", "header_tenant", "name", "event_type", "metric", "operator", "window", now)
    return (
        requests.where(ok)
        .withColumn("id", F.concat(F.lit("rule-"), F.md5(body)))
        .withColumn("tenant_id", F.coalesce("header_tenant", F.lit("")))
        .withColumn("enabled", F.lit(True))
        .withColumn("created_at", now)
        .select(*ALERT_RULE.fieldNames())
    )


def compare(operator: str | Column, current: Column, threshold: Column) -> Column:
    op = col(operator)
    return (
        F.when(op == "gt", current > threshold)
        .when(op == "lt", current < threshold)
        .when(op == "gte", current >= threshold)
        .when(op == "lte", current <= threshold)
        .otherwise(F.lit(False))
    )


def match_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Enabled rules joined to the windows they watch.

    Each window looks for rules of its own tenant and of any tenant, so the join is by equality
    on all three columns and a rule of one tenant never meets windows of another. No hint is
    given: Spark broadcasts the rules while their measured size allows it and shuffles them,
    splitting skewed keys, beyond that.
    """
    names = F.create_map(*[F.lit(x) for pair in RULE_WINDOWS.items() for x in pair])
    active = rules.where("enabled").select(
        F.col("id").alias("rule_id"),
        F.col("tenant_id").alias("rule_tenant"),
        F.col("name").alias("rule_name"),
        "event_type", "metric", "operator", "threshold", "severity",
        F.element_at(names, F.col("window")).alias("window_type"),
    )
    both = metrics.withColumn("rule_tenant", F.explode(F.array("tenant_id", F.lit(ANY_TENANT))))
    return both.join(active, ["event_type", "window_type", "rule_tenant"])


def watched_events(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Events of types that some enabled rule watches, so that no other windows are built."""
    types = rules.where("enabled").select("event_type").distinct()
    return events.join(types, "event_type", "left_semi")


def evaluate_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidate alerts, dated at the end of their window."""
    length = F.create_map(*[F.lit(x) for n, ms in TUMBLING.items() for x in (n, ms)])
    seconds = F.element_at(length, F.col("window_type")) / F.lit(1000.0)
    current = (
        F.when(F.col("metric") == "count", F.col("count").cast("double"))
        .when(F.col("metric") == "rate", F.col("count") / seconds)
        .when(F.col("metric") == "p99_latency", F.col("p99"))
    )
    return (
        match_rules(metrics, rules)
        .withColumn("current_value", current)
        .where(compare("operator", F.col("current_value"), F.col("threshold")))
        .select(
            "rule_id", "rule_tenant", "rule_name", "tenant_id", "event_type", "window_type", "metric",
            "operator", "threshold", "severity", "current_value", F.col("window_end").alias("fired_at"),
        )
    )


def rule_candidates(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidate alerts of all rules from events: exact percentiles only where a rule asks for them.

    Count and rate rules need counts per window, which combine on the map side; only events of types with
    a percentile rule go through `window_metrics`. Equal to `evaluate_rules` over the metrics of all windows.
    """
    by_percentile = rules.where(F.col("metric") == "p99_latency")
    by_count = rules.where(F.col("metric").isin("count", "rate"))
    counts = counts_by_length(watched_events(events, by_count)).withColumn("p99", F.lit(None).cast("double"))
    return evaluate_rules(counts, by_count).unionByName(
        evaluate_rules(window_metrics(watched_events(events, by_percentile)), by_percentile)
    )


def fire(
    candidates: DataFrame, cooldown_ms: int = COOLDOWN, per_tenant: bool = False, notify: bool = True
) -> DataFrame:
    """Alerts that survive the cooldown of their rule.

    A rule fires when it has not fired within the cooldown; exactly the cooldown later it may.
    Candidates of one moment share it: the smallest tenant id wins. Firing is greedy, so it is
    decided on the distinct window ends of a rule, whose number is bounded by time.
    """
    keys = ["rule_id", "tenant_id"] if per_tenant else ["rule_id"]
    first = candidates.groupBy(*keys, "fired_at").agg(
        F.min_by(F.struct(*[c for c in candidates.columns if c not in (*keys, "fired_at")]),
                 F.struct("tenant_id", "event_type", "window_type")).alias("_c")
    )
    kept = mark_chain(first, keys, "fired_at", cooldown_ms).where("_taken").select(*keys, "fired_at", "_c.*")
    key = F.concat_ws(":", "rule_id", "tenant_id", F.col("fired_at").cast("string"))
    return kept.select(
        F.concat(F.lit("alert-"), F.md5(key)).alias("id"),
        "rule_id",
        "tenant_id",
        "rule_name",
        alert_message("severity", "rule_name", "metric", "operator", "threshold", "current_value").alias("message"),
        "current_value",
        "threshold",
        "severity",
        "fired_at",
        F.lit(None).cast("bigint").alias("resolved_at"),
        "event_type",
        F.lit(notify).alias("notify"),
    )


def alert_records(alerts: DataFrame) -> DataFrame:
    return alerts.select(*FIRED_ALERT.fieldNames())


def alerts_to_json(alerts: DataFrame) -> DataFrame:
    """One JSON text per alert; an unresolved one has no `resolved_at`."""
    return alerts.select(F.to_json(F.struct(*FIRED_ALERT.fieldNames())).alias("value"))


def rules_to_json(rules: DataFrame) -> DataFrame:
    """One JSON text per rule; an empty `slack_url` is left out."""
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) if c == "slack_url" else F.col(c) for c in ALERT_RULE.fieldNames()]
    return rules.select(F.to_json(F.struct(*fields)).alias("value"))


def alerts_from_json(texts: DataFrame) -> DataFrame:
    return texts.select(F.from_json("value", FIRED_ALERT).alias("a")).select("a.*")


def alert_history(
    alerts: DataFrame, tenant: str | None = None, scope: str = "tenant", cap: int = HISTORY_CAP
) -> DataFrame:
    """Newest alerts with colour, `cap` per tenant or, with scope='global', over all tenants.

    The cap is the feature; it is taken before the tenant filter in the global scope. In tenant
    scope Spark limits each group on the map side before the shuffle.
    """
    newest = [F.col("fired_at").desc(), F.col("id")]
    if scope == "global":
        kept = alerts.orderBy(*newest).limit(cap)
    else:
        rank = F.row_number().over(W.partitionBy("tenant_id").orderBy(*newest))
        kept = alerts.withColumn("_r", rank).where(F.col("_r") <= cap).drop("_r")
    if tenant is not None:
        kept = kept.where(F.col("tenant_id") == tenant)
    return kept.withColumn("color", severity_color("severity"))


def alert_rollup(alerts: DataFrame) -> DataFrame:
    """Counts by tenant and severity, per tenant, and in all."""
    return (
        alerts.rollup("tenant_id", "severity")
        .agg(F.count("*").alias("alerts"), F.grouping_id().cast("bigint").alias("level"))
        .select(
            F.coalesce("tenant_id", F.lit("(all)")).alias("tenant_id"),
            F.coalesce("severity", F.lit("(all)")).alias("severity"),
            "level",
            "alerts",
        )
    )


def group_alerts(alerts: DataFrame, gap_ms: int = GROUP_GAP) -> DataFrame:
    """Related alerts of a tenant collapse into one root-cause row.

    A pause longer than the gap starts a new group. The representative is the most severe
    alert, then the earliest. Alerts of one moment are merged before the groups are formed, so
    the ordered part per tenant is bounded by the number of moments.
    """
    rank = F.struct((-severity_rank("severity")).alias("r"), F.col("fired_at"), F.col("id"))
    root = F.struct("id", "rule_id", "severity", "message")
    moments = alerts.groupBy("tenant_id", "fired_at").agg(
        F.count("*").alias("_n"), F.min(rank).alias("_rank"), F.min_by(root, rank).alias("_root")
    )
    return (
        number_by_gap(moments, ["tenant_id"], "fired_at", "fired_at", gap_ms, inclusive=False)
        .groupBy("tenant_id", "_group")
        .agg(
            F.min("fired_at").alias("first_at"),
            F.max("fired_at").alias("last_at"),
            F.sum("_n").alias("alerts"),
            F.min_by("_root", "_rank").alias("_root"),
        )
        .select("tenant_id", "first_at", "last_at", "alerts", "_root.*")
    )


def pass_through_groups(alerts: DataFrame) -> DataFrame:
    """Grouping without a model: every alert is its own group."""
    return alerts


def alert_delay(
    anomalies: DataFrame, alerts: DataFrame, at: str = "anomaly_at", target_ms: int = 2 * MINUTE,
    limit_ms: int = 5 * MINUTE, chunk_ms: int = 24 * HOUR,
) -> DataFrame:
    """First alert at or after each anomaly of the same tenant and type, and the delay.

    A forward as-of join without pairing: both sides are merged per key and day and the next
    alert is looked up by a window function that reads backwards in time. An anomaly with no later alert on its day takes the
    first alert of the next day that has one, found over one row per key and day.
    """
    keys = ["tenant_id", "event_type"]
    chunk = lambda c: F.expr(f"({c} - pmod({c}, {chunk_ms}L)) div {chunk_ms}L")
    left = anomalies.select(*keys, F.col(at).alias("_t"), F.lit(None).cast("bigint").alias("_alert"))
    right = alerts.select(*keys, F.col("fired_at").alias("_t"), F.col("fired_at").alias("_alert"))
    both = left.unionByName(right).withColumn("_chunk", chunk("_t"))
    ahead = W.partitionBy(*keys, "_chunk").orderBy(F.desc("_t")).rangeBetween(W.unboundedPreceding, W.currentRow)
    near = both.withColumn("_near", F.last("_alert", ignorenulls=True).over(ahead)).where("_alert IS NULL")
    firsts = both.groupBy(*keys, "_chunk").agg(F.min("_alert").alias("_first"))
    later = W.partitionBy(*keys).orderBy(F.desc("_chunk")).rowsBetween(W.unboundedPreceding, -1)
    next_day = firsts.select(*keys, "_chunk", F.last("_first", ignorenulls=True).over(later).alias("_next"))
    alert_at = F.coalesce("_near", "_next")
    delay = F.col("alert_at") - F.col(at)
    return (
        near.join(next_day, [*keys, "_chunk"])
        .select(*keys, F.col("_t").alias(at), alert_at.alias("alert_at"))
        .withColumn("delay_ms", delay)
        .withColumn(
            "delay_status",
            F.when(delay.isNull(), "no alert")
            .when(delay > limit_ms, "breach")
            .when(delay >= target_ms, "slow")
            .otherwise("ok"),
        )
    )
