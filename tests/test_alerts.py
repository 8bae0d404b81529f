import json
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.texts import fixed, severity_color
from pulsegrid.operators import alerts
from pulsegrid.operators.windows import window_metrics
from pulsegrid.schemas import FIRED_ALERT, WINDOW_METRICS


@pytest.mark.parametrize(
    "op, current, threshold, fires",
    [("gt", 150, 100, True), ("gt", 50, 100, False), ("lt", 5, 10, True), ("gte", 100, 100, True),
     ("lte", 100, 100, True), ("neq", 5, 10, False)],
)
def test_compare(spark, op, current, threshold, fires):
    row = spark.range(1).select(alerts.compare(F.lit(op), F.lit(float(current)), F.lit(float(threshold))).alias("x"))
    assert row.first()["x"] is fires


@pytest.mark.parametrize("severity, color", [("critical", "danger"), ("warning", "warning"), ("info", "good"), ("", "good")])
def test_colors(spark, severity, color):
    assert spark.range(1).select(severity_color(F.lit(severity)).alias("c")).first()["c"] == color


@pytest.mark.parametrize("x, digits, text", [(0.125, 2, "0.12"), (1.005, 2, "1.00"), (850.0, 0, "850"), (1234567.5, 2, "1234567.50")])
def test_fixed_point(spark, x, digits, text):
    assert spark.range(1).select(fixed(F.lit(x), digits).alias("t")).first()["t"] == text


def metrics(spark, rows):
    full = [(t, e, w, end - 60_000, end, n, float(n), 1.0, p) for t, e, w, end, n, p in rows]
    return spark.createDataFrame(full, WINDOW_METRICS)


def test_default_rule_watches_all_tenants(spark):
    rules = alerts.rules_frame(spark, [{}])
    rows = [("acme", "error", "tumbling_1m", 60_000, 101, 1.0), ("other", "error", "tumbling_1m", 60_000, 100, 1.0),
            ("acme", "click", "tumbling_1m", 60_000, 900, 1.0), ("acme", "error", "tumbling_5m", 60_000, 900, 1.0)]
    got = alerts.evaluate_rules(metrics(spark, rows), rules).collect()
    assert [(r["tenant_id"], r["current_value"]) for r in got] == [("acme", 101.0)]


def test_metrics_of_rules(spark):
    rules = alerts.rules_frame(
        spark,
        [{"id": "r", "metric": "rate", "operator": "gte", "threshold": 2.0},
         {"id": "p", "metric": "p99_latency", "threshold": 40.0}, {"id": "u", "metric": "median", "threshold": 0.0},
         {"id": "off", "threshold": 0.0, "enabled": False}, {"id": "mine", "tenant_id": "t", "threshold": 1.0},
         {"id": "theirs", "tenant_id": "x", "threshold": 1.0}],
    )
    got = alerts.evaluate_rules(metrics(spark, [("t", "error", "tumbling_1m", 60_000, 120, 50.0)]), rules).collect()
    assert {r["rule_id"]: r["current_value"] for r in got} == {"r": 2.0, "p": 50.0, "mine": 120.0}


def test_candidates_from_events_equal_those_from_all_metrics(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["error", "click", "view", None]), rng.randrange(0, 7_200_000) if rng.random() < 0.98 else None,
             rng.choice([None, float("nan"), rng.uniform(0, 50)])) for _ in range(4000)]
    events = spark.createDataFrame(rows, "tenant_id string, event_type string, timestamp long, value double")
    asked = [{"event_type": e, "metric": m, "window": w, "threshold": t, "tenant_id": tenant, "enabled": on}
             for e, m, w, t, tenant, on in [("error", "count", "1m", 3.0, "*", True), ("error", "p99_latency", "5m", 49.0, "*", True),
                                            ("click", "rate", "1h", 0.01, "a", True), ("click", "count", "5m", 1.0, "b", False),
                                            ("view", "p99_latency", "1h", 1.0, "a", True), ("view", "median", "1m", 0.0, "*", True)]]
    rules = alerts.rules_frame(spark, [{"id": f"r{i}", **r} for i, r in enumerate(asked)])
    whole = alerts.evaluate_rules(window_metrics(alerts.watched_events(events, rules)), rules)
    got = alerts.rule_candidates(events, rules)
    assert got.columns == whole.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    assert {r["rule_id"] for r in got.collect()} == {"r0", "r1", "r2", "r4"}


def test_candidates_without_percentile_rules(spark):
    events = spark.createDataFrame([("a", "error", 5, 1.0)] * 3, "tenant_id string, event_type string, timestamp long, value double")
    got = alerts.rule_candidates(events, alerts.rules_frame(spark, [{"threshold": 2.0}])).collect()
    assert [(r["rule_id"], r["current_value"], r["fired_at"]) for r in got] == [("rule-default-error", 3.0, 60_000)]


def candidates(spark, times, rule="r", tenant="t"):
    rows = [(rule, "*", "High", tenant, "error", "tumbling_1m", "count", "gt", 100.0, "critical", 150.0, t) for t in times]
    names = ("rule_id rule_tenant rule_name tenant_id event_type window_type metric operator threshold severity "
             "current_value fired_at").split()  # fmt: skip
    return spark.createDataFrame(rows, names)


def test_cooldown_boundary(spark):
    fired = alerts.fire(candidates(spark, [0, 299_999, 300_000, 360_000, 600_000])).collect()
    assert sorted(r["fired_at"] for r in fired) == [0, 300_000, 600_000]


def test_cooldown_scope(spark):
    both = candidates(spark, [0], tenant="b").unionByName(candidates(spark, [0, 60_000], tenant="a"))
    assert [r["tenant_id"] for r in alerts.fire(both).collect()] == ["a"]
    assert sorted(r["tenant_id"] for r in alerts.fire(both, per_tenant=True).collect()) == ["a", "b"]


def test_message_and_json_round_trip(spark):
    fired = alerts.fire(candidates(spark, [0]))
    text = alerts.alerts_to_json(fired).first()["value"]
    assert json.loads(text)["message"] == "[critical] High: count gt 100.00 (current: 150.00)"
    assert "resolved_at" not in json.loads(text)
    back = alerts.alerts_from_json(spark.createDataFrame([(text,)], "value string"))
    assert back.schema == FIRED_ALERT
    assert back.collect() == alerts.alert_records(fired).collect()


def test_history_caps(spark):
    many = candidates(spark, range(0, 1_000_000 * 400, 1_000_000), tenant="a").unionByName(
        candidates(spark, range(500_000, 1_000_000 * 400, 1_000_000), rule="s", tenant="b")
    )
    fired = alerts.fire(many)
    assert alerts.alert_history(fired, cap=300).count() == 600
    assert alerts.alert_history(fired, "a", scope="global", cap=301).count() == 150


def test_groups(spark):
    empty = alerts.fire(candidates(spark, [0])).where("false")
    assert alerts.group_alerts(empty).count() == 0
    rows = alerts.group_alerts(alerts.fire(candidates(spark, [0, 300_000, 600_001, 900_001]))).collect()
    assert sorted((r["first_at"], r["alerts"]) for r in rows) == [(0, 2), (600_001, 2)]
    one = alerts.fire(candidates(spark, [0]))
    assert alerts.group_alerts(one).first()["id"] == one.first()["id"]
    assert alerts.pass_through_groups(one).collect() == one.collect()


def test_delay_crosses_days(spark):
    day = 86_400_000
    anomalies = spark.createDataFrame([("t", "error", 10), ("t", "error", day - 5), ("t", "click", 1)],
                                      "tenant_id string, event_type string, anomaly_at bigint")
    fired = spark.createDataFrame([("t", "error", 10), ("t", "error", 3 * day + 7)],
                                  "tenant_id string, event_type string, fired_at bigint")
    got = {(r["event_type"], r["anomaly_at"]): (r["alert_at"], r["delay_status"])
           for r in alerts.alert_delay(anomalies, fired).collect()}
    assert got == {("error", 10): (10, "ok"), ("error", day - 5): (3 * day + 7, "breach"), ("click", 1): (None, "no alert")}


def test_new_rules(spark):
    rows = [("acme", "n", "error", "count", "gt", 5.0, "1m", "info", ""), ("acme", "n", "", "count", "gt", 5.0, "1m", "info", ""),
            ("acme", "n", "error", "count", "", 5.0, "1m", "info", "")]
    names = "header_tenant name event_type metric operator threshold window severity slack_url".split()
    got = alerts.new_rules(spark.createDataFrame(rows, names), 99).collect()
    assert [(r["tenant_id"], r["enabled"], r["created_at"]) for r in got] == [("acme", True, 99)]


def test_rule_json_omits_an_empty_url(spark):
    rules = alerts.rules_frame(spark, [{}, {"id": "x", "slack_url": "hook"}])
    texts = {json.loads(r["value"])["id"]: json.loads(r["value"]) for r in alerts.rules_to_json(rules).collect()}
    assert "slack_url" not in texts["rule-default-error"] and texts["x"]["slack_url"] == "hook"
    assert texts["rule-default-error"]["enabled"] is True
