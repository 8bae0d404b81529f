"""Rows that are easily lost: without value, key, arrival time or order."""

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.timing import DAY, HOUR, MINUTE
from pulsegrid.operators.anomaly import running_counts
from pulsegrid.operators.dedup import dedup_increment
from pulsegrid.operators.ingest import flag_late, for_windows
from pulsegrid.operators.slo import histogram_quantile, rate_limited, throughput
from pulsegrid.operators.windows import window_metrics
from pulsegrid.sources.canonical import load_events
from pulsegrid.sources.decode import decode_events
from pulsegrid.sources.tables import to_dead_letters

EVENT = "tenant_id string, event_type string, timestamp bigint, value double, seq bigint"


@pytest.mark.parametrize("odd", [None, float("nan"), float("inf"), float("-inf")])
def test_events_without_a_finite_value_count_as_one(spark, odd):
    rows = spark.createDataFrame([("t", "e", 1, odd, 1), ("t", "e", 2, 5.0, 2), (None, "e", 3, 2.0, 3)], EVENT)
    got = {(r["tenant_id"], r["window_type"]): (r["count"], r["sum"], r["p99"]) for r in window_metrics(rows).collect()}
    assert got[("t", "tumbling_1m")] == (2, 6.0, 5.0) and got[("", "tumbling_1h")] == (1, 2.0, 2.0)


def test_increment_older_than_what_was_accepted(spark):
    schema = "id string, timestamp bigint, seq bigint"
    seen = spark.createDataFrame([("a", 10 * DAY, 1), ("a", 20 * DAY, 2)], schema)
    new = [("a", 5 * DAY, 3), ("a", 12 * DAY, 4), ("a", 10 * DAY + DAY - 1, 5), ("a", 10 * DAY - 5, 6), ("a", 11 * DAY, 7), ("b", 10 * DAY, 8)]
    got = {r["seq"] for r in dedup_increment(spark.createDataFrame(new, schema), seen, ["id"]).collect()}
    assert got == {3, 7, 4, 8}


def test_unknown_arrival_is_not_late(spark):
    rows = spark.createDataFrame([(0, None), (0, 10 * MINUTE), (0, 1)], "timestamp bigint, received_at bigint")
    flagged = flag_late(rows.withColumn("labels", F.lit(None).cast("map<string,string>")))
    assert for_windows(flagged, "exclude").count() == 2


def test_rows_without_key_stay(spark):
    rows = spark.createDataFrame([(None, "e", 5, 1.0, 1), ("t", "e", 5, 1.0, 2), (None, "e", 6, 1.0, 3)], EVENT)
    assert sorted((r["seq"], r["recent_count"]) for r in rate_limited(rows).collect()) == [(1, 1), (2, 1), (3, 2)]
    assert sorted((r["seq"], r["running_count"]) for r in running_counts(rows).collect()) == [(1, 1), (2, 1), (3, 2)]


def test_silence_at_the_end_is_a_breach(spark):
    rows = spark.createDataFrame([("quiet", "e", 0, 1.0, 1), ("busy", "e", 0, 1.0, 2), ("busy", "e", 3 * HOUR, 1.0, 3)], EVENT)
    steps = throughput(rows, HOUR, ["tenant_id"], 1.0, below=True, per_ms=HOUR).where("tenant_id = 'quiet'")
    assert sorted((r["window_start"], r["breach"]) for r in steps.collect()) == [(0, False), (HOUR, True), (2 * HOUR, True), (3 * HOUR, True)]


def test_undecodable_text_reaches_the_dead_letters(spark):
    bad = decode_events(spark.createDataFrame([("{oops",)], "value string")).withColumn("error", F.lit("tenant_id is required"))
    (row,) = to_dead_letters(bad, "error", 7).collect()
    assert row["raw"] == "{oops" and row["error"] == "invalid JSON"


def test_time_bounds_reach_the_scan(spark):
    sf = "/root/testdata/sf0.001"
    lo, hi = load_events(spark, sf).select(F.min("timestamp"), F.max("timestamp")).first()
    start, end = lo + (hi - lo) // 3, hi - (hi - lo) // 3
    bounded = load_events(spark, sf, start, end)
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert bounded.count() == load_events(spark, sf).where(F.col("timestamp").between(start, end)).count() > 0


def test_series_without_samples_has_a_null_quantile(spark):
    rows = [("none", 1.0, 0), ("none", float("inf"), 0), ("some", 1.0, 0), ("some", 2.0, 4), ("some", float("inf"), 4)]
    buckets = spark.createDataFrame(rows, "k string, le double, cum bigint")
    at = lambda q: {r["k"]: r["quantile"] for r in histogram_quantile(buckets, ["k"], q).collect()}
    assert at(0.5) == {"none": None, "some": 1.5} and at(0.0) == {"none": None, "some": 1.0}
