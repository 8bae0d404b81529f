import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.anomaly import running_anomalies, running_counts, zscore_running, zscore_windows
from pulsegrid.operators.explain import explain



def level(centre, spread, length=24, seed=3):
    """Counts that wander around a level."""
    rng = random.Random(seed)
    return [centre + rng.randint(-spread, spread) for _ in range(length)]


def scores(spark, series, history=10):
    rows = [("t", "e", i, c) for i, c in enumerate(series)]
    df = spark.createDataFrame(rows, "tenant_id string, event_type string, window_start bigint, count bigint")
    out = zscore_windows(df, history=history).orderBy("window_start").collect()
    return [(r["z_score"], r["is_anomaly"]) for r in out]


@pytest.mark.parametrize("history", [10, 60])
@pytest.mark.parametrize(
    "series, flagged",
    [
        (level(40, 0, 7), False),  # too short
        (level(40, 0) + [44], False),  # no spread
        (level(40, 4) + [400], True),
        (level(3000, 25) + [0], True),
        (level(40, 4) + [44], False),
    ],
)
def test_last_value(spark, series, flagged, history):
    z, is_anomaly = scores(spark, series, history)[-1]
    assert is_anomaly is flagged
    assert (z > 3.0) is flagged


def test_no_spread_means_zero(spark):
    assert scores(spark, level(7, 0, 15) + [9])[-1][0] == 0.0


def test_too_little_history(spark):
    assert all(z == 0.0 for z, _ in scores(spark, [1, 50, 1, 900, 3, 4, 800, 2, 1, 70]))


def test_a_score_of_exactly_three_is_no_anomaly(spark):
    assert scores(spark, [0] * 9 + [1, 1])[-1] == (3.0, False)


def test_tenants_do_not_share_history(spark):
    rows = [("a", "e", i, 1000) for i in range(20)] + [("b", "e", 20, 1)]
    df = spark.createDataFrame(rows, "tenant_id string, event_type string, window_start bigint, count bigint")
    assert zscore_windows(df).where("is_anomaly").count() == 0


def simulate(rows, duration, history=10):
    past, counts, out = {}, {}, {}
    for ident, tenant, ts in sorted(rows, key=lambda r: (r[2], r[0])):
        window = (tenant, ts - ts % duration)
        counts[window] = counts.get(window, 0) + 1
        c, hist = counts[window], past.setdefault(tenant, [])
        z = 0.0
        if len(hist) >= history:
            mean = Fraction(sum(hist), history)
            variance = sum((v - mean) ** 2 for v in hist) / history
            z = math.sqrt((c - mean) ** 2 / variance) if variance > 0 else 0.0
            hist.pop(0)
        hist.append(c)
        out[ident] = (c, z)
    return out


@pytest.mark.parametrize("span", [200_000, 3_000_000])
def test_running_scores_against_a_loop(spark, span):
    rng = random.Random(span)
    rows = [(i, "hot" if i % 3 else f"t{i % 4}", rng.randrange(span)) for i in range(1500)]
    expected = simulate(rows, 60_000)
    df = spark.createDataFrame(rows, "seq bigint, tenant_id string, timestamp bigint").withColumn("event_type", F.lit("e"))
    got = {r["seq"]: r for r in zscore_running(df).collect()}
    assert {k: r["running_count"] for k, r in got.items()} == {k: c for k, (c, _) in expected.items()}
    assert all(abs(got[k]["z_score"] - z) < 1e-9 for k, (_, z) in expected.items())
    flags = running_anomalies(df).count()
    assert flags == sum(z > 3.0 for _, z in expected.values()) == sum(r["is_anomaly"] for r in got.values())


def test_running_counts_keep_other_columns(spark):
    df = spark.createDataFrame([("t", "e", 5, 1, "x")], "tenant_id string, event_type string, timestamp bigint, seq bigint, tag string")
    assert running_counts(df).first()["tag"] == "x"


def test_explain_hook(spark):
    df = spark.createDataFrame([("why",)], "prompt string")
    assert explain(df).first()["summary"] == "AI analysis unavailable: no API key configured"
    assert explain(df, lambda prompts: prompts.str.upper()).first()["summary"] == "WHY"
