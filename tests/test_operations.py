import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.requests import clamp_minutes_value, with_request_defaults
from pulsegrid.operators import routing, slo


def traffic(spark, n=3000, hot=0.8, seed=1):
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < hot else f"t{rng.randrange(30)}", f"u{rng.randrange(500)}", "e", rng.randrange(60_000), float(i))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "tenant_id string, user_id string, event_type string, timestamp bigint, value double")


def test_only_the_large_tenant_is_hot(spark):
    assert [r["tenant_id"] for r in routing.hot_tenants(traffic(spark)).collect()] == ["hot"]


def test_sub_keys_level_the_partitions(spark):
    events = traffic(spark)
    worst = lambda df, key: df.agg(F.max("share")).first()[0] if key else None
    before = worst(routing.partition_load(events, "tenant_id"), True)
    routed = routing.with_route(events, routing.hot_tenants(events), shards=64)
    after = worst(routing.partition_load(routed, "route_key"), True)
    assert before > 0.8 and after < 0.3
    assert routed.count() == events.count()
    by_user = routing.with_route(events, routing.hot_tenants(events), by_user=True)
    assert by_user.where("tenant_id = 'hot'").first()["route_key"].startswith("hot:u")


def test_salted_equals_plain(spark):
    events = traffic(spark)
    keys = ["tenant_id", "event_type", "window_start"]
    salted = routing.salted_window_aggregate(events, 10_000).select(*keys, "count", "min", "max")
    plain = (
        events.withColumn("window_start", F.col("timestamp") - F.col("timestamp") % 10_000).groupBy(*keys)
        .agg(F.count("*").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"))
    )
    assert sorted(salted.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("limit", [1, 20, 60])
def test_quota_by_brute_force(spark, limit):
    events = traffic(spark, 2500).withColumn("n", F.col("value"))
    rows = [(r["tenant_id"], r["timestamp"], r["n"]) for r in events.collect()]
    expected = {
        n: sum(1 for t2, ts2, _ in rows if t2 == t and ts - 1000 < ts2 <= ts) > limit for t, ts, n in rows
    }
    got = {r["n"]: r["is_limited"] for r in slo.rate_limited(events, limit).collect()}
    assert got == expected


def test_sustained_breach(spark):
    flags = [1, 1, 0, 1, 1, 1, 0, 1]
    df = spark.createDataFrame([("k", i * 60_000, bool(f)) for i, f in enumerate(flags)], "k string, window_start bigint, breach boolean")
    got = slo.sustained_breaches(df, ["k"], 60_000, 120_000).orderBy("breach_start").collect()
    assert [(r["breach_start"], r["breach_end"], r["steps"]) for r in got] == [(0, 120_000, 2), (180_000, 360_000, 3)]


def test_counter_reset(spark):
    df = spark.createDataFrame([("c", 0, 10.0), ("c", 60_000, 16.0), ("c", 120_000, 4.0)], "k string, ts bigint, value double")
    got = [r["rate"] for r in slo.counter_rate(df, ["k"]).orderBy("ts").collect()]
    assert got == [0.0, 6 / 300, 10 / 300]


def test_quantile_of_buckets(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [("a", 1.0, 50), ("a", 2.0, 100), ("a", inf, 100), ("b", 1.0, 1), ("b", 2.0, 1), ("b", inf, 10)],
        "k string, le double, cum bigint",
    )
    got = {r["k"]: r["quantile"] for r in slo.histogram_quantile(df, ["k"], 0.75).collect()}
    assert got == {"a": 1.5, "b": 2.0}


def test_error_ratio(spark):
    df = spark.createDataFrame([("s", 1000, 200)] * 999 + [("s", 2000, 503)] * 2, "k string, timestamp bigint, status int")
    row = slo.error_ratio(df, F.col("status") >= 500, ["k"]).where("window_start = 0").first()
    assert row["errors"] == 2 and row["breach"] and not row["meets_target"]


def test_lag_levels_and_trend(spark):
    rows = [("events", 0, 0, 124_500, 174_500), ("events", 0, 1, 180_200, 180_300), ("events", 5, 0, 174_500, 174_500),
            ("events", 5, 1, 180_300, 192_000), ("events", 9, 0, 1, 1), ("events", 9, 1, 1, 60_002)]
    df = spark.createDataFrame(rows, "topic string, ts bigint, partition bigint, current bigint, log_end bigint")
    got = [(r["lag"], r["trend"], r["severity"]) for r in slo.consumer_lag(df).orderBy("ts").collect()]
    assert got == [(50_100, "unknown", "critical"), (11_700, "stable", "warning"), (60_001, "growing", "critical")]


@pytest.mark.parametrize("per_step, replicas", [(0, 3), (300 * 21_000, 5), (300 * 900_000, 20)])
def test_replicas_are_clamped(spark, per_step, replicas):
    df = spark.createDataFrame([("t", i * 300_000, per_step) for i in range(4)], "tenant_id string, window_start bigint, count bigint")
    now = F.lit(900_000).cast("bigint")
    assert slo.forecast_replicas(df, ["tenant_id"], 300_000, now).first()["replicas"] == replicas


def test_forecast_of_young_silent_and_growing_tenants(spark):
    step, now = 300_000, 40 * 300_000
    rows = [("young", now - i * step, 300 * 900_000) for i in range(1, 5)] + [("silent", step, 300 * 50_000), ("open", now, 10**9)]
    rows += [("grows", now - i * step, 300 * (20_000 - 1_000 * i)) for i in range(1, 13)] + [("one", now - step, 300 * 30_000)]
    df = spark.createDataFrame(rows, "tenant_id string, window_start bigint, count bigint")
    got = {r["tenant_id"]: r for r in slo.forecast_replicas(df, ["tenant_id"], step, F.lit(now).cast("bigint")).collect()}
    assert {k: r["replicas"] for k, r in got.items()} == {"young": 20, "silent": 3, "grows": 5, "one": 6}
    assert got["young"]["rate_now"] == pytest.approx(900_000)
    assert got["grows"]["slope_per_minute"] == pytest.approx(200) and got["grows"]["forecast_rate"] == pytest.approx(23_000)


def test_request_defaults(spark):
    df = spark.createDataFrame([("60", "7", "x", ""), (" 5", "", "9", "tumbling_1h")], "minutes string, from string, to string, window string")
    got = [tuple(r)[4:] for r in with_request_defaults(df, 5_000_000).collect()]
    assert got == [(60, 7, 5_000_000, "tumbling_1m"), (5, 1_400_000, 9, "tumbling_1h")]
    assert [clamp_minutes_value(m) for m in (5, 0, -1, 1440, 60)] == [5, 5, 5, 5, 60]


def test_dlq_limit(spark):
    assert slo.over_limit(spark.range(1001), 1000).first()["breach"] is True
    assert slo.over_limit(spark.range(1000), 1000).first()["breach"] is False
