import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.timing import MINUTE, TUMBLING, floor_ms
from pulsegrid.operators.sessions import session_windows
from pulsegrid.operators.windows import approx_metrics, fill_empty, finish_approx, sliding_counts, window_counts, window_metrics

HOUR_WINDOW = {"tumbling_1h": 3_600_000}


def frame(spark, rows):
    return spark.createDataFrame(rows, "tenant_id string, event_type string, timestamp bigint, value double")


def one(spark, values):
    return window_metrics(frame(spark, [("t", "e", 5, float(v)) for v in values]), HOUR_WINDOW).collect()


def test_count_of_hundred(spark):
    (row,) = one(spark, range(100))
    assert row["count"] == 100


def test_average(spark):
    (row,) = one(spark, [10, 20, 30])
    assert row["avg"] == 20.0 and row["sum"] == 60.0


def test_empty_input_has_no_windows(spark):
    assert one(spark, []) == []


def test_p99_of_one_to_hundred(spark):
    (row,) = one(spark, range(1, 101))
    assert row["p99"] == 99.0


def test_window_bounds_nest(spark):
    rows = window_metrics(frame(spark, [("t", "e", 3_725_000, 1.0)])).collect()
    got = {r["window_type"]: (r["window_start"], r["window_end"]) for r in rows}
    assert got == {
        "tumbling_1m": (3_720_000, 3_780_000),
        "tumbling_5m": (3_600_000, 3_900_000),
        "tumbling_1h": (3_600_000, 7_200_000),
    }


def test_lengths_must_nest(spark):
    with pytest.raises(ValueError):
        window_metrics(frame(spark, []), {"a": 60_000, "b": 90_000})


def brute(rows, percent=99):
    groups = defaultdict(list)
    for tenant, kind, ts, value in rows:
        for name, ms in TUMBLING.items():
            groups[tenant, kind, name, ts - ts % ms].append(value)
    return {k: (len(v), sorted(v)[math.ceil(len(v) * percent / 100) - 1]) for k, v in groups.items()}


@pytest.mark.parametrize("bands", [1, 32])
def test_percentile_of_hot_windows(spark, bands):
    """One tenant and minute holds most rows; wide bands force the rank to be found inside one."""
    rng = random.Random(7)
    rows = [("hot", "e", 60_000 * 3 + rng.randrange(60_000), rng.uniform(-50, 50)) for _ in range(4000)]
    rows += [("hot", "e", rng.randrange(7_200_000), rng.expovariate(0.1)) for _ in range(3000)]
    rows += [("same", "e", rng.randrange(600_000), 4.5) for _ in range(500)]
    rows += [(f"t{rng.randrange(5)}", "x", rng.randrange(7_200_000), float(rng.randrange(9))) for _ in range(2000)]
    got = {
        (r["tenant_id"], r["event_type"], r["window_type"], r["window_start"]): (r["count"], r["p99"])
        for r in window_metrics(frame(spark, rows), bands=bands).collect()
    }
    assert got == brute(rows)


def test_weighted_rows_stand_for_events(spark):
    rng = random.Random(1)
    rows = [("t", "e", 0, float(rng.randrange(40))) for _ in range(900)]
    plain = window_metrics(frame(spark, rows), HOUR_WINDOW)
    packed = frame(spark, rows).groupBy("tenant_id", "event_type", "timestamp", "value").agg(F.count("*").alias("n"))
    weighted = window_metrics(packed, HOUR_WINDOW, weight="n")
    assert plain.collect() == weighted.collect()


def test_events_are_scanned_twice_and_cells_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "events")
    frame(spark, [("t", "e", i * 1000, float(i % 700)) for i in range(5000)]).write.parquet(path)
    df = window_metrics(spark.read.parquet(path), HOUR_WINDOW, bands=1)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.find("== Initial Plan ==")]
    assert final.count("FileScan") <= 2
    assert "ReusedExchange" in final


def test_floor_is_right_before_the_epoch(spark):
    row = spark.range(1).select(floor_ms(F.lit(-1).cast("bigint"), MINUTE).alias("w")).first()
    assert row["w"] == -60_000


def test_fill_empty(spark):
    counts = window_counts(frame(spark, [("t", "e", 0, 1.0), ("t", "e", 180_000, 1.0)]), MINUTE)
    got = {r["window_start"]: r["count"] for r in fill_empty(counts, MINUTE).collect()}
    assert got == {0: 1, 60_000: 0, 120_000: 0, 180_000: 1}


def test_sliding_counts_cover_each_event_ten_times(spark):
    rows = sliding_counts(frame(spark, [("t", "e", 1_000_000, 1.0)])).collect()
    assert len(rows) == 10
    assert all(r["window_start"] <= 1_000_000 < r["window_end"] for r in rows)


def test_sessions_against_spark(spark):
    rng = random.Random(3)
    rows = [("t", f"u{rng.randrange(3)}", rng.randrange(40_000_000)) for _ in range(300)]
    df = spark.createDataFrame(rows, "tenant_id string, user_id string, timestamp bigint")
    mine = session_windows(df)
    theirs = (
        df.groupBy("tenant_id", "user_id", F.session_window(F.timestamp_millis("timestamp"), "30 minutes").alias("w"))
        .agg(F.count("*").alias("count"))
        .select("tenant_id", "user_id", F.unix_millis("w.start"), F.unix_millis("w.end"), "count")
    )
    assert sorted(mine.collect()) == sorted(theirs.collect())


def test_gap_of_exactly_the_limit_ends_a_session(spark):
    rows = [("t", "u", 0), ("t", "u", 1_800_000), ("t", "u", 3_599_999)]
    df = spark.createDataFrame(rows, "tenant_id string, user_id string, timestamp bigint")
    assert sorted(r["count"] for r in session_windows(df).collect()) == [1, 2]


def test_approximate_metrics_count_the_same_events_and_values(spark):
    rows = [("t", "e", 5, None), ("t", "e", 6, 5.0), (None, "e", 7, float("nan")), ("t", None, 8, float("inf")), ("t", "e", None, 1.0)]
    exact = window_metrics(frame(spark, rows), HOUR_WINDOW)
    approx = finish_approx(approx_metrics(frame(spark, rows), HOUR_WINDOW))
    columns = ["tenant_id", "event_type", "window_start", "count", "sum", "avg", "p99"]
    assert sorted(approx.select(*columns).collect()) == sorted(exact.select(*columns).collect())
    assert {r["sum"] for r in exact.collect()} == {6.0, 1.0}


@pytest.mark.parametrize("kind", ["narrow", "ties", "two heaps", "mixed signs", "weighted"])
def test_percentile_inside_one_hot_band(spark, kind):
    """Many values of one band in one window: the part that holds the rank gives the exact nearest rank."""
    rng = random.Random(kind)
    draw = {
        "narrow": lambda: rng.uniform(1000, 1010),
        "ties": lambda: float(rng.choice([1000, 1003, 1003, 1007, 1009])),
        "two heaps": lambda: 1000 + rng.random() * 1e-9 if rng.random() < 0.985 else 1010 - rng.random() * 1e-9,
        "mixed signs": lambda: -rng.uniform(1000, 1010) if rng.random() < 0.995 else rng.uniform(1, 2),
        "weighted": lambda: rng.uniform(1000, 1010),
    }[kind]
    rows = [("t", "e", rng.randrange(0, 600_000), draw(), rng.randrange(1, 4) if kind == "weighted" else 1) for _ in range(20_000)]
    events = spark.createDataFrame(rows, "tenant_id string, event_type string, timestamp long, value double, w long")
    got = window_metrics(events, weight="w" if kind == "weighted" else None).collect()
    wanted = {}
    for name, ms in TUMBLING.items():
        for _, _, ts, v, w in rows:
            wanted.setdefault((name, ts - ts % ms), []).extend([v] * w)
    assert {(r["window_type"], r["window_start"]) for r in got} == set(wanted)
    for r in got:
        values = sorted(wanted[r["window_type"], r["window_start"]])
        assert (r["count"], r["p99"]) == (len(values), values[-(-99 * len(values) // 100) - 1])
