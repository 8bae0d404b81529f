import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.dedup import dedup_increment, drop_duplicates, mark_duplicates

HOUR, DAY = 3_600_000, 86_400_000


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, timestamp bigint, seq bigint")


def loop(rows, ttl):
    last, kept = {}, set()
    for key, ts, seq in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or ts - last[key] >= ttl:
            last[key] = ts
            kept.add((key, ts, seq))
    return kept


def test_copy_is_rejected_and_does_not_extend_the_period(spark):
    rows = [("a", 0, 1), ("a", 20 * HOUR, 2), ("a", 24 * HOUR, 3), ("a", 47 * HOUR, 4), ("b", 5, 5)]
    got = {r["seq"]: r["is_duplicate"] for r in mark_duplicates(frame(spark, rows), ["id"]).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_same_millisecond_keeps_the_first(spark):
    got = drop_duplicates(frame(spark, [("a", 7, 3), ("a", 7, 1), ("a", 7, 2)]), ["id"]).collect()
    assert [r["seq"] for r in got] == [1]


def data(seed, n=4000, span=12 * DAY):
    """A third of all rows is one key, another key repeats one moment, many keys are single."""
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(span), i) for i in range(n // 3)]
    rows += [("burst", 3 * DAY + 17, i) for i in range(n // 3, n // 2)]
    rows += [(f"k{rng.randrange(60)}", rng.randrange(span), i) for i in range(n // 2, n - 200)]
    rows += [(f"single{i}", rng.randrange(span), i) for i in range(n - 200, n)]
    return rows


@pytest.mark.parametrize("ttl", [DAY, 5 * HOUR])
def test_against_a_loop(spark, ttl):
    rows = data(ttl)
    marked = mark_duplicates(frame(spark, rows), ["id"], ttl_ms=ttl)
    got = {(r["id"], r["timestamp"], r["seq"]) for r in marked.where("NOT is_duplicate").collect()}
    assert got == loop(rows, ttl)
    assert marked.count() == len(rows)


def test_ineligible_rows_do_not_count(spark):
    df = frame(spark, [("a", 0, 1), ("a", 10, 2)])
    got = mark_duplicates(df, ["id"], eligible=F.col("seq") != 1).collect()
    assert not any(r["is_duplicate"] for r in got)


def test_increments_equal_one_pass(spark):
    rows = data(5)
    cut = 6 * DAY
    df = frame(spark, rows)
    seen = drop_duplicates(df.where(F.col("timestamp") < cut), ["id"])
    new = dedup_increment(df.where(F.col("timestamp") >= cut), seen, ["id"])
    got = {(r["id"], r["timestamp"], r["seq"]) for r in seen.unionByName(new).collect()}
    assert got == loop(rows, DAY)
