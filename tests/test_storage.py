import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.timing import DAY, between_ms
from pulsegrid.operators import analytics, views
from pulsegrid.plans.fixtures import dirty
from pulsegrid.operators.ingest import validate
from pulsegrid.session import CHECKPOINT_KEY, cut_lineage, shared_dir, sizing
from pulsegrid.sources.canonical import load_events
from pulsegrid.sources.tables import (
    expired_partitions, from_dead_letters, read_raw_events, replay, retain, table_health, to_dead_letters, write_raw_events,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "events")
    write_raw_events(load_events(spark, SF), path, partitions=4)
    return read_raw_events(spark, path)


def test_round_trip(spark, stored):
    assert stored.count() == load_events(spark, SF).count()


def test_time_and_tenant_prune_partitions(stored):
    first = stored.select(F.min("timestamp")).first()[0]
    df = between_ms(analytics.for_tenant(stored, "tenant-acme"), first, first + DAY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.find("PartitionFilters") : plan.find("PushedFilters")]
    assert "tenant_id" in filters and "event_date" in filters
    assert "GreaterThanOrEqual(timestamp" in plan
    files = df.select(F.input_file_name()).distinct().count()
    assert files <= 4


def test_hot_tenant_is_cut_by_range(spark, tmp_path):
    rows = spark.range(9000).selectExpr(
        "cast(id as string) id", "if(id % 3 = 0, concat('t', id % 50), 'hot') tenant_id", "'u' user_id", "'e' event_type",
        "'s' source", "1700000000000 + id * 100 as timestamp", "1 version", "'{}' payload", "map('a', 'b') labels",
    )
    path = str(tmp_path / "hot")
    write_raw_events(rows, path, partitions=8)
    hot = read_raw_events(spark, path).where("tenant_id = 'hot'")
    assert hot.select(F.input_file_name()).distinct().count() >= 4
    assert hot.count() == 6000


def test_retention_drops_whole_days(stored):
    newest = stored.select(F.max("timestamp")).first()[0]
    kept = retain(stored, newest + 80 * DAY)
    gone = expired_partitions(stored, newest + 80 * DAY)
    assert kept.count() + gone.agg(F.sum("rows")).first()[0] == stored.count()
    assert "event_date" in kept._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:300]


def test_dead_letters_round_trip(spark):
    events = validate(dirty(load_events(spark, SF)))
    dlq = to_dead_letters(events, "error", 5)
    assert dlq.columns == ["original_event", "error", "failed_at", "attempts"]
    assert {r["attempts"] for r in dlq.collect()} == {3}
    assert from_dead_letters(dlq).count() == events.where("error IS NOT NULL").count() > 0


def test_replay_is_quiet_and_merges_without_copies(spark):
    events = load_events(spark, SF)
    start = events.select(F.expr("percentile(timestamp, 0.5)").cast("bigint")).first()[0]
    again = replay(events, start)
    assert again.where("notify").count() == 0
    merged = analytics.merge_replayed(events, again.drop("notify"))
    assert merged.count() == events.count()


def test_view_increments_compact_to_the_same_view(spark, tmp_path):
    events = load_events(spark, SF)
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    for i in range(3):
        views.append_partials(views.minute_partials(events.where(F.pmod("seq", F.lit(3)) == i)), source)
    views.compact_months(spark, source, target, views.compact_minute_partials)
    read = lambda p: sorted(views.merge_minute_partials(spark.read.parquet(p)).collect())
    assert read(source) == read(target) == sorted(views.events_per_minute(events).collect())
    assert spark.read.parquet(target).count() <= spark.read.parquet(source).count()


def test_revenue_increments(spark, tmp_path):
    events = load_events(spark, SF)
    source, target = str(tmp_path / "r"), str(tmp_path / "s")
    for i in range(2):
        views.append_partials(views.revenue_per_hour(events.where(F.pmod("seq", F.lit(2)) == i)), source, "hour")
    views.compact_months(spark, source, target, views.merge_revenue, ["202401"])
    total = lambda df: round(df.agg(F.sum("revenue")).first()[0], 4)
    assert total(spark.read.parquet(target)) == total(views.revenue_per_hour(events))


def test_table_health_bytes(spark):
    row = table_health({"events": spark.read.parquet(f"{SF}/events.parquet")}, with_bytes=True).first()
    assert row["total_rows"] == 1000 and row["total_bytes"] > 1000


def test_hot_falls_back_to_cold(spark):
    hot = spark.createDataFrame([(100, "h")], "window_start bigint, src string")
    cold = spark.createDataFrame([(100, "c"), (1, "c")], "window_start bigint, src string")
    both = analytics.hot_and_cold(hot, cold, 120, 50)
    assert sorted((r[0], r[1]) for r in both.collect()) == [(1, "c"), (100, "h")]
    assert analytics.hot_and_cold(hot, cold, 120, 50, hot_available=False).count() == 2


def test_shared_folder_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get(CHECKPOINT_KEY))
    df = spark.range(10)
    assert cut_lineage(spark, df).count() == 10


def test_tenant_is_required(spark):
    with pytest.raises(ValueError):
        analytics.event_count(load_events(spark, SF), "", "", 0, 1)


def test_rate_of_an_empty_range_is_zero(spark):
    row = analytics.event_count(load_events(spark, SF), "tenant-acme", "click", 10, 10).first()
    assert row["rate_per_second"] == 0.0


@pytest.mark.parametrize("minutes, used", [(5, 5), (0, 5), (-1, 5), (1440, 5), (60, 60)])
def test_minutes_are_clamped(spark, minutes, used):
    row = analytics.revenue_last(load_events(spark, SF), "tenant-acme", minutes, 10).first()
    assert row["window_minutes"] == used and row["revenue"] >= 0.0


def test_missing_days_by_brute_force(spark):
    rng = random.Random(2)
    rows = [(f"t{rng.randrange(3)}", rng.randrange(20) * DAY + rng.randrange(DAY)) for _ in range(30)]
    got = {(r[0], r[1]) for r in analytics.missing_days(spark.createDataFrame(rows, "tenant_id string, timestamp bigint")).collect()}
    days = {(t, ts - ts % DAY) for t, ts in rows}
    lo, hi = min(d for _, d in days), max(d for _, d in days)
    assert got == {(t, d) for t in {t for t, _ in days} for d in range(lo, hi + 1, DAY)} - days


def test_sizing_follows_the_input():
    small, large = sizing(10**6), sizing(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "100000"
