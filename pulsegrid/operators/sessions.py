"""Grouping by gaps in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timing import MINUTE, floor_ms

SESSION_GAP = 30 * MINUTE


def number_by_gap(df: DataFrame, keys: list[str], start: str, end: str, gap_ms: int, inclusive: bool) -> DataFrame:
    """Add `_group`: it grows when the pause since the latest `end` so far reaches the gap."""
    order = W.partitionBy(*keys).orderBy(start)
    so_far = F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1))
    pause = F.col(start) - so_far
    cut = (pause >= gap_ms) if inclusive else (pause > gap_ms)
    return df.withColumn("_cut", F.when(cut, F.lit(1)).otherwise(F.lit(0))).withColumn(
        "_group", F.sum("_cut").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    ).drop("_cut")


def session_windows(
    events: DataFrame, keys: list[str] = ["tenant_id", "user_id"], gap_ms: int = SESSION_GAP,
    ts: str = "timestamp",
) -> DataFrame:
    """Sessions per key: a pause of `gap_ms` or more ends one; it ends `gap_ms` after its last event.

    Two events in the same gap-long slice of time always share a session, so events are first
    reduced to one row per key and slice, on the map side. Sessions are formed over slices,
    whose number per key is bounded by the time span.
    """
    slices = events.groupBy(*keys, floor_ms(ts, gap_ms).alias("_slice")).agg(
        F.count("*").alias("_n"), F.min(ts).alias("_a"), F.max(ts).alias("_b")
    )
    return (
        number_by_gap(slices, keys, "_a", "_b", gap_ms, inclusive=True)
        .groupBy(*keys, "_group")
        .agg(
            F.min("_a").alias("session_start"),
            (F.max("_b") + F.lit(gap_ms)).alias("session_end"),
            F.sum("_n").alias("count"),
        )
        .drop("_group")
    )
