"""Duplicate rejection within a time to live, exact and without single-task groups.

An arrival is accepted when its key was not accepted within the last `ttl_ms`; a rejected copy
does not extend the period. The rule is greedy, so it is a chain of accepted times per key.

* Keys seen once never enter the chain work: only (key, time, sequence) of repeated keys does. The
  outcome comes back as a join on (key, time) with one row per moment of a repeated key; while
  those are few Spark broadcasts them at run time and full rows are not shuffled at all.
* Copies with the same key and millisecond collapse during the map side of an aggregation.
* A key whose copies all lie within one period accepts just its first arrival: an aggregation.
* All other repeated keys go through `chains.mark_chain`: blocks of time are worked on apart, whatever a key's share
  of the rows, and joined by the few steps that a block's effect on the chain has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timing import DAY
from .chains import mark_chain

DEDUP_TTL = DAY


def verdicts(df: DataFrame, keys: list[str], ts: str, seq: str, ttl_ms: int = DEDUP_TTL) -> DataFrame:
    """One row per (keys, ts) of repeated keys: `_first`, the first sequence there, and `_taken`.

    The row (keys, ts, _first) is accepted if `_taken`; all others with these (keys, ts) are not.
    """
    narrow = df.select(*keys, ts, seq)
    repeated = (
        narrow.groupBy(*keys)
        .agg(F.count("*").alias("_n"), F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
        .where("_n > 1")
    )
    # The filter keeps `_first` in all uses below, so that they share an exchange.
    moments = (
        narrow.join(repeated, keys)
        .groupBy(*keys, ts)
        .agg(F.min(seq).alias("_first"), *[F.min(c).alias(c) for c in ("_n", "_lo", "_hi")])
        .where("_first IS NOT NULL")
    )
    brief = moments.where(f"_hi - _lo < {ttl_ms}").selectExpr(*keys, ts, "_first", f"{ts} = _lo AS _taken")
    spread = moments.where(f"_hi - _lo >= {ttl_ms}")
    return brief.unionByName(mark_chain(spread, keys, ts, ttl_ms).select(*keys, ts, "_first", "_taken"))


def mark_duplicates(
    df: DataFrame, keys: list[str], ts: str = "timestamp", seq: str = "seq", ttl_ms: int = DEDUP_TTL,
    eligible: Column | None = None,
) -> DataFrame:
    """All rows with `is_duplicate`; `seq` orders arrivals of the same millisecond and is unique.

    Rows that are not `eligible` neither are duplicates nor make others so.
    """
    counted = df if eligible is None else df.where(eligible)
    known = verdicts(counted, keys, ts, seq, ttl_ms)
    duplicate = F.coalesce(~F.col("_taken") | (F.col(seq) != F.col("_first")), F.lit(False))
    if eligible is not None:
        duplicate = duplicate & eligible
    return (
        df.join(known, [*keys, ts], "left").withColumn("is_duplicate", duplicate).drop("_first", "_taken")
    )


def drop_duplicates(
    df: DataFrame, keys: list[str], ts: str = "timestamp", seq: str = "seq", ttl_ms: int = DEDUP_TTL
) -> DataFrame:
    return mark_duplicates(df, keys, ts, seq, ttl_ms).where("NOT is_duplicate").drop("is_duplicate")


def drop_seen(
    increment: DataFrame, seen: DataFrame, keys: list[str], ts: str = "timestamp", ttl_ms: int = DEDUP_TTL
) -> DataFrame:
    """Increment rows whose key has no accepted row less than the period before or after them.

    `seen` holds accepted rows from before the increment, in any order. Times are cut into slots of one
    period; an accepted row can only block rows of its own and the neighbouring slots, so the join is on
    equal keys and slots. Rows older than all accepted ones pass.
    """
    slot = F.expr(f"({ts} - pmod({ts}, {ttl_ms}L)) div {ttl_ms}L")
    known = seen.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(ts).alias("_seen"), slot.alias("_s"))
    known = known.distinct().withColumn("_slot", F.explode(F.expr("sequence(_s - 1, _s + 1)"))).drop("_s")
    cond = (slot == known["_slot"]) & (F.abs(increment[ts] - known["_seen"]) < ttl_ms)
    for i, k in enumerate(keys):
        cond = cond & (increment[k] == known[f"_k{i}"])
    return increment.join(known, cond, "left_anti")


def dedup_increment(
    increment: DataFrame, seen: DataFrame, keys: list[str], ts: str = "timestamp", seq: str = "seq",
    ttl_ms: int = DEDUP_TTL,
) -> DataFrame:
    """Accepted rows of an increment, given the accepted rows before it."""
    return drop_duplicates(drop_seen(increment, seen, keys, ts, ttl_ms), keys, ts, seq, ttl_ms)
