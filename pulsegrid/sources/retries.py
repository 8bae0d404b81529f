"""Attempts at events that fail: counted per event, and given up after the last one.

The attempt log is a table partitioned by run. A run takes the new events and those that the run before left open, tries
them all, and writes each with its outcome and its number of attempts: stored, open (to be tried again) or dead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import DEDUP_TTL, dedup_increment
from .files import Folder
from .tables import MAX_ATTEMPTS, to_dead_letters

STORED, OPEN, DEAD = "stored", "open", "dead"


def attempted(events: DataFrame, before: DataFrame | None, attempt: Callable[[DataFrame], DataFrame], most: int = MAX_ATTEMPTS) -> DataFrame:
    """One run over new `events` and the open ones of the run `before`, with `attempts`, `error` and `outcome`.

    `attempt` adds `error` (null: it went well). The event id is the key: a new copy of an open event is that event,
    and of several new copies one is tried.
    """
    rows = events.withColumn("attempts", F.lit(0))
    if before is not None:
        rows = rows.unionByName(before.where(F.col("outcome") == OPEN).select(*events.columns, "attempts"))
    latest = rows.groupBy("id").agg(F.max_by(F.struct(*rows.columns), F.struct("attempts", "timestamp")).alias("r")).select("r.*")
    done = attempt(latest).withColumn("attempts", F.col("attempts") + 1)
    failed = F.when(F.col("attempts") >= most, DEAD).otherwise(OPEN)
    return done.withColumn("outcome", F.when(F.col("error").isNull(), STORED).otherwise(failed))


def run_attempts(spark: SparkSession, events: DataFrame, path: str, run: int, attempt: Callable[[DataFrame], DataFrame], most: int = MAX_ATTEMPTS) -> DataFrame:
    """Run number `run` against the log at `path`; running it again replaces it and changes nothing else."""
    earlier = [int(f.removeprefix("run=")) for f in Folder(spark, path).folders() if f.startswith("run=")]
    last = max((r for r in earlier if r < run), default=None)
    before = spark.read.parquet(f"{path}/run={last}") if last is not None else None
    attempted(events, before, attempt, most).write.mode("overwrite").parquet(f"{path}/run={run}")
    return spark.read.parquet(f"{path}/run={run}")


def dead_letters(log: DataFrame, failed_at: int | str) -> DataFrame:
    """The events of a log that were given up, with the attempts they had."""
    return to_dead_letters(log.where(F.col("outcome") == DEAD), "error", failed_at, attempts=F.col("attempts"))


def reprocessed(dlq: DataFrame, attempt: Callable[[DataFrame], DataFrame], stored: DataFrame, ttl_ms: int = DEDUP_TTL) -> tuple[DataFrame, DataFrame]:
    """Dead letters tried again once the cause is mended: (events to store, letters that stay dead).

    Events that are stored already, by id and within the time to live, are not stored again, nor is a second letter of one event.
    """
    tried = attempt(dlq.select("original_event.*", F.col("attempts").alias("_attempts"), "failed_at")).withColumn("_attempts", F.col("_attempts") + 1)
    good = tried.where("error IS NULL").drop("error", "_attempts", "failed_at").dropDuplicates(["id", "timestamp"])
    fresh = dedup_increment(good, stored.select("id", "timestamp"), ["id"], seq="timestamp", ttl_ms=ttl_ms)
    return fresh, to_dead_letters(tried, "error", "failed_at", attempts=F.col("_attempts"))
