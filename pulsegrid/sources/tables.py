"""The stored side: raw event table, retention, dead letters, replay, table health."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timing import DAY, between_ms, event_date, with_calendar
from ..schemas import EVENT_COLUMNS
from .files import Folder

RETENTION_DAYS = 90
LOG_RETENTION_DAYS = 7
MAX_ATTEMPTS = 3


def write_raw_events(
    events: DataFrame, path: str, mode: str = "append", partitions: int | None = None
) -> None:
    """Partition by tenant and day, sort by tenant, type, time.

    Range partitioning on the sort key cuts a tenant that holds a third of all rows into as many
    tasks as its volume needs, where hashing on (tenant, day) would put a day of it into one.
    """
    key = ["tenant_id", "event_date", "event_type", "timestamp"]
    table = with_calendar(events)
    ranged = (
        table.repartitionByRange(partitions, *key) if partitions else table.repartitionByRange(*key)
    )
    (
        ranged.sortWithinPartitions(*key)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("tenant_id", "event_date")
        .parquet(path)
    )


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """A raw table; files that a retention run removes meanwhile are no error."""
    return spark.read.option("ignoreMissingFiles", "true").parquet(path)


def retain(df: DataFrame, as_of_ms: int | Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows whose day plus `days` has not passed; on a partitioned table this prunes partitions."""
    as_of = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    day = F.col("event_date") if "event_date" in df.columns else event_date("timestamp")
    return df.where(day >= F.date_sub(event_date(as_of), days))


def expired_partitions(df: DataFrame, as_of_ms: int | Column, days: int = RETENTION_DAYS) -> DataFrame:
    """The (tenant, day) partitions that a retention run drops."""
    as_of = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    gone = df.where(F.col("event_date") < F.date_sub(event_date(as_of), days))
    return gone.groupBy("tenant_id", "event_date").agg(F.count("*").alias("rows"))


def drop_expired(spark: SparkSession, path: str, as_of_ms: int, days: int = RETENTION_DAYS, dry_run: bool = False) -> list[str]:
    """Removes the day folders of a raw table (tenant_id=.../event_date=...) whose day plus `days` has passed; returns their names.

    Whole partitions go, nothing is read or rewritten, and a second run finds nothing left. A tenant without any day left
    goes too. `dry_run` only names them. Readers that hold an older listing are served by `read_raw_events`, which does
    not mind missing files.
    """
    table = Folder(spark, path)
    oldest = (datetime.fromtimestamp(as_of_ms / 1000, UTC) - timedelta(days=days)).date()
    gone = []
    for tenant in table.folders():
        if not tenant.startswith("tenant_id="):
            continue
        days_of = [d for d in table.folders(tenant) if d.startswith("event_date=")]
        old = [d for d in days_of if _day(d) is not None and _day(d) < oldest]
        gone += [f"{tenant}/{d}" for d in old]
        if not dry_run:
            for d in old:
                table.remove(f"{tenant}/{d}")
            if days_of and not table.folders(tenant):
                table.remove(tenant)
    return gone


def _day(folder: str) -> date | None:
    try:
        return date.fromisoformat(folder.removeprefix("event_date="))
    except ValueError:  # the folder of null days
        return None


def to_dead_letters(
    failed: DataFrame, error: str, failed_at: int | str | Column, attempts: int | Column = MAX_ATTEMPTS
) -> DataFrame:
    """Envelope of an event that failed its last attempt.

    Rows of a message that could not be decoded keep its text in `raw` and fail with `decode_error`.
    """
    if isinstance(failed_at, int):
        when = F.lit(failed_at).cast("bigint")
    else:
        when = F.col(failed_at) if isinstance(failed_at, str) else failed_at
    text = [F.col("raw")] if "raw" in failed.columns else []
    reason = F.coalesce("decode_error", error) if "decode_error" in failed.columns else F.col(error)
    return failed.where(reason.isNotNull()).select(
        F.struct(*[F.col(c) for c in EVENT_COLUMNS]).alias("original_event"),
        *text,
        reason.alias("error"),
        when.alias("failed_at"),
        (attempts if isinstance(attempts, Column) else F.lit(attempts)).alias("attempts"),
    )


def from_dead_letters(dlq: DataFrame) -> DataFrame:
    """The original events, ready to be ingested again once the cause is fixed."""
    return dlq.select("original_event.*")


def replay(
    events: DataFrame, start_ms: int | Column, end_ms: int | Column | None = None, notify: bool = False
) -> DataFrame:
    """Events from a point in time on, for a run apart from live work.

    `notify` travels with the rows; alert code leaves rows with false out of notifications.
    """
    if end_ms is None:
        out = events.where(F.col("timestamp") >= start_ms)
        if "event_date" in events.columns:
            lo = F.lit(start_ms) if isinstance(start_ms, int) else start_ms
            out = out.where(F.col("event_date") >= event_date(lo))
    else:
        out = between_ms(events, start_ms, end_ms)
    return out.withColumn("notify", F.lit(notify))


def table_health(tables: dict[str, DataFrame], with_bytes: bool = False) -> DataFrame:
    """Rows (and bytes of the files behind them) per table."""
    parts = []
    for name, df in tables.items():
        if with_bytes:
            files = df.select(
                F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")
            )
            per_file = files.groupBy("f").agg(F.count("*").alias("n"), F.max("b").alias("b"))
            part = per_file.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
                F.coalesce(F.sum("b"), F.lit(0)).alias("total_bytes"),
            )
        else:
            part = df.agg(F.count("*").alias("total_rows"))
        parts.append(part.select(F.lit(name).alias("table"), "*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def log_cutoff(as_of_ms: int | Column, days: int = LOG_RETENTION_DAYS) -> Column:
    as_of = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    return as_of - F.lit(days * DAY)
