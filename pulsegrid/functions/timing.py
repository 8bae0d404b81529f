"""Event-time helpers. Times travel as BIGINT Unix millis; TIMESTAMP only where Spark needs it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

# The window names and lengths of the data model.
TUMBLING = {"tumbling_1m": MINUTE, "tumbling_5m": 5 * MINUTE, "tumbling_1h": HOUR}
RULE_WINDOWS = {"1m": "tumbling_1m", "5m": "tumbling_5m", "1h": "tumbling_1h"}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_ms(ts: str | Column, step_ms: int) -> Column:
    """Start of the epoch-aligned window of `step_ms` that holds `ts` (right for negatives too)."""
    return col(ts) - F.pmod(col(ts), F.lit(step_ms).cast("bigint"))


def to_ts(ms: str | Column) -> Column:
    return F.timestamp_millis(col(ms))


def to_ms(ts: str | Column) -> Column:
    """Unix millis, floored; a TIMESTAMP_NTZ is read as UTC through the session zone."""
    return F.unix_millis(col(ts).cast("timestamp"))


def event_date(ms: str | Column) -> Column:
    return F.to_date(to_ts(ms))


def event_hour(ms: str | Column) -> Column:
    return F.date_trunc("HOUR", to_ts(ms))


def with_calendar(df, ts: str = "timestamp"):
    """Columns derived on write for partitioning and filtering."""
    return df.withColumn("event_date", event_date(ts)).withColumn("event_hour", event_hour(ts))


def between_ms(df, start: int | Column, end: int | Column, ts: str = "timestamp"):
    """Rows with start <= ts <= end.

    Catalyst cannot derive `event_date` from `timestamp`, so when the table carries that
    partition column the matching date bounds are added and whole partitions are skipped.
    """
    lo = F.lit(start) if isinstance(start, int) else start
    hi = F.lit(end) if isinstance(end, int) else end
    out = df.where(F.col(ts).between(lo, hi))
    if "event_date" in df.columns:
        out = out.where(F.col("event_date").between(event_date(lo), event_date(hi)))
    return out
