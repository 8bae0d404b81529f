"""Lenient request parameters: as columns (a request table) and as plain values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timing import HOUR, col


def int_or(value: str | Column, fallback: int | Column) -> Column:
    """Whole decimal integer or the fallback; spaces and fractions count as malformed."""
    c = col(value)
    fb = fallback if isinstance(fallback, Column) else F.lit(fallback).cast("bigint")
    return F.coalesce(F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint")), fb)


def clamp_minutes(minutes: str | Column) -> Column:
    """1..1439 pass, everything else becomes 5."""
    m = col(minutes)
    return F.when((m <= 0) | (m >= 1440), F.lit(5).cast("bigint")).otherwise(m)


def clamp_minutes_value(minutes: int) -> int:
    return minutes if 0 < minutes < 1440 else 5


def window_or_default(window: str | Column) -> Column:
    return F.coalesce(F.nullif(col(window), F.lit("")), F.lit("tumbling_1m"))


def with_request_defaults(df, now_ms: int | Column):
    """Fill a request table (`minutes`, `from`, `to`, `window` as text) the way the API does."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
    return df.select(
        "*",
        clamp_minutes(int_or("minutes", 5)).alias("minutes_used"),
        int_or("from", now - F.lit(HOUR)).alias("from_used"),
        int_or("to", now).alias("to_used"),
        window_or_default("window").alias("window_used"),
    )
