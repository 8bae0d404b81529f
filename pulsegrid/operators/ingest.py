"""Validation, completion and outcome of incoming events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payloads import is_valid_json
from ..functions.timing import MINUTE, col
from ..sources.decode import BAD_BATCH, MAX_BATCH
from .dedup import DEDUP_TTL, mark_duplicates

# Outcome and error texts.
TENANT_REQUIRED = "tenant_id is required"
INVALID_EVENT = "invalid event"
ACCEPTED = "accepted"
DUPLICATE = "duplicate"

LATE_AFTER = 5 * MINUTE


def _present(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit("")) != ""


def resolve_tenant(header: str | Column, body: str | Column) -> Column:
    """The request header wins over the body when it is not empty."""
    return F.coalesce(F.nullif(col(header), F.lit("")), col(body))


def apply_defaults(df: DataFrame, now_ms: int | Column, id_expr: Column | None = None) -> DataFrame:
    """Fill a missing id, time and version.

    `uuid()` differs on every evaluation, so write the result before using it twice, or pass an
    `id_expr` that derives the id from the row.
    """
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
    new_id = F.expr("uuid()") if id_expr is None else id_expr
    return (
        df.withColumn("id", F.when(_present("id"), F.col("id")).otherwise(new_id))
        .withColumn("timestamp", F.coalesce(F.nullif(F.col("timestamp"), F.lit(0)), now))
        .withColumn("version", F.coalesce(F.nullif(F.col("version"), F.lit(0)), F.lit(1)))
    )


def validation_error() -> Column:
    """First failing rule of an event, or null."""
    return (
        F.when(~_present("tenant_id"), F.lit(TENANT_REQUIRED))
        .when(~_present("event_type"), F.lit(INVALID_EVENT))
        .when(~is_valid_json("payload"), F.lit(INVALID_EVENT))
    )


def validate(df: DataFrame) -> DataFrame:
    return df.withColumn("error", validation_error())


def ingest_status(
    df: DataFrame, key: str = "id", arrival: str = "timestamp", seq: str = "seq", ttl_ms: int = DEDUP_TTL
) -> DataFrame:
    """`accepted`, `duplicate` or the error text of every event.

    Validation comes first: an invalid event neither counts as seen nor as a duplicate.
    """
    marked = mark_duplicates(validate(df), [key], arrival, seq, ttl_ms, eligible=F.col("error").isNull())
    status = F.when(F.col("error").isNotNull(), F.col("error")).when(
        F.col("is_duplicate"), F.lit(DUPLICATE)
    )
    return marked.withColumn("status", F.coalesce(status, F.lit(ACCEPTED)))


def batch_summary(statuses: DataFrame, batch_id: str = "batch_id", pos: str = "pos") -> DataFrame:
    """Accepted and rejected counts and the error texts, in arrival order, of each batch.

    Duplicates count as rejected without a text. A batch over the size limit is refused as a
    whole; only errors at positions inside the limit are collected, so no batch can grow a list.
    """
    is_error = ~F.col("status").isin(ACCEPTED, DUPLICATE)
    inside = F.col(pos) < MAX_BATCH
    agg = statuses.groupBy(batch_id).agg(
        F.count("*").alias("_n"),
        F.count_if(F.col("status") == ACCEPTED).alias("_ok"),
        F.collect_list(F.when(is_error & inside, F.struct(F.col(pos), F.col("status")))).alias("_err"),
    )
    too_big = F.col("_n") > MAX_BATCH
    texts = F.transform(F.array_sort("_err"), lambda e: e.status)
    accepted = F.when(too_big, F.lit(0)).otherwise(F.col("_ok")).cast("bigint")
    return agg.select(
        batch_id,
        accepted.alias("accepted"),
        (F.col("_n") - accepted).alias("rejected"),
        F.when(too_big, F.array(F.lit(BAD_BATCH))).otherwise(texts).alias("errors"),
        F.when(accepted == 0, F.lit("bad_request")).otherwise(F.lit("accepted")).alias("batch_status"),
    )


def flag_late(df: DataFrame, received_at: str = "received_at", after_ms: int = LATE_AFTER) -> DataFrame:
    """Mark events that arrived more than `after_ms` after they happened, also as a label."""
    late = (F.col(received_at) - F.col("timestamp")) > after_ms
    labels = F.coalesce(F.col("labels"), F.create_map().cast("map<string,string>"))
    others = F.map_filter(labels, lambda k, _: k != "late_arrival")
    return df.withColumn("is_late", late).withColumn(
        "labels",
        F.when(
            late, F.map_concat(others, F.create_map(F.lit("late_arrival"), F.lit("true")))
        ).otherwise(labels),
    )


def for_windows(flagged: DataFrame, late_policy: str = "include") -> DataFrame:
    """Events that windows count: all of them, or with `exclude` those not flagged late (unknown arrival: not late).

    Either way late events stay in storage.
    """
    if late_policy not in ("include", "exclude"):
        raise ValueError("late_policy is include or exclude")
    return flagged if late_policy == "include" else flagged.where("NOT coalesce(is_late, false)")


def accept(df: DataFrame, now_ms: int | Column, id_expr: Column | None = None, **dedup) -> DataFrame:
    """Whole ingest path for decoded events: complete, validate, drop duplicates."""
    return ingest_status(apply_defaults(df, now_ms, id_expr), **dedup)
