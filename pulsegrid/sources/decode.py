"""Raw messages to event rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT_JSON, EVENT_TEXTS, EVENT_TYPED

MAX_BATCH = 1000
BAD_JSON = "invalid JSON"
BAD_BATCH = "events must be 1-1000"
_CORRUPT = "_corrupt"


def _parse(value: str, schema: T.StructType) -> Column:
    with_corrupt = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(
        F.col(value).cast("string"),
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )


# Texts that may hold a wrong type: a text field or a label that is neither text nor missing, an escaped name,
# a number with an exponent or of more than 308 digits. All others are left out of the closer look, which uses no
# higher-order function: one would end code generation for the whole projection, also where it is not evaluated.
_SUSPECT = (
    r'"(?:id|tenant_id|user_id|event_type|source)"\s*:\s*[^"\s]'
    r'|"labels"\s*:\s*\{(?:\s*"(?:[^"\\]|\\.)*+"\s*[:,])*+\s*[^"\s}]'
    r"|\\u|[0-9][eE]\+?[0-9]|[0-9]{309}"
)


def _payload_is_object(payload: Column) -> Column:
    return F.coalesce(F.schema_of_variant(payload).startswith("OBJECT") | F.is_variant_null(payload), F.lit(True))


def _is_text(v: Column) -> Column:
    return v.isNull() | F.schema_of_variant(v).isin("STRING", "VOID")


def _typed(event: Column) -> Column:
    """Whether text fields and labels hold texts or nulls."""
    values = F.schema_of_variant(F.to_variant_object(F.map_values(event.labels)))
    labels = F.coalesce(values.isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit(True))
    return reduce(and_, [_is_text(event[c]) for c in EVENT_TEXTS], labels)


def _overflows(text: Column) -> Column:
    """Whether a number outside of strings is too large for a double."""
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', "")
    numbers = F.regexp_extract_all(bare, F.lit(r"[0-9]++(?:[.][0-9]++)?(?:[eE][+-]?[0-9]++)?"), F.lit(0))
    return F.array_contains(numbers.try_cast("array<double>"), float("inf"))


def _wrong_types(value: str, typed: Column) -> Column:
    """Whether a message holds a wrong type or a number out of range; `typed` is worked out for suspect texts only."""
    text = F.col(value).cast("string")
    return F.when(text.rlike(_SUSPECT), ~F.coalesce(typed, F.lit(True)) | _overflows(text)).otherwise(F.lit(False))


def _event_columns(e: str) -> list[Column]:
    payload = F.col(f"{e}.payload")
    return [
        F.col(f"{e}.id").alias("id"),
        F.col(f"{e}.tenant_id").alias("tenant_id"),
        F.col(f"{e}.user_id").alias("user_id"),
        F.col(f"{e}.event_type").alias("event_type"),
        F.col(f"{e}.source").alias("source"),
        F.col(f"{e}.timestamp").alias("timestamp"),
        F.lit(0).alias("version"),  # producers cannot set it
        F.when(~F.is_variant_null(payload), F.to_json(payload)).alias("payload"),
        F.col(f"{e}.labels").alias("labels"),
    ]


def decode_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """One JSON event per message; undecodable ones keep their text and get `decode_error`.

    Types are strict: a number in a text field or label, a payload that is no object and a number that no
    double holds make a message undecodable. Nothing is turned into text.
    """
    keep = [c for c in messages.columns if c != value]
    parsed = messages.withColumn("_e", _parse(value, EVENT_JSON))
    bad = (
        F.col("_e").isNull()
        | F.col(f"_e.{_CORRUPT}").isNotNull()
        | ~_payload_is_object(F.col("_e.payload"))
        | _wrong_types(value, _typed(F.from_json(F.col(value).cast("string"), EVENT_TYPED)))
    )
    return parsed.withColumn("_bad", bad).select(
        *keep,
        *_event_columns("_e"),
        F.when(F.col("_bad"), F.lit(BAD_JSON)).alias("decode_error"),
        F.when(F.col("_bad"), F.col(value).cast("string")).alias("raw"),
    )


def decode_batches(messages: DataFrame, batch_id: str, value: str = "value") -> DataFrame:
    """`{"events": [...]}` envelopes to events with their position.

    An undecodable envelope, or one that does not hold 1..1000 events, yields a single row with
    `decode_error` and a null position: the whole batch is refused.
    """
    keep = [c for c in messages.columns if c != value]
    envelope = T.StructType([T.StructField("events", T.ArrayType(EVENT_JSON))])
    typed = T.StructType([T.StructField("events", T.ArrayType(EVENT_TYPED))])
    parsed = messages.withColumn("_b", _parse(value, envelope))
    events = F.col("_b.events")
    size = F.coalesce(F.size(events), F.lit(0))
    broken = (
        F.col("_b").isNull()
        | F.col(f"_b.{_CORRUPT}").isNotNull()
        | F.coalesce(F.exists(events, lambda e: ~_payload_is_object(e.payload)), F.lit(False))
        | _wrong_types(value, F.forall(F.from_json(F.col(value).cast("string"), typed).events, _typed))
    )
    error = F.when(broken, F.lit(BAD_JSON)).when(~size.between(1, MAX_BATCH), F.lit(BAD_BATCH))
    checked = parsed.withColumn("decode_error", error)
    opened = checked.select(
        *keep,
        "decode_error",
        F.posexplode_outer(F.when(F.col("decode_error").isNull(), events)).alias("pos", "_e"),
    )
    return opened.select(*keep, "pos", *_event_columns("_e"), "decode_error")


def encode_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Event rows to JSON messages keyed by tenant; null fields are left out."""
    fields = ["id", "tenant_id", "user_id", "event_type", "source", "timestamp", "labels"]
    body = F.struct(*fields, F.try_parse_json("payload").alias("payload"))
    return events.select(*(keep or []), F.col("tenant_id").alias("key"), F.to_json(body).alias("value"))


def decode_protobuf_events(
    messages: DataFrame, descriptor_path: str, message: str = "events.v1.Event", value: str = "value"
) -> DataFrame:
    """Events in the binary envelope; the payload field holds JSON bytes.

    Needs the protobuf package of Spark on the class path and a descriptor file that executors
    can read. A message that does not parse becomes an undecodable event.
    """
    from pyspark.sql.protobuf.functions import from_protobuf

    parsed = messages.withColumn("_p", from_protobuf(value, message, descriptor_path, {"mode": "PERMISSIVE"}))
    names = ["id", "tenant_id", "user_id", "event_type", "source", "timestamp", "version"]
    bad = F.col("_p").isNull()
    return parsed.select(
        *[c for c in messages.columns if c != value],
        *[F.col(f"_p.{n}").alias(n) for n in names],
        F.nullif(F.col("_p.payload").cast("string"), F.lit("")).alias("payload"),
        F.col("_p.labels").alias("labels"),
        F.when(bad, F.lit(BAD_JSON)).alias("decode_error"),
    )
