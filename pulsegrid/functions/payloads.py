"""Typed access to the schemaless payload, on VARIANT so that JSON types stay visible."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timing import col

_NUMERIC = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def is_valid_json(payload: str | Column) -> Column:
    """A missing payload is valid; text must parse."""
    return col(payload).isNull() | F.try_parse_json(col(payload)).isNotNull()


def _field(payload: str | Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(col(payload)), path, "variant")


def _is_number(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).rlike(_NUMERIC), F.lit(False))


def payload_value(payload: str | Column) -> Column:
    """`payload.value` when it is a JSON number, 1.0 for anything else."""
    v = _field(payload, "$.value")
    return F.when(_is_number(v), F.try_variant_get(v, "$", "double")).otherwise(F.lit(1.0))


def payload_amount(payload: str | Column) -> Column:
    """`payload.amount`: a JSON number or a numeric string, else 0.0."""
    v = _field(payload, "$.amount")
    text = F.when(
        F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string").try_cast("double")
    )
    number = F.when(_is_number(v), F.try_variant_get(v, "$", "double"))
    return F.coalesce(number, text, F.lit(0.0))


def with_measures(df, payload: str = "payload"):
    """Parse the payload once, on write; windows and revenue then read two plain doubles."""
    return df.withColumn("value", payload_value(payload)).withColumn(
        "amount",
        F.when(F.col("event_type") == "purchase", payload_amount(payload)).otherwise(F.lit(0.0)),
    )
