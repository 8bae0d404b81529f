"""Message texts and small label mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timing import col

# Fixed value: the text given when no summary model is configured.
NO_MODEL_TEXT = "AI analysis unavailable: no API key configured"


def fixed(x: str | Column, digits: int) -> Column:
    """Fixed-point text of a double, rounded half-even on its binary value (as printf does)."""
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.call_function("format_number", col(x).cast("double"), F.lit(pattern))


def severity_color(severity: str | Column) -> Column:
    s = col(severity)
    return (
        F.when(s == "critical", F.lit("danger"))
        .when(s == "warning", F.lit("warning"))
        .otherwise(F.lit("good"))
    )


def severity_rank(severity: str | Column) -> Column:
    s = col(severity)
    return (
        F.when(s == "critical", F.lit(3))
        .when(s == "warning", F.lit(2))
        .when(s == "info", F.lit(1))
        .otherwise(F.lit(0))
    )


def alert_message(severity, name, metric, operator, threshold, current) -> Column:
    return F.concat(
        F.lit("["), col(severity), F.lit("] "), col(name), F.lit(": "), col(metric), F.lit(" "),
        col(operator), F.lit(" "), fixed(threshold, 2),
        F.lit(" (current: "), fixed(current, 2), F.lit(")"),
    )


def anomaly_message(event_type, z) -> Column:
    return F.concat(F.lit("Anomaly: "), col(event_type), F.lit(" z="), fixed(z, 2))


def anomaly_prompt(tenant, event_type, z, current, average) -> Column:
    return F.concat(
        F.lit("Tenant: "), col(tenant), F.lit(", Event: "), col(event_type),
        F.lit(", Z-score: "), fixed(z, 2), F.lit(", Current: "), fixed(current, 0),
        F.lit(", Avg: "), fixed(average, 0), F.lit(". Explain in 2 sentences."),
    )


def ratio_summary(event_type, current, average) -> Column:
    """A rule-made one-liner that needs no model."""
    ratio = F.when(col(average) > 0, col(current) / col(average))
    return F.coalesce(
        F.concat(fixed(ratio, 1), F.lit("x the usual rate of "), col(event_type), F.lit(" events")),
        F.concat(F.lit("first "), col(event_type), F.lit(" events after a silent period")),
    )
