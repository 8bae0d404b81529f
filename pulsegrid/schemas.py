"""Record layouts shared by batch and streaming code."""

from pyspark.sql import types as T

# One event as producers send it. The payload stays a VARIANT while decoding, so that number and
# string values remain distinguishable, and is stored as JSON text.
EVENT_JSON = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    ]
)

# The text fields of it; `EVENT_TYPED` leaves their JSON types visible.
EVENT_TEXTS = ["id", "tenant_id", "user_id", "event_type", "source"]
EVENT_TYPED = T.StructType(
    [
        *[T.StructField(name, T.VariantType()) for name in EVENT_TEXTS],
        T.StructField("labels", T.MapType(T.StringType(), T.VariantType())),
    ]
)

# A stored event.
EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("payload", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    ]
)

EVENT_COLUMNS = EVENT.fieldNames()

WINDOW_METRICS = T.StructType(
    [
        T.StructField("tenant_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("window_type", T.StringType()),
        T.StructField("window_start", T.LongType()),
        T.StructField("window_end", T.LongType()),
        T.StructField("count", T.LongType()),
        T.StructField("sum", T.DoubleType()),
        T.StructField("avg", T.DoubleType()),
        T.StructField("p99", T.DoubleType()),
    ]
)

ALERT_RULE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("operator", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("window", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("slack_url", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("created_at", T.LongType()),
    ]
)

FIRED_ALERT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("rule_id", T.StringType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("current_value", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("severity", T.StringType()),
        T.StructField("fired_at", T.LongType()),
        T.StructField("resolved_at", T.LongType()),
    ]
)

DLQ = T.StructType(
    [
        T.StructField("original_event", EVENT),
        T.StructField("error", T.StringType()),
        T.StructField("failed_at", T.LongType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)
