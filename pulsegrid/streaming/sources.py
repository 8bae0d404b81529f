"""Streaming inputs and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

TOPIC = "events"
DLQ_TOPIC = "events.dlq"
RECOVERY_TOPIC = "events.recovery"

# The micro-batch of the ingest side.
FLUSH_EVENTS = 100
FLUSH_INTERVAL = "50 milliseconds"


def read_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", name_filter: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; `max_files` per trigger is the backpressure setting."""
    reader = spark.readStream.format(fmt).schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_topic(
    spark: SparkSession, servers: str, topic: str = TOPIC, max_offsets: int | None = None,
    from_ms: int | None = None,
) -> DataFrame:
    """A broker topic as (key, value, received_at); needs the Kafka connector on the class path.

    `from_ms` replays from a point in time; give such a run a checkpoint of its own.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if from_ms is not None:
        reader = reader.option("startingTimestamp", str(from_ms))
    return reader.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.unix_millis("timestamp").alias("received_at"),
    )


def write_topic(messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC) -> DataStreamWriter:
    """(key, value) messages to a topic; the tenant as key keeps a tenant's events in order."""
    return (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
