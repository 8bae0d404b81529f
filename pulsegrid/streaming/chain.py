"""The whole ingest path as streams over each other's tables: messages to stored events, dead letters and windows.

Tables between streams are written by Spark's file sink, whose log names the files of committed micro-batches. A stream
that reads such a table takes its files from that log, so what a failed attempt left in the folder is never read, and a
restart reads no file twice. Each stream has its own watermark and restarts from its own checkpoint:

    messages -> landing (decoded, completed, validated) -> dead letters
                                                        -> events (first copies, late ones too) -> windows (without late ones)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from ..functions.payloads import payload_value
from ..functions.timing import DAY, TUMBLING, with_calendar
from ..operators.dedup import DEDUP_TTL
from ..operators.ingest import apply_defaults, flag_late, for_windows, resolve_tenant, validate
from ..sources.decode import decode_events
from ..sources.files import Folder
from ..sources.tables import to_dead_letters
from . import jobs, stateful
from .sources import read_files

ARRIVAL_LATENESS = "10 minutes"  # how far arrival times may be out of order


def landed(messages: DataFrame, value: str = "value", received_at: str = "received_at", header: str | None = None) -> DataFrame:
    """Messages as completed events with `error` (null: valid), `raw` (undecodable text) and `is_late`.

    A missing id is made, a missing time is the arrival time, and the tenant of a request header wins.
    """
    events = decode_events(messages, value)
    if header:
        events = events.withColumn("tenant_id", resolve_tenant(header, "tenant_id"))
    checked = flag_late(validate(apply_defaults(events, F.col(received_at))), received_at)
    return checked.withColumn("error", F.coalesce("decode_error", "error")).drop("decode_error")


def stored(rows: DataFrame, path: str, checkpoint: str, *partitions: str) -> DataStreamWriter:
    """Appends a stream to a table whose log names the committed files."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partitions) if partitions else writer


class IngestChain:
    """The streams of one installation; tables and checkpoints lie in folders under `root`.

    `buckets` is how many buckets of ids share the state of duplicates, and as fixed as a checkpoint; None: state per id.
    """

    def __init__(self, messages: DataFrame, root: str, received_at: str = "received_at", header: str | None = None, ttl_ms: int = DEDUP_TTL, buckets: int | None = stateful.BUCKETS):
        self.spark, self.root, self.received_at, self.ttl_ms, self.buckets = messages.sparkSession, root.rstrip("/"), received_at, ttl_ms, buckets
        self.rows = landed(messages, received_at=received_at, header=header)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _table(self, name: str, schema: StructType) -> DataFrame:
        return read_files(self.spark, Folder(self.spark, self.path(name)).make(), schema)

    def _landing(self) -> DataFrame:
        return self._table("landing", self.rows.schema)

    def _good(self) -> DataFrame:
        return self._landing().where("error IS NULL").drop("error", "raw")

    def start_landing(self) -> DataStreamWriter:
        return stored(self.rows, self.path("landing"), self.path("checkpoints/landing"))

    def start_dead_letters(self) -> DataStreamWriter:
        return stored(to_dead_letters(self._landing(), "error", self.received_at, attempts=1), self.path("dlq"), self.path("checkpoints/dlq"))

    def start_events(self) -> DataStreamWriter:
        """First copies by id within the time to live, by arrival; late events are stored like others, with their label."""
        jobs.use_rocksdb(self.spark)
        first = stateful.drop_duplicates_exact(
            self._good(), ["id"], ts=self.received_at, seq="timestamp", ttl_ms=self.ttl_ms, lateness=ARRIVAL_LATENESS, buckets=self.buckets
        )
        # Quarters of a tenant's day go to a task each: rows dealt by id would give every task a file in every day.
        together = with_calendar(first).repartition("tenant_id", "event_date", F.expr(f"pmod(timestamp, {DAY}L) div {DAY // 4}L"))
        return stored(together, self.path("events"), self.path("checkpoints/events"), "tenant_id", "event_date")

    def event_schema(self) -> StructType:
        return with_calendar(self.rows.drop("error", "raw")).schema

    def start_windows(self, durations: dict[str, int] = TUMBLING) -> DataStreamWriter:
        """Metrics of closed windows over the stored events and the values in their payloads.

        Build it once the events table has its first files: Spark learns a stream's partition columns from the folders.
        """
        jobs.use_rocksdb(self.spark)
        events = for_windows(self._table("events", self.event_schema()).withColumn("value", payload_value("payload")), "exclude")
        return jobs.start_window_metrics(events, self.path("windows"), self.path("checkpoints/windows"), durations)

    def read(self, name: str) -> DataFrame:
        """A table of the chain as it is committed now; types come from the chain, not from folder names."""
        if name == "events":
            return self.spark.read.schema(self.event_schema()).parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def run_available(self, durations: dict[str, int] = TUMBLING) -> None:
        """Each stream in turn takes what its source holds now: a backfill, or a step of a scheduled run."""
        for start in (self.start_landing, self.start_dead_letters, self.start_events, lambda: self.start_windows(durations)):
            jobs.run_available(start())


def read_chain(spark: SparkSession, messages_path: str, schema: StructType, root: str, max_files: int | None = 1, **options) -> IngestChain:
    """A chain over a folder of message files."""
    return IngestChain(read_files(spark, messages_path, schema, max_files=max_files), root, **options)
