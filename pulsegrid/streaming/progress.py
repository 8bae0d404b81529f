"""Progress of running queries as rows for the lag operators."""

from __future__ import annotations

import json
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = "query string, batch_id bigint, ts bigint, input_rows bigint, rows_per_second double, sources string"


class ProgressLog(StreamingQueryListener):
    """Appends every progress report of a session's streams to a table; Spark itself keeps only the last hundred.

    Reports are written in files of `every` rows (and at the end of each query, and by `flush`), by a thread of their own:
    a job run in the listener's call would hold up all listeners. Register it with `spark.streams.addListener`, once,
    before the queries start.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._writer = ThreadPoolExecutor(max_workers=1)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        report = json.loads(p.json)
        at = int(datetime.fromisoformat(report["timestamp"]).timestamp() * 1000)
        row = (p.name or str(p.id), int(p.batchId), at, int(report.get("numInputRows", 0)), float(report.get("processedRowsPerSecond", 0.0)), json.dumps(report.get("sources", [])))
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.every
        if full:
            self._writer.submit(self._write)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._writer.submit(self._write)

    def _write(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def flush(self) -> None:
        """Returns once all reports received so far are in the table."""
        self._writer.submit(self._write).result()

    def table(self) -> DataFrame:
        """All reports so far; a micro-batch that was reported again after a restart counts once."""
        self.flush()
        return self.spark.read.schema(PROGRESS).parquet(self.path).dropDuplicates(["query", "batch_id", "ts"])


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The progress reports Spark keeps for a query (a bounded list), one row per micro-batch."""
    rows = []
    for p in query.recentProgress:
        report = json.loads(p.json)
        at = F.lit(report["timestamp"]).cast("timestamp")
        rows.append(
            F.struct(
                F.lit(query.name or str(query.id)).alias("query"),
                F.lit(report["batchId"]).cast("bigint").alias("batch_id"),
                F.unix_millis(at).alias("ts"),
                F.lit(report.get("numInputRows", 0)).cast("bigint").alias("input_rows"),
                F.lit(report.get("processedRowsPerSecond", 0.0)).cast("double").alias("rows_per_second"),
                F.lit(json.dumps(report.get("sources", []))).alias("sources"),
            )
        )
    if not rows:
        return spark.createDataFrame([], PROGRESS)
    return spark.range(1).select(F.inline(F.array(*rows)))


def topic_offsets(progress: DataFrame) -> DataFrame:
    """offsets(topic, ts, partition, current, log_end) from the reports of a topic source.

    The end offset of a micro-batch is what has been read; the latest offset is what is there.
    """
    per_topic = "array<struct<endOffset:map<string,map<string,bigint>>,latestOffset:map<string,map<string,bigint>>>>"
    src = progress.select("ts", F.explode(F.from_json("sources", per_topic)).alias("s"))
    topics = src.select("ts", "s.latestOffset", F.explode("s.endOffset").alias("topic", "read"))
    parts = topics.select("ts", "topic", "latestOffset", F.explode("read").alias("partition", "current"))
    latest = F.try_element_at(F.try_element_at("latestOffset", F.col("topic")), F.col("partition"))
    return parts.select(
        "topic",
        "ts",
        F.col("partition").cast("bigint").alias("partition"),
        "current",
        F.coalesce(latest, F.col("current")).alias("log_end"),
    )
