"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "pulsegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # A session that runs the whole set of queries needs more than the default 100 classes.
        "spark.sql.codegen.cache.maxEntries": "2000",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sizing(input_bytes: int, partition_bytes: int = 128 * 1024**2, cores: int = 8) -> dict[str, str]:
    """Shuffle settings for a job over `input_bytes`: many small partitions, merged by AQE.

    AQE joins partitions that turn out small but cannot add any, so the first number follows the
    input. 100 TB gives about 780,000 map-side splits; shuffled data is far less than the input
    (narrow keys, combined on the map side), so a quarter of that, at most 100,000, is enough.
    """
    splits = max(1, input_bytes // partition_bytes)
    first = min(max(cores, splits // 4), 100_000)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(first),
        "spark.sql.shuffle.partitions": str(first),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def use_utc(spark: SparkSession) -> None:
    """Event time is UTC; casts take their zone from the session when the plan is built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own: executors of a real cluster
    cannot see the driver's disk, and a lost executor would take its part with it.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="pulsegrid-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(spark, df):
    """Write `df` to the shared folder and read it back: a lineage cut that outlives executors."""
    path = shared_dir(spark, "cut")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
