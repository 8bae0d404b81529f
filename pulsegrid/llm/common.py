"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import shared_dir

# Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, outlives executors, and of a size the planner knows."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The whole texts of an Arrow batch; a null text is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def slices(batch: pa.RecordBatch, column: str, budget: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows of about `budget` characters of `column`; no row is split or dropped."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()):
        if size and size + n > budget:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


class Cache(dict):
    """A dict that a worker keeps between batches; above `limit` entries the older half goes, so memory stays bounded."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def trim(self) -> None:
        if len(self) > self.limit:
            for k in list(islice(self, len(self) // 2)):
                del self[k]
