"""Document fingerprints by a randomised edit embedding, and banding over their bits.

A shared random walk (Chakraborty, Goldenberg and Koucky, 2016) reads a text and stays on each character
for a random number of steps that depends only on the character and the step. Edits shift two walks
against each other only until they meet again, so edit distance becomes Hamming distance between the step
sequences. Bits of the sequence at shared sample steps form the fingerprint.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import written
from pulsegrid.llm.components import components

BITS = 512
PERIOD = 4096  # the walk's coins repeat after so many steps
CLASSES = 256  # characters share coins by code point modulo this
CHUNK = 1 << 16


class EditPrinter:
    """Fingerprints of whole texts; equal seeds give equal fingerprints everywhere."""

    def __init__(self, seed: int = 7, bits: int = BITS):
        coins = random.Random(seed)
        self.stay = []  # per class and step: how many steps the walk stays, 1 + tosses until a head
        for _ in range(CLASSES):
            tosses = [coins.getrandbits(1) for _ in range(PERIOD)]
            tosses[-1] = 1
            waits, wait = bytearray(PERIOD), 0
            for step in range(PERIOD - 1, -1, -1):
                wait = 1 if tosses[step] else min(wait + 1, 255)
                waits[step] = wait
            self.stay.append(bytes(waits))
        # Sample steps: for each bit the step of least rank below a text's length. The records of a random
        # ranking of all steps are drawn directly, so lengths that differ little share nearly all steps.
        records = []
        for _ in range(bits):
            at, rank, own = 0, coins.random(), [0]
            while at < 1 << 40:
                rank *= 1 - coins.random()
                at += 1 + int(np.log(1 - coins.random()) / np.log1p(-min(rank, 0.999999)))
                own.append(at)
            records.append(own)
        width = max(map(len, records))
        self.records = np.array([r + [1 << 62] * (width - len(r)) for r in records], np.int64)
        self.rows = np.arange(bits)
        self.factor = np.array([coins.getrandbits(32) | 1 for _ in range(bits)], np.uint32)
        self.shift = np.array([coins.getrandbits(32) for _ in range(bits)], np.uint32)
        self.bits = bits

    def walk(self, codes: bytes, step: int, out: list[np.ndarray]) -> int:
        """Appends the step at which the walk reaches each character; returns the step after the last."""
        stay, mask = self.stay, PERIOD - 1
        for start in range(0, len(codes), CHUNK):
            steps = []
            add = steps.append
            for c in codes[start : start + CHUNK]:
                add(step)
                step += stay[c][step & mask]
            out.append(np.array(steps, np.int64))
        return step

    def bits_at(self, points: np.ndarray, steps: list[np.ndarray], length: int) -> np.ndarray:
        """The fingerprint's bits for characters `points` reached at `steps` of a walk of `length` steps."""
        if length == 0:
            return (self.shift >> 31).astype(np.uint8)
        sample = self.records[self.rows, (self.records < length).sum(axis=1) - 1]
        reached = np.concatenate(steps)
        chars = points[np.searchsorted(reached, sample, side="right") - 1]
        return ((chars * self.factor + self.shift) >> 31).astype(np.uint8)

    def print_of(self, text: str) -> np.ndarray:
        points = code_points(text)
        steps: list[np.ndarray] = []
        return self.bits_at(points, steps, self.walk(classes(points), 0, steps))

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """1 for equal fingerprints; unrelated texts agree on half of the bits, which counts as 0."""
        return max(0.0, 1 - 2 * int(np.count_nonzero(a != b)) / self.bits)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint32)


def classes(points: np.ndarray) -> bytes:
    return (points % CLASSES).astype(np.uint8).tobytes()


def as_hex(bits: np.ndarray) -> str:
    return np.packbits(bits).tobytes().hex()


@lru_cache(maxsize=2)
def printer(seed: int, bits: int) -> EditPrinter:
    return EditPrinter(seed, bits)


def edit_prints(docs: DataFrame, *, text: str = "text", into: str = "fingerprint", seed: int = 7, bits: int = BITS) -> DataFrame:
    """`docs` with the fingerprint of every whole text in hex, in a column that replaces one of the same name.

    Null texts count as empty; equal texts have equal fingerprints. Narrow: no shuffle.
    """
    docs = docs.drop(into)
    schema = docs.select("*", F.lit("").alias(into)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = printer(seed, bits)
        for batch in batches:
            prints = [as_hex(own.print_of(t.as_py() or "")) for t in batch.column(text)]
            yield batch.append_column(into, pa.array(prints, pa.string()))

    return docs.mapInArrow(run, schema)


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows in descending `key` as runs: __run, __ahead (0 own row, 1 the first row of the next run), `key`, `text`.

    Runs are ranges of `key` cut at approximate quantiles, several to a task. The only thing the driver sees is the
    largest key of each run, and the only rows sent twice are the first of each run; the last run gets the
    first run's. Null keys come last, equal keys by text. Partitions come sorted by __run, __ahead and then
    in order; `key` is a whole number meant to be unique, since equal keys share a run.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor = -(2**63)
    rows = docs.select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__text")).withColumn("__order", F.coalesce("__id", F.lit(floor)))
    cuts = rows.select(F.col("__order").cast("double").alias("o")).approxQuantile("o", [i / (3 * partitions) for i in range(1, 3 * partitions)], 0.1 / partitions)
    ladder = np.unique(np.array(cuts, float))

    @F.pandas_udf("int")
    def run_of(order: pd.Series) -> pd.Series:
        return pd.Series(len(ladder) - np.searchsorted(ladder, order.to_numpy().astype(float), side="right"), dtype="int32")

    tops = sorted(map(tuple, rows.select("__order").withColumn("r", run_of("__order")).groupBy("r").agg(F.max("__order")).collect()))
    ahead = [(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)]  # a run's first row also goes to the run before
    lookup = spark.createDataFrame(ahead, "__order long, __before int")
    rows = rows.withColumn("__r", run_of("__order")).join(F.broadcast(lookup), "__order", "left")  # a row per run, three to a partition
    own = F.struct(F.col("__r").alias("__run"), F.lit(0).alias("__ahead"))
    more = F.struct(F.col("__before").alias("__run"), F.lit(1).alias("__ahead"))
    both = F.when(F.col("__before").isNull(), F.array(own)).otherwise(F.array(own, more))
    rows = rows.select(F.explode(both).alias("__at"), "__order", "__id", "__text").select("__at.*", "__order", "__id", "__text")
    return rows.repartition(partitions, "__run").sortWithinPartitions("__run", "__ahead", F.desc("__order"), "__text")


EDITED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_prints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: int = 7, bits: int = BITS) -> DataFrame:
    """Fingerprints of every text and of its edited text, against each other and the next document's.

    The edited text has the last floor(n_chars / 2) characters replaced by the first as many (or all) of the
    next document in descending `key`; after the last comes the first, so a single row is its own next.
    Null texts count as empty. Columns: `key` (long), n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. Other columns of `docs` are ignored.
    """
    schema = f"`{key}` long, {EDITED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting, done = printer(seed, bits), None, []
        for batch in batches:
            for run_id, is_ahead, doc, value in zip(*(batch.column(c) for c in ("__run", "__ahead", "__id", "__text")), strict=True):
                if is_ahead.as_py() and waiting is None:
                    continue  # a tie of the first row of the next run
                value = value.as_py() or ""
                points, steps = code_points(value), []
                length = own.walk(classes(points), 0, steps)
                print_ = own.bits_at(points, steps, length)
                if waiting is not None:
                    done.append(finish(own, *waiting, points, print_))
                reached = np.concatenate(steps) if steps else np.empty(0, np.int64)
                kept = len(points) - len(points) // 2
                at = int(reached[kept]) if kept < len(points) else length
                waiting = None if is_ahead.as_py() else (doc.as_py(), value, points, reached[:kept], at, print_)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []

    arrow = pa.schema([(key, pa.int64()), ("n_chars", pa.int64()), *((c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def finish(own, doc, value, points, reached, at, print_, following, next_print) -> dict:
        cut = len(points) // 2
        points_edited = np.concatenate([points[: len(points) - cut], following[:cut]])
        steps = [reached]  # the walk over the kept half is the text's own; it goes on over the new half
        length = own.walk(classes(following[:cut]), at, steps)
        edited = own.bits_at(points_edited, steps, length if len(points_edited) else 0)
        text_edited = points_edited.astype("<u4").tobytes().decode("utf-32-le")
        return {
            key: doc, "n_chars": len(points), "edited_sha256": hashlib.sha256(text_edited.encode()).hexdigest(),
            "fingerprint": as_hex(print_), "edited_fingerprint": as_hex(edited),
            "near_edited": own.likeness(print_, edited), "near_next": own.likeness(print_, next_print),
        }

    return in_order(docs, key, text).mapInArrow(run, schema)


def near_prints(prints: DataFrame, *, key: str = "doc_id", fingerprint: str = "fingerprint", threshold: float = 0.8, band: int = 16, bands: int = 32) -> DataFrame:
    """(`key`, root, likeness): rows whose fingerprints are near, with the smallest key of their group.

    Rows with one fingerprint count as one. Each of `bands` groups of `band` bits is a bucket; a member is
    compared with the bucket's smallest key only, so a bucket of any size gives one pair per member. Pairs
    below `threshold` are dropped, what is left is joined to groups. likeness is the best a row has to a
    partner, 1 for a copy. Rows without partner, and null keys or fingerprints, are not returned.
    """
    rows = prints.select(F.col(key).cast("long").alias("k"), F.col(fingerprint).alias("f")).where("k IS NOT NULL AND f IS NOT NULL")
    heads = written(rows.groupBy("f").agg(F.min("k").alias("k")), "prints")
    width = band // 4
    parts = F.array(*(F.substring("f", 1 + i * width, width) for i in range(bands)))
    keyed = heads.select("k", "f", F.posexplode(parts).alias("band", "part"))
    first = keyed.groupBy("band", "part").agg(F.min(F.struct("k", "f")).alias("first"), F.count("*").alias("n")).where("n > 1")
    pairs = keyed.join(first.select("band", "part", "first"), ["band", "part"]).where("k <> first.k")
    pairs = pairs.select(F.col("k").alias("b"), F.col("first.k").alias("a"), "f", F.col("first.f").alias("g")).distinct()
    # bits that differ, 60 at a time
    differ = sum(
        (F.bit_count(F.conv(F.substring("f", i, 15), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring("g", i, 15), 16, 10).cast("long"))) for i in range(1, BITS // 4 + 1, 15)),
        F.lit(0),
    )
    links = written(pairs.withColumn("likeness", F.greatest(F.lit(0.0), 1 - 2 * differ / (4 * F.length("f")))).where(F.col("likeness") >= threshold).select("a", "b", "likeness"), "near")
    roots = components(links)
    best = links.select("a", "likeness").union(links.select("b", "likeness")).groupBy(F.col("a").alias("node")).agg(F.max("likeness").alias("likeness"))
    known = heads.join(roots.join(best, "node"), heads.k == F.col("node"), "left").select("f", F.coalesce("root", "k").alias("root"), "likeness", F.col("k").alias("head"))
    size = F.count("*").over(Window.partitionBy("f"))
    joined = rows.withColumn("n", size).join(known, "f").where("n > 1 OR likeness IS NOT NULL")
    return joined.select(F.col("k").alias(key), "root", F.when(F.col("n") > 1, 1.0).otherwise(F.col("likeness")).alias("likeness"))
