"""Filter interaction audit: what each filter removes in every order of the filters, from one pass over the texts.

A document is known by its mask, the set of filters that it fails. Combining masks with the inverse permutations of
the orders by minimum gives the step at which an order removes each mask; counts per mask, scattered by that step,
give all tables of the audit. Texts are read once and only counts per (part, mask) meet the 120 orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import UPPER, texts_of, written

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
SYMBOLS = b"#$%&*|"


def text_mask(text: str) -> int:
    """Filters A to D that a text fails, as bits: few words, few distinct words, many capitals, a symbol."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes: cut at the six ASCII space characters only
    capitals = len(raw) - len(raw.translate(None, UPPER.encode()))
    fails = (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * capitals > 10 * len(text),
        len(raw.translate(None, SYMBOLS)) < len(raw),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def text_failures(docs: DataFrame, *, key: str, text: str, part: str) -> DataFrame:
    """(id, part, digest, mask) of every row: filters A to D, and a 128-bit digest that stands for the text."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("__text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "__text")
            digests = [hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
            arrays = [batch.column("id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(map(text_mask, texts), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "part", "digest", "mask"])

    return rows.mapInArrow(run, f"id {kind}, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): rows of `docs` by part and filters failed, E included.

    E is failed by a row whose text is also that of a row with a smaller key, whatever its part. Rows with a null
    key have no place in that order: they neither fail E nor make others fail it, and have no label. Null texts are
    empty, null parts are the empty string. A document is good (toxic) if any label row of its key says so.

    A group of copies is combined before each shuffle: what is compared is one row per text, part, mask and label.
    """
    flags = written(text_failures(docs, key=key, text=text, part=part), "filters")
    own = labels.select(F.col(key).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).where("id IS NOT NULL")
    own = own.groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    known = flags.where("id IS NOT NULL").groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")).join(own, "id", "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    like = known.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    least = F.min("first.id").over(Window.partitionBy("digest"))
    like = like.withColumn("alone", F.when(F.col("first.id") == least, F.col("first.n")).otherwise(0))
    split = F.array(
        F.struct("mask", F.col("alone").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(REPEATED)).alias("mask"), (F.col("n") - F.col("alone")).alias("n")),
    )
    like = like.select("part", "good", "toxic", F.explode(split).alias("s")).select("part", "good", "toxic", "s.mask", "s.n")
    none = flags.where("id IS NULL").groupBy("part", "mask").agg(F.count("*").alias("n"))
    rows = like.unionByName(none.withColumns({"good": F.lit(False), "toxic": F.lit(False)})).where("n > 0")
    weight = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), weight("good"), weight("toxic"))


def removal_steps(orders: list[str], filters: str = FILTERS) -> np.ndarray:
    """masks x orders: the step (1, 2, ...) at which an order removes a mask; one more than there are filters: never.

    The min-plus product of the mask matrix (0 where a filter is failed, infinite elsewhere) and the matrix of the
    filters' places in the orders, which holds the inverse permutations.
    """
    never = len(filters) + 1
    masks = np.where(np.arange(2 ** len(filters))[:, None] >> np.arange(len(filters)) & 1, 0, never)
    places = np.array([[order.index(f) + 1 for order in orders] for f in filters])
    return np.minimum(never, (masks[:, :, None] + places[None]).min(axis=1))


def audit_counts(counts: np.ndarray, orders: list[str], filters: str = FILTERS) -> dict[str, np.ndarray]:
    """Tables of orders x steps from counts (mask, weight) of one part; the weights are all, good and toxic documents."""
    steps, size = removal_steps(orders, filters), len(filters)
    removed = np.zeros((3, len(orders), size + 2), np.int64)
    for w in range(3):
        np.add.at(removed[w], (np.arange(len(orders))[None], steps), counts[:, w][:, None])
    n = removed[0, :, 1 : size + 1]
    at = np.array([[filters.index(f) for f in order] for order in orders])  # the filter of each step
    fails = (np.arange(len(counts))[:, None] >> np.arange(size) & 1) * counts[:, :1]  # masks x filters
    earlier = steps[:, :, None] < np.arange(1, size + 1)  # masks x orders x steps
    redundant = np.einsum("mos,mos->os", earlier, fails[:, at])
    shapley = np.zeros(size, np.int64)
    np.add.at(shapley, at, n)
    return {
        "kept": counts[:, 0].sum() - np.cumsum(n, axis=1),
        "removed": n,
        "redundant": redundant,
        "unique_fails": counts[1 << np.arange(size), 0][at],
        "good_lost": removed[1, :, 1 : size + 1],
        "toxic_lost": removed[2, :, 1 : size + 1],
        "shapley": shapley[at],
    }


def audit_filters(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, filter_order and step with the counts of the audit, from `mask_counts`.

    A part has at most 32 rows of counts, which meet in one row; a task holds the tables of one part at a time.
    No counts give no rows.
    """
    orders = ["".join(p) for p in permutations(filters)]
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(orders) * len(filters)
        for batch in batches:
            for part, rows in zip(batch.column("part"), batch.column("rows"), strict=True):
                own = np.zeros((2 ** len(filters), 3), np.int64)
                for r in rows.as_py():
                    own[r["mask"]] += (r["n"], r["good"], r["toxic"])
                tables = audit_counts(own, orders, filters)
                places = [pa.array([part.as_py()] * size), pa.array(np.repeat(orders, len(filters)).tolist()), pa.array(list(range(1, len(filters) + 1)) * len(orders), pa.int32())]
                yield pa.RecordBatch.from_arrays([*places, *(pa.array(tables[c].ravel(), pa.int64()) for c in names)], ["part", "filter_order", "step", *names])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names))
