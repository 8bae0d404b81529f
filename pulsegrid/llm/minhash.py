"""MinHash near-duplicates by tensored banding: table keys are pairs of groups of a small collection of hashes.

48 minhashes form 16 groups of three. A table for every pair of groups gives 120 tables of six hashes each,
for the cost of 48 hashes instead of 720. At a similarity of 0.8 a pair shares no table with a probability
of 2 in 10,000. Every candidate is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import texts_of, written
from pulsegrid.llm.components import components

BLOCK = 1024  # members of a table entry that one task compares at a time
PAIRS = 1 << 16  # pairs of such members whose signatures are compared at once


@dataclass(frozen=True)
class Layout:
    """How a signature is cut: `groups` of `per_group` numbers of `dtype`.

    `least_equal` numbers must be equal for a pair to be a candidate; it lies more than four deviations below
    what a pair at the threshold has on average.
    """

    groups: int
    per_group: int
    dtype: str
    least_equal: int

    @property
    def hashes(self) -> int:
        return self.groups * self.per_group

    @property
    def width(self) -> int:
        return np.dtype(self.dtype).itemsize

    def group(self, i: int) -> Column:
        size = self.per_group * self.width
        return F.substring("sig", 1 + size * i, size)


DOCUMENTS = Layout(groups=16, per_group=3, dtype="u4", least_equal=26)
GROUPS, HASHES = DOCUMENTS.groups, DOCUMENTS.hashes
_RNG = np.random.default_rng(97)
_MUL = (_RNG.integers(0, 2**32, HASHES, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
_ADD = _RNG.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the `width`-word shingles; a shorter text is one shingle, one without words none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and exactly the six space characters
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(width, n)
    h = w[: n - width + 1] + np.uint64(width)
    for j in range(1, width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[j : n - width + 1 + j]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def signature(shingles: np.ndarray) -> bytes:
    """The minimum of each hash function over the whole set, as 48 unsigned 32-bit numbers."""
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    best = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 4096):
        np.minimum(best, (low[at : at + 4096] * _MUL + _ADD).min(axis=1), out=best)
    return best.tobytes()


def signatures(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """__id, n_shingles, __set (hash of the whole set), __sig; one row per row of `docs`, which is read once."""
    schema = "__id long, n_shingles long, __set binary, __sig binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sets, sigs = [], [], []
            for t in texts_of(batch, "__text"):
                s = shingle_set(t, width)
                sizes.append(len(s))
                sets.append(xxhash.xxh3_128_digest(s.tobytes()))
                sigs.append(signature(s) if len(s) else b"")
            arrays = [batch.column("__id"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["__id", "n_shingles", "__set", "__sig"])

    return docs.select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__text")).mapInArrow(run, schema)


def shared_groups(heads: DataFrame) -> DataFrame:
    """(id, gs): ids of `heads` (id, sig) that share two or more of their 16 groups with others, and those groups (i, h).

    Two ids that share a table share both of its groups, so only these ids and groups can meet in a table.
    """
    parts = heads.select("id", F.posexplode(F.array(*(F.xxhash64(DOCUMENTS.group(i)) for i in range(GROUPS)))).alias("i", "h"))
    busy = parts.groupBy("i", "h").agg(F.count("*").alias("n")).where("n > 1").select("i", "h")
    return parts.join(busy, ["i", "h"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("i", "h"))).alias("gs")).where(F.size("gs") > 1)


def tables(shared: DataFrame) -> DataFrame:
    """(id, pair, entry): for each pair of groups that an id shares, the table and the key in it."""
    later = lambda a: F.filter("gs", lambda b: b["i"] > a["i"])
    entry = lambda a, b: F.struct((a["i"] * GROUPS + b["i"]).alias("pair"), F.xxhash64(a["i"], b["i"], a["h"], b["h"]).alias("entry"))
    pairs = F.flatten(F.transform("gs", lambda a: F.transform(later(a), lambda b: entry(a, b))))
    return shared.select("id", F.explode(pairs).alias("p")).select("id", "p.pair", "p.entry")


def long_set(content: pa.Scalar) -> tuple[np.ndarray, frozenset]:
    """A list of distinct longs as a set: sorted numbers and, here none, other members."""
    return np.sort(content.values.to_numpy()), frozenset()


def linked(s: tuple[np.ndarray, frozenset], t: tuple[np.ndarray, frozenset], percent: int) -> bool:
    """Whether two sets have 100 * intersection >= percent * union; distinct numbers that both have are neighbours when sorted."""
    numbers = np.sort(np.concatenate([s[0], t[0]]))
    both = int(np.count_nonzero(numbers[1:] == numbers[:-1])) + len(s[1] & t[1])
    return 100 * both >= percent * (len(numbers) + len(s[1]) + len(t[1]) - both)


def confirmed(pairs: DataFrame, contents: Callable[[DataFrame], DataFrame], as_set: Callable, percent: int) -> DataFrame:
    """The `pairs` (a, b) of ids whose whole sets have 100 * intersection >= percent * union, written out."""
    known = contents(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    side = lambda c: known.select(F.col("id").alias(c), F.col("content").alias(f"c{c}"))
    rows = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ca"), batch.column("cb"), strict=True):
                keep.append(linked(as_set(x), as_set(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(rows.mapInArrow(run, "a long, b long").distinct(), "links")


def shingle_sets(docs: DataFrame, ids: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, content): the full shingle sets of the documents in `ids`, made again and written; joined by measured size."""
    picked = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("__text")).join(written(ids, "candidates"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t, width).view(np.int64) for t in texts_of(part, "__text")]
                offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                values = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), values], ["id", "content"])

    return written(picked.mapInArrow(run, "id long, content array<long>").dropDuplicates(["id"]), "sets")


def _meetings(rows: dict, percent: int, layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query rows, rows that each may be linked with), queries in order and the likeliest of each first, for whole blocks.

    Queries meet the rows whose own block this is, all queries of many blocks at once, in parts of about `PAIRS` pairs;
    a pair belongs to the first group it shares.
    """
    ids, comp, sizes, query, away, sigs = (rows[c] for c in ("id", "comp", "n_shingles", "query", "away", "sig"))
    home, asks = np.flatnonzero(~away), np.flatnonzero(query)
    run = rows["run"]
    first, last = (np.searchsorted(run[home], run[asks], side) for side in ("left", "right"))
    ends = np.cumsum(last - first)
    start = 0
    while start < len(asks):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
        n = (last - first)[start:stop]
        q = np.repeat(asks[start:stop], n)
        o = home[np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[start:stop], n)]
        # a query at home meets queries with a larger id, and all rows that are none; the pair of two queries is met at both homes
        keep = (comp[o] != comp[q]) & (away[q] | ~query[o] | (ids[o] > ids[q]))
        keep &= 100 * np.minimum(sizes[o], sizes[q]) >= percent * np.maximum(sizes[o], sizes[q])
        q, o = q[keep], o[keep]
        equal = np.concatenate([np.zeros(0, np.int64), *(np.count_nonzero(sigs[q[i : i + 4096]] == sigs[o[i : i + 4096]], axis=1) for i in range(0, len(q), 4096))])
        keep = equal >= layout.least_equal
        q, o, equal = q[keep], o[keep], equal[keep]
        shared = (sigs[q] == sigs[o]).reshape(len(q), layout.groups, layout.per_group).all(axis=2)
        keep = ~(shared & (np.arange(layout.groups) < rows["pair"][q][:, None])).any(axis=1)
        q, o, equal = q[keep], o[keep], equal[keep]
        order = np.lexsort((-equal, q))
        if len(q):
            yield q[order], o[order]
        start = stop


def _blocks(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """(columns, rows) of whole runs of equal (group, entry, block), many at once; the last run of a batch may go on in the next."""
    rest = None
    for batch in _and_end(batches):
        if batch is not None:
            rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if rest.num_rows < 4096:
                continue
        if rest is None or not rest.num_rows:
            continue
        keys = [rest.column(c).to_numpy() for c in ("pair", "entry", "block")]
        cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        end = rest.num_rows if batch is None else int(cuts[-1]) if len(cuts) else 0
        if end:
            part = rest.slice(0, end)
            columns = {c: part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "comp", "n_shingles", "query", "away", "pair")}
            columns["sig"] = np.frombuffer(b"".join(part.column("sig").to_pylist()), layout.dtype).reshape(-1, layout.hashes)
            columns["run"] = np.searchsorted(cuts, np.arange(end), "right")
            yield columns, part
            rest = rest.slice(end)


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def crossing(
    groups: DataFrame, heads: DataFrame, known: DataFrame, contents: Callable[[DataFrame], DataFrame], as_set: Callable, percent: int, layout: Layout
) -> DataFrame:
    """(a, b): links that join components of `known`, found and confirmed inside the tasks that hold both ids.

    `groups` (id, pair, entry) has the groups of a signature that ids share. An entry whose ids are all in one
    component needs no work. In any other, the ids outside its most common component meet all of its ids, in
    blocks of about 1,024, so an entry of any size is dealt to many tasks. A first pass compares signatures and
    keeps the rows that have a likely partner; only these get their whole contents (`contents` of ids: id, content;
    `as_set` of one, as `linked` takes it) for the second pass, which confirms the likely pairs, likeliest first, unless confirmed ones have
    joined them already. No pair leaves a task but a link that joins two components there, so a group of
    near copies gives about one row per member and block.
    """
    where = groups.join(known, F.col("id") == F.col("node"), "left").select("id", "pair", "entry", F.coalesce("root", "id").alias("comp"))
    where = written(where, "entries")
    parts = where.groupBy("pair", "entry", "comp").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("pair", "entry").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top")).where("k > 1")
    mixed = mixed.select("pair", "entry", F.col("top.comp").alias("top"), F.ceil(F.col("n") / BLOCK).alias("blocks"))
    rows = where.join(mixed, ["pair", "entry"]).withColumn("query", F.col("comp") != F.col("top"))
    own = F.pmod(F.xxhash64("id"), "blocks")
    at = F.when(F.col("query"), F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), (b != own).alias("away"))))
    rows = rows.withColumn("at", F.explode(F.coalesce(at, F.array(F.struct(own.alias("block"), F.lit(False).alias("away"))))))
    rows = rows.select("pair", "entry", "at.block", "at.away", "id", "comp", "query").join(heads.select("id", "n_shingles", "sig"), "id")
    dealt = lambda df: df.repartition("entry", "block").sortWithinPartitions("pair", "entry", "block", "id")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, part in _blocks(batches, layout):
            some = np.zeros(part.num_rows, bool)
            for q, found in _meetings(columns, percent, layout):
                some[q] = True
                some[found] = True
            if some.any():
                yield part.filter(pa.array(some))

    schema = rows.select("pair", "entry", "block", "away", "id", "comp", "query", "n_shingles", "sig").schema
    rows = written(dealt(rows.select(*schema.names)).mapInArrow(likely, schema), "likely")
    full = dealt(rows.join(contents(rows.select("id").distinct()), "id").select(*schema.names, "content"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, part in _blocks(batches, layout):
            content, sets, joined, links = part.column("content"), {}, {}, []

            def root(c: int, joined: dict = joined) -> int:
                while c in joined:
                    c = joined[c]
                return c

            def own_set(i: int, sets: dict = sets, content=content) -> tuple:
                if ids[i] not in sets:
                    if len(sets) >= BLOCK:
                        sets.clear()
                    sets[ids[i]] = as_set(content[i])
                return sets[ids[i]]

            ids, comps = columns["id"].tolist(), columns["comp"].tolist()
            for some, found in _meetings(columns, percent, layout):
                for q, o in zip(some.tolist(), found.tolist(), strict=True):
                    x, y = root(comps[q]), root(comps[o])
                    if x != y and linked(own_set(q), own_set(o), percent):
                        links.append((ids[q], ids[o]))
                        joined[max(x, y)] = min(x, y)
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return written(full.mapInArrow(confirm, "a long, b long"), "crossing")


def clustered(
    entries: DataFrame, groups: DataFrame, heads: DataFrame, contents: Callable[[DataFrame], DataFrame], as_set: Callable, percent: int, layout: Layout
) -> DataFrame:
    """(node, root) of the components of ids linked at `percent`; ids without a link are not returned.

    `entries` (id, pair, entry) are written table entries, `groups` the same for single groups of the signatures,
    `heads` (id, n_shingles, sig) their ids. Each id is first paired with the one partner it shares most tables
    with, which joins most of a group of near copies for one pair per member. What links join the
    components so found is then settled entry by entry (`crossing`), so no link between components is lost.
    """
    # The first id of an entry, by a random order that all entries share, is the partner of the others.
    first = entries.groupBy("pair", "entry").agg(F.min_by("id", F.xxhash64("id")).alias("a"))
    met = entries.join(first, ["pair", "entry"]).where("id <> a")
    best = met.groupBy("id", "a").agg(F.count("*").alias("n")).groupBy("id").agg(F.max(F.struct("n", "a")).alias("m"))
    side = lambda c: heads.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("sig").alias(f"s{c}"))
    number = lambda c, k: F.expr(c).substr(layout.width * k + 1, F.lit(layout.width))
    equal = F.aggregate(F.sequence(F.lit(0), F.lit(layout.hashes - 1)), F.lit(0), lambda n, k: n + (number("sa", k) == number("sb", k)).cast("int"))
    likely = best.select("m.a", F.col("id").alias("b")).join(side("a"), "a").join(side("b"), "b")
    likely = likely.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).where(equal >= layout.least_equal)
    links = confirmed(written(likely.select("a", "b"), "pairs"), contents, as_set, percent)
    known = written(components(links), "components")
    more = crossing(groups, heads, known, contents, as_set, percent, layout)
    return known if more.isEmpty() else written(components(links.union(more)), "components")


def near_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of `docs`: `key`, n_shingles, component_id and kept.

    Texts are compared by their sets of `width`-word shingles (words between ASCII white space, A-Z lower-cased).
    Rows with equal sets are one node. Two nodes are linked if 100 * intersection >= percent * union, checked on
    full sets; component_id is the smallest key that links lead to, and kept says that the row has it. Null and
    empty texts and those without words have no shingles and are linked with nothing. A null key has a null
    component and is kept. Rows that repeat a key are one document.

    Every step is written to the shared folder.
    """
    signed = written(signatures(docs, key, text, width), "signatures")
    full = signed.where("n_shingles > 0 AND __id IS NOT NULL")
    nodes = full.groupBy("__set", "n_shingles").agg(F.min("__id").alias("id"), F.first("__sig").alias("sig"))
    heads = written(nodes, "nodes")
    shared = written(shared_groups(heads.select("id", "sig")), "shared")
    entries = written(tables(shared), "tables")
    groups = shared.select("id", F.explode("gs").alias("g")).select("id", F.col("g.i").alias("pair"), F.col("g.h").alias("entry"))
    contents = lambda ids: shingle_sets(docs, ids, key, text, width)
    known = clustered(entries, groups, heads, contents, long_set, percent, DOCUMENTS)
    roots = heads.join(known, F.col("id") == F.col("node"), "left").select("__set", "n_shingles", F.coalesce("root", "id").alias("root"))
    out = signed.join(roots, ["__set", "n_shingles"], "left").withColumn("component_id", F.coalesce("root", "__id"))
    kept = F.coalesce(F.col("__id") == F.col("component_id"), F.lit(True))
    kind = docs.schema[key].dataType
    return out.select(F.col("__id").cast(kind).alias(key), "n_shingles", F.when(F.col("__id").isNotNull(), F.col("component_id")).alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """`docs` without the rows that are not the first of their component, columns unchanged.

    Rows that repeat a kept key all stay. The dropped keys are written first and joined by measured size.
    """
    out = near_components(docs, key=key, text=text, width=width, percent=percent)
    gone = written(out.where("NOT kept").select(F.col(key).alias("__gone")).distinct(), "dropped")
    return docs.join(gone, docs[key] == gone["__gone"], "left_anti")
