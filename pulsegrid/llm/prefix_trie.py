"""Prefix trie of conversations: sparse-table range minima over the sorted conversations' common prefixes.

Distinct conversations are sorted and cut into blocks. Within a block, the minimum of the common prefix lengths over
any run comes from a sparse table, so each candidate prefix finds the left and the right end of its interval of
members by two binary searches of its own. A block knows the conversation before and the one after it, which makes
all that it counts additive: prefixes that reach over a block's ends are merged by their key, all others are final.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import written

BLOCK = 8192  # distinct conversations that a task holds at a time
WIDTH = 16  # bytes of a turn's key
NO_ENDS = hashlib.sha256(b"").hexdigest()
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
PARTIAL = "key binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"


def turn_sequences(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, keys, sizes): per conversation the 128-bit keys of its turns (role and text) and the UTF-8 bytes of their texts.

    Turns are ordered by `turn`, null first; turns of equal number by role and key. Null roles and texts are empty.
    Rows without a conversation are left out. A conversation is one row, at 24 bytes a turn.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    key = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256), 1, 2 * WIDTH))
    row = F.struct(F.col(turn).alias("turn"), by.alias("role"), key.alias("key"), F.octet_length(said).cast("long").alias("size"))
    own = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("id"), row.alias("t"))
    own = own.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return own.select("id", F.col("ts.key").alias("keys"), F.col("ts.size").alias("sizes"))


def lcp_of_neighbours(sequences: list[bytes]) -> np.ndarray:
    """Common turns of each sequence and the one before it; the first has none."""
    length = np.fromiter(map(len, sequences), np.int64, len(sequences)) // WIDTH
    start = np.cumsum(length) - length
    pairs = np.frombuffer(b"".join(sequences), np.uint64).reshape(-1, 2)
    out = np.zeros(len(sequences), np.int64)
    live, depth = np.arange(1, len(sequences)), 0
    while len(live):
        live = live[(length[live] > depth) & (length[live - 1] > depth)]
        live = live[(pairs[start[live] + depth] == pairs[start[live - 1] + depth]).all(axis=1)]
        depth += 1
        out[live] = depth
    return out


class Minima:
    """Sparse table: the minimum of any run of `values` from two overlapping runs of a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels, step = [values], 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def between(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minima of left..right, ends included."""
        level = np.frexp((right - left + 1).astype(float))[1] - 1
        out = np.empty(len(left), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][left[at]], self.levels[k][right[at] - 2**k + 1])
        return out

    def right_ends(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place r that all values in at+1..r let reach, being `depth` or more; each by its own binary search."""
        end, last = at.copy(), len(self.levels[0]) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            step = (end + 2**k <= last) & (table[np.minimum(end + 1, len(table) - 1)] >= depth)
            end[step] += 2**k
        return end

    def left_ends(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place l from which all values in l+1..at are `depth` or more; each by its own binary search."""
        end = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            first = end - 2**k + 1
            step = (first >= 1) & (table[np.clip(first, 0, len(table) - 1)] >= depth)
            end[step] -= 2**k
        return end


def block_nodes(rows: dict, before: bytes | None, after: bytes | None) -> pa.RecordBatch:
    """The trie nodes of one block of sorted distinct sequences, as far as the block holds them.

    `rows` has seq, sizes, n (conversations), id (the smallest) and ends per sequence; `before` and `after` are the
    neighbours of the block. key and parent are given only for nodes that reach over an end of the block.
    """
    m = len(rows["seq"])
    lcp = lcp_of_neighbours([before or b"", *rows["seq"], after or b""])[1:]
    lcp[0] = lcp[0] if before is not None else -1
    lcp[m] = lcp[m] if after is not None else -1
    length = np.fromiter(map(len, rows["seq"]), np.int64, m) // WIDTH
    start = np.cumsum(length) - length
    bytes_to = np.concatenate([[0], np.cumsum(np.fromiter((x for s in rows["sizes"] for x in s), np.int64, int(length.sum())))])
    weight, total = np.array(rows["n"], np.int64), bytes_to[start + length] - bytes_to[start]
    added = total - (bytes_to[start + np.maximum(lcp[:m], 0)] - bytes_to[start])  # bytes of the nodes that a sequence adds
    summed = lambda x: np.concatenate([[0], np.cumsum(x)])
    members, member_bytes, node_bytes, leaves = summed(weight), summed(weight * total), summed(added), summed(lcp[1:] < length)

    # Candidates: the prefixes that a sequence adds; the first sequence of the block stands for all of its own.
    least = lcp[:m] + 1
    least[0] = 0
    at = np.repeat(np.arange(m), length - least + 1)
    depth = np.arange(len(at)) - np.repeat(summed(length - least + 1)[:-1], length - least + 1) + least[at]
    inner, ids = Minima(lcp[:m]), Minima(np.array(rows["id"], np.int64))
    left, right = inner.left_ends(at, depth), inner.right_ends(at, depth)
    up = np.maximum(depth - 1, 0)
    up_left, up_right = inner.left_ends(at, up), inner.right_ends(at, up)

    n_convs = members[right + 1] - members[left]
    new = lcp[left] < depth  # the node is not one that the block before has already
    prefix = bytes_to[start[left] + up] - bytes_to[start[left]]
    own_bytes = np.where(new, total[left] - prefix, added[left]) + node_bytes[right + 1] - node_bytes[left + 1]
    saved = member_bytes[right + 1] - member_bytes[left] - prefix * n_convs - own_bytes
    by_depth = np.sort(lcp[:m] * (m + 1) + np.arange(m))
    children = np.searchsorted(by_depth, depth * (m + 1) + right, "right") - np.searchsorted(by_depth, depth * (m + 1) + left, "left")
    children += new & (length[left] > depth)

    crosses = lambda low, high, d: ((low == 0) & (lcp[0] >= d)) | ((high == m - 1) & (lcp[m] >= d))
    crossing = crosses(left, right, depth)
    parent_crossing = crosses(up_left, up_right, up) & (depth > 0)
    keys, parents, chain, row = [], [], [], -1
    for i, d, own, over in zip(at.tolist(), depth.tolist(), crossing.tolist(), parent_crossing.tolist(), strict=True):
        if i != row:
            row, seq = i, rows["seq"][i]
            del chain[max(d, 1) :]
            if not chain:
                chain.append(bytes(WIDTH))
        while len(chain) <= d:
            j = len(chain) - 1
            chain.append(hashlib.blake2b(chain[-1] + seq[WIDTH * j : WIDTH * (j + 1)], digest_size=WIDTH).digest())
        keys.append(chain[d] if own else None)
        parents.append(chain[d - 1] if over else None)
    ends = [rows["ends"][i] if whole else None for i, whole in zip(at.tolist(), (length[at] == depth).tolist(), strict=True)]
    columns = [
        pa.array(keys, pa.binary()),
        pa.array(parents, pa.binary()),
        pa.array(depth),
        pa.array(ids.between(left, right)),
        pa.array(ids.between(up_left, up_right), mask=depth == 0),
        *(pa.array(c.astype(np.int64)) for c in (n_convs, children, leaves[right + 1] - leaves[left], saved)),
        pa.array(ends, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in PARTIAL.split(", ")])


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """(block, seq, sizes, n, id, ends): each distinct sequence once, in sorted order within and across numbered blocks.

    `n` conversations have it, the smallest is `id`, and `ends` is the SHA-256 of all of their numbers in order. The
    numbers of a sequence meet as one row per 4,096 numbers and are hashed as they stream by, so a conversation that
    a third of all others repeat is as light as any.
    """
    seq = F.unhex(F.array_join(F.transform("keys", lambda k: F.hex(k)), ""))
    rows = sequences.select("id", seq.alias("seq"), "sizes", F.shiftright("id", 12).alias("chunk"))
    names = F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda i: i.cast("string")), ",")
    chunks = written(rows.groupBy("seq", "chunk").agg(F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("id").alias("id"), names.alias("names")), "chunks")
    blocks = max(1, -(-chunks.count() // BLOCK))
    ordered = chunks.repartitionByRange(blocks, "seq").sortWithinPartitions("seq", "chunk").withColumn("block", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hasher, done = None, None, []
        columns = ["block", "seq", "sizes", "n", "id"]

        def packed(rows: list[list]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
            parts = list(zip(*rows, strict=True)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds, strict=True)], [*columns, "ends"])

        for batch in batches:
            for *row, text in zip(*(batch.column(c).to_pylist() for c in [*columns, "names"]), strict=True):
                if last is not None and row[1] == last[1]:
                    last[3] += row[3]
                    hasher.update(b"," + text.encode())
                    continue
                if last is not None:
                    done.append([*last, hasher.hexdigest()])
                last, hasher = row, hashlib.sha256(text.encode())
            yield packed(done)
            done = []
        if last is not None:
            yield packed([[*last, hasher.hexdigest()]])

    ordered = ordered.select("block", "seq", "sizes", "n", "id", "names")
    return written(ordered.mapInArrow(run, "block int, seq binary, sizes array<long>, n long, id long, ends string"), "sequences")


def trie_nodes(sequences: DataFrame) -> DataFrame:
    """One row per trie node of `sequences` (id, keys, sizes; ids unique): every distinct run of first turns, the root included.

    conv_id is the smallest member, parent_conv_id the parent's (root: null), n_convs counts members, n_children
    direct children, n_leaves childless nodes of the subtree. saved_tokens sums (n_convs - 1) * bytes of the last turn
    over the subtree; ends_sha256 digests the numbers of the members that end at the node. Empty sequences are members
    of the root. No sequences give no rows.
    """
    rows = distinct_sequences(sequences)
    in_order = Window.orderBy("block")  # one row per block
    bounds = rows.groupBy("block").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    bounds = bounds.select("block", F.lag("hi").over(in_order).alias("before"), F.lead("lo").over(in_order).alias("after"))
    side = lambda c, kind: bounds.where(f"{c} IS NOT NULL").select("block", F.lit(kind).alias("kind"), F.col(c).alias("seq"))
    all_ = rows.withColumn("kind", F.lit(0)).unionByName(side("before", -1).unionByName(side("after", 1)), allowMissingColumns=True)
    dealt = all_.repartition("block").sortWithinPartitions("block", "kind", "seq").select("block", "kind", "seq", "sizes", "n", "id", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["seq", "sizes", "n", "id", "ends"]
        block, sides, own = None, {}, {c: [] for c in names}
        for batch in batches:
            for number, kind, *row in zip(*(batch.column(c).to_pylist() for c in ["block", "kind", *names]), strict=True):
                if number != block:
                    if own["seq"]:
                        yield block_nodes(own, sides.get(-1), sides.get(1))
                    block, sides, own = number, {}, {c: [] for c in names}
                if kind:
                    sides[kind] = row[0]
                else:
                    for c, v in zip(names, row, strict=True):
                        own[c].append(v)
        if own["seq"]:
            yield block_nodes(own, sides.get(-1), sides.get(1))

    nodes = written(dealt.mapInArrow(run, PARTIAL), "nodes")
    over = nodes.where("key IS NOT NULL").groupBy("key", "depth").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in SUMS), F.max("ends").alias("ends")
    )
    over = written(over, "crossing")
    found = nodes.where("key IS NULL").unionByName(over.withColumn("parent_conv_id", F.lit(None).cast("long")))
    above = over.select(F.col("key").alias("parent"), F.col("conv_id").alias("__above"))
    hung = found.where("parent IS NOT NULL").join(above, "parent").withColumn("parent_conv_id", F.col("__above"))
    out = found.where("parent IS NULL").unionByName(hung.drop("__above"))
    return out.select("conv_id", "depth", "parent_conv_id", *SUMS, F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
