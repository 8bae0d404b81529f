"""Best-fit packing: patterns of lengths, repeat counts by non-negative least squares, best fit for the rest."""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from pulsegrid.llm.common import Cache, texts_of, written

CACHED_CHUNKS, CACHED_WORDS = 1_000_000, 600_000
LATIN = "\u024f"  # the last letter of the blocks whose classes and lower case are the same in all Unicode versions
# Fixed value: how the tokenizer cuts a chunk without white space before its merges.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class ChunkTokenizer:
    """The tokenizer's ids by way of bounded caches of chunks between spaces and of the words in them.

    This kind of tokenizer drops white space, cuts what is left into words and never merges across them, so the
    ids of a text are those of its words in order. Words with Latin letters only are cut and lower-cased here,
    and unknown ones encoded together; the ids that end a word tell them apart. Other chunks go whole through
    the tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)  # the same merges for words that are cut already
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), byte_level])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.chunks, self.words = Cache(CACHED_CHUNKS), Cache(CACHED_WORDS)

    def _learn_words(self, words: list[str]) -> None:
        ids = np.array(self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
        if len(cuts) != len(words) + 1:
            raise ValueError("the tokenizer does not end each word with an id of its own")
        raw = ids.tobytes()
        self.words.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(words, cuts, cuts[1:], strict=False))

    def _learn(self, chunks: list[str]) -> None:
        cut = {}
        for c in chunks:
            if not c.isascii() and max(c) > LATIN or "<|" in c:
                self.chunks[c] = np.array(self.tokenizer.encode(c, add_special_tokens=False).ids, "<u4").tobytes()
            elif (low := c.lower()).isalpha():
                cut[c] = (low,)
            elif low[:-1].isalpha() and not low[-1].isalnum() and not low[-1].isspace() and low[-1] != "'":
                cut[c] = (low[:-1], low[-1])
            else:
                cut[c] = WORDS.findall(low)
        known = self.words
        unknown = [w for w in set().union(*cut.values()) if w not in known]
        for i in range(0, len(unknown), 4096):
            self._learn_words(unknown[i : i + 4096])
        own = known.__getitem__
        self.chunks.update((c, own(words[0]) if len(words) == 1 else b"".join(map(own, words))) for c, words in cut.items())
        known.trim()

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, unsigned 32-bit little-endian."""
        known, unknown, found = self.chunks, {}, []
        for t in texts:
            chunks = t.replace("\n", " ").split(" ")
            ids = list(map(known.get, chunks))
            gaps = [(i, chunks[i]) for i, own in enumerate(ids) if own is None]
            unknown.update((c, None) for _, c in gaps)
            found.append((ids, gaps))
        if unknown:
            self._learn(list(unknown))
        for ids, gaps in found:
            for i, c in gaps:
                ids[i] = known[c]
        known.trim()
        return [b"".join(ids) for ids, _ in found]


@lru_cache(maxsize=2)
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every whole document: `key`, piece, start, length, ids_crc32.

    A document is its ids and then `end`; only one longer than `capacity` is cut, into pieces of `capacity`
    of which the last may be shorter. Null and empty texts are the single id `end`.
    """
    schema = docs.select(key).schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = chunk_tokenizer(tokenizer)
        for batch in batches:
            texts, source, rows = texts_of(batch, text), [], []
            for first in range(0, len(texts), 64):
                for i, raw in enumerate(own.packed(texts[first : first + 64]), first):
                    raw += tail
                    for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at : at + 4 * capacity]
                        source.append(i)
                        rows.append((piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [batch.column(key).take(pa.array(source, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, [key, "piece", "start", "length", "ids_crc32"])

    return docs.select(key, text).mapInArrow(run, schema)


def nnls(rows: np.ndarray, weight: np.ndarray, target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """min |A x - target|, x >= 0, by accelerated projected gradients.

    A is sparse: column j adds weight[i] at each row i in rows[j], and has no more entries than a pattern has
    documents; the row after the last is padding of weight 0.
    """
    size = len(target)
    flat, weight, target = rows.ravel(), np.append(weight, 0.0), np.append(target, 0.0)
    times = lambda x: np.bincount(flat, np.repeat(x, rows.shape[1]), size + 1) * weight
    back = lambda r: (weight * r)[rows].sum(axis=1)
    x = np.ones(len(rows))
    for _ in range(20):
        x = back(times(x))
        norm = np.linalg.norm(x)
        x /= norm
    rate = 0.9 / norm
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - rate * back(times(y) - target))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def patterns(counts: dict[int, int], capacity: int, width: int = 4) -> list[tuple[int, ...]]:
    """Fillings of few documents: for each length and each of a spread of partners, the longest lengths that still fit."""
    lengths = sorted(counts)
    found = {}
    for first in lengths:
        partners = [x for x in lengths if x <= capacity - first]
        picks = {partners[int(q * (len(partners) - 1))] for q in (0, 0.25, 0.5, 0.75, 1)} if partners else set()
        for second in [None, *sorted(picks)]:
            chosen = [first] if second is None else [first, second]
            while len(chosen) < width:
                k = bisect_right(lengths, capacity - sum(chosen))
                if not k:
                    break
                chosen.append(lengths[k - 1])
            if sum(chosen) <= capacity:
                found[tuple(sorted(chosen, reverse=True))] = None
    return list(found)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often) over a histogram of lengths, using up every piece.

    Works on counts alone: the cost depends on `capacity`, not on the number of pieces. Patterns that fill a
    sequence well get whole repeat counts from a least squares fit of the histogram, rounded down; the rest
    goes, longest first, where it fits best.
    """
    left = Counter({n: c for n, c in counts.items() if c})
    out: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        out.append(((capacity,), left.pop(capacity)))
    for _ in range(3):  # what rounding leaves is fitted again
        full = [p for p in patterns(left, capacity) if sum(p) == capacity]
        if len(full) < 2:
            break
        place = {n: i for i, n in enumerate(sorted(left))}
        width = max(map(len, full))
        rows = np.array([[place[n] for n in p] + [len(place)] * (width - len(p)) for p in full])
        have = np.array([left[n] for n in place], float)
        weight = have**-0.5  # small counts matter as much as large ones
        fit = nnls(rows, weight, have * weight)
        before = sum(left.values())
        for j in np.argsort(-fit):
            need = Counter(full[j])
            times = min(int(fit[j]), *(left[n] // k for n, k in need.items()))
            if times > 0:
                out.append((full[j], times))
                for n, k in need.items():
                    left[n] -= k * times
                    if not left[n]:
                        del left[n]
        if sum(left.values()) > 0.9 * before:
            break
    return out + best_fit(left, capacity)


def best_fit(left: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first into the fullest sequence with room, whole runs of equal sequences at a time."""
    open_: dict[int, list[list]] = {}  # room -> [[lengths], how many]
    rooms: list[int] = []

    def put(room: int, lengths: list[int], n: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append([lengths, n])

    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            at = bisect_right(rooms, n - 1)
            if at == len(rooms):
                each = capacity // n
                if count >= each:
                    put(capacity - each * n, [n] * each, count // each)
                if count % each:
                    put(capacity - count % each * n, [n] * (count % each), 1)
                break
            room = rooms[at]
            lengths, many = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
            used = min(many, count)
            put(room - n, [*lengths, n], used)
            if many > used:
                put(room, lengths, many - used)
            count -= used
    return [(tuple(lengths), n) for rows in open_.values() for lengths, n in rows]


def ranked(rows: DataFrame, key: list[str], group: str) -> DataFrame:
    """`rows` with __rank, 0, 1, ... within `group`, which may hold any share of the rows.

    Rows are dealt to blocks by a hash of `key`; ranks within a (group, block) are shifted by the counts of
    the group's blocks before. Counts come from a combined aggregation, so no task needs a whole group.
    """
    blocks = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("__block", F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int"))
    sizes = rows.groupBy(group, "__block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(group, "__block", before.alias("__shift"))
    own = F.row_number().over(Window.partitionBy(group, "__block").orderBy(*key)) - 1
    return rows.withColumn("__rank", own).join(sizes, [group, "__block"]).withColumn("__rank", F.col("__rank") + F.col("__shift")).drop("__shift", "__block")


def pack(parts: DataFrame, *, capacity: int = 2048, key: str = "doc_id") -> DataFrame:
    """`parts` (`key`, piece, length, ...) with sequence_id and offset; sequences hold at most `capacity`, without gaps.

    The histogram of lengths (at most `capacity` numbers) is all that the driver sees. Its plan says which ranks
    of a length go to which run of sequences; pieces of a length are ranked without gathering them.
    Pieces longer than `capacity` are refused. Columns of `parts` with the names added here are replaced.
    """
    parts = parts.drop("sequence_id", "offset")
    counts = {int(n): int(c) for n, c in parts.groupBy("length").agg(F.count("*")).collect()}
    if counts and max(counts) > capacity:
        raise ValueError("a piece is longer than a sequence")
    taken: Counter = Counter()
    slots, sequence = [], 0
    for lengths, times in plan(counts, capacity):
        offset = 0
        for n in lengths:
            slots.append((n, taken[n], taken[n] + times, sequence - taken[n], offset))
            taken[n] += times
            offset += n
        sequence += times
    spark = parts.sparkSession
    # One row per length and pattern: its size is set by `capacity` and the number of patterns, not by the data.
    slot = spark.createDataFrame(slots, "length long, __from long, __to long, __shift long, offset long")
    per_length = slot.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("__from", "__to", "__shift", "offset"))).alias("__slots"))
    rows = ranked(parts, [key, "piece"], "length").join(F.broadcast(per_length), "length")
    hit = F.element_at(F.filter("__slots", lambda s: (s["__from"] <= F.col("__rank")) & (F.col("__rank") < s["__to"])), 1)
    return rows.withColumn("__slot", hit).select(
        *parts.columns, (F.col("__rank") + F.col("__slot.__shift")).alias("sequence_id"), F.col("__slot.offset").alias("offset")
    )


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenises once, keeps the pieces (not the ids) in the shared folder, and packs them."""
    return pack(written(pieces(docs, tokenizer, capacity=capacity, key=key, text=text), "pieces"), capacity=capacity, key=key)
