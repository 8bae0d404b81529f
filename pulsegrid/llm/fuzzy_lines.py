"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard, one line kept per component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import SPACES, texts_of, written
from pulsegrid.llm.minhash import Layout, clustered

SHINGLE = 8  # characters
# 13 bands of four 16-bit minhashes: a pair at 0.8 shares no band once in a thousand.
LINES = Layout(groups=13, per_group=4, dtype="u2", least_equal=28)
ENTRIES = 1 << 19  # band entries that one task sorts at a time
CHUNK = 1 << 16  # characters hashed at a time, so that arrays stay in a core's cache
_RNG = np.random.default_rng(31)
_MUL = (_RNG.integers(0, 2**32, LINES.hashes, dtype=np.uint64) | 1).astype(np.uint32)
_M = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def line_ids(lines: list[str]) -> np.ndarray:
    """64-bit hashes of whole lines, as signed numbers."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines)).view(np.int64)


def lines_of(text: str) -> list[tuple[int, str]]:
    """(position, line without outer ASCII white space) of every line that is not blank."""
    return [(i, s) for i, line in enumerate(text.split("\n")) if (s := line.strip(SPACES))]


def shingles(line: str) -> set[str]:
    """Distinct runs of eight characters; a shorter line is one shingle."""
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def packed_shingles(line: str) -> tuple[np.ndarray, frozenset]:
    """`shingles`: runs of eight code points below 256 as sorted distinct numbers of their eight bytes, other ones as they are."""
    if len(line) < SHINGLE:
        return np.empty(0, np.uint64), frozenset([line])
    if line.isascii():
        narrow, rest = line.encode(), frozenset()
        runs = np.ndarray((len(line) - SHINGLE + 1,), "<u8", narrow, 0, (1,))
    else:
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")
        wide = np.concatenate([[0], np.cumsum(points > 255)])
        wide = wide[SHINGLE:] != wide[:-SHINGLE]
        runs = np.ndarray((len(wide),), "<u8", points.astype(np.uint8).tobytes(), 0, (1,))[~wide]
        rest = frozenset(line[i : i + SHINGLE] for i in np.flatnonzero(wide).tolist())
    runs = np.sort(runs)
    return runs[np.concatenate([[True], runs[1:] != runs[:-1]])] if len(runs) else runs, rest


def signatures(lines: list[str]) -> np.ndarray:
    """One row of 52 16-bit minhashes per line, over all its shingles."""
    out = np.empty((len(lines), LINES.hashes), np.uint32)
    start = 0
    while start < len(lines):
        stop, size = start, 0
        while stop < len(lines) and (stop == start or size + len(lines[stop]) < CHUNK):
            size += max(SHINGLE, len(lines[stop])) + 1
            stop += 1
        part = [line if len(line) >= SHINGLE else line.ljust(SHINGLE, "\x00") for line in lines[start:stop]]
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        c = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32, copy=False)
        h = c[:-1] * _M[0] + c[1:]
        h = h[:-2] * _M[1] + h[2:]
        h = h[:-4] * _M[2] + h[4:]  # eight characters
        h ^= h >> np.uint32(15)
        h *= _M[3]
        h ^= h >> np.uint32(13)
        h *= _M[0]
        h ^= h >> np.uint32(16)
        begin = np.cumsum(lengths) - lengths
        end = begin + lengths - SHINGLE + 1
        bounds = np.stack([begin, end], axis=1).ravel()
        if bounds[-1] >= len(h):
            bounds = bounds[:-1]  # the last line runs to the end
        values = np.empty_like(h)
        for k in range(LINES.hashes):
            np.multiply(h, _MUL[k], out=values)
            out[start:stop, k] = np.minimum.reduceat(values, bounds)[::2]
        start = stop
    # minima are small numbers, so their high bits say little: mix before cutting to 16 bits
    out ^= out >> np.uint32(16)
    out *= _M[2]
    return (out >> np.uint32(16)).astype("<u2")


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__hash"), F.col(text).alias("__text"))


def _binary(sigs: np.ndarray) -> pa.Array:
    """The rows of a table of numbers as binary values."""
    size = sigs.shape[1] * sigs.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(sigs), [None, pa.py_buffer(np.ascontiguousarray(sigs))]).cast(pa.binary())


def signed_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(__key, __hash, pos, id, sig) of every line that is not blank; sig is null where a line repeats one of the same batch."""
    rows = _lines(docs, key, text)
    kind = rows.schema["__key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                owner, places, lines = [], [], []
                for i, t in enumerate(texts_of(part, "__text")):
                    for pos, line in lines_of(t):
                        owner.append(i)
                        places.append(pos)
                        lines.append(line)
                ids, new = line_ids(lines), []
                for i, k in enumerate(ids.tolist()):
                    if k not in seen:
                        seen.add(k)
                        new.append(i)
                row = np.zeros(len(lines), np.int64)
                row[new] = np.arange(len(new))
                repeats = np.ones(len(lines), bool)
                repeats[new] = False
                source, row = pa.array(owner, pa.int64()), pa.array(row, mask=repeats)
                arrays = [part.column("__key").take(source), part.column("__hash").take(source), pa.array(places, pa.int32()),
                          pa.array(ids), _binary(signatures([lines[i] for i in new])).take(row)]
                yield pa.RecordBatch.from_arrays(arrays, ["__key", "__hash", "pos", "id", "sig"])

    return rows.mapInArrow(run, f"__key {kind}, __hash long, pos int, id long, sig binary")


def _shared(entry: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of entries that two or more ids have, sorted, each once."""
    order = np.argsort(entry)
    same = np.concatenate([[False], entry[order[1:]] == entry[order[:-1]], [False]])
    order = order[same[1:] | same[:-1]]
    order = order[np.lexsort((ids[order], entry[order]))]
    entry, ids = entry[order], ids[order]
    new = np.ones(len(entry), bool)
    new[1:] = (entry[1:] != entry[:-1]) | (ids[1:] != ids[:-1])
    entry, ids = entry[new], ids[new]
    same = np.concatenate([[False], entry[1:] == entry[:-1], [False]])
    several = (same[1:] | same[:-1])[: len(entry)]
    return entry[several], ids[several]


def shared_entries(lines: DataFrame) -> DataFrame:
    """(id, pair, entry): the bands (pair) of signatures and their hashes (entry) that two or more ids share, each once per id.

    The low four bits of an entry are its band. Entries are shuffled by parts of about `ENTRIES`, packed in a row per part
    and batch; a task sorts one part at a time, whose rows (16 bytes each) it holds.
    """
    signed = lines.where("sig IS NOT NULL").select("id", "sig")
    parts = max(1, LINES.groups * signed.count() // ENTRIES)

    def packed(entry: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        part = (entry.view(np.uint64) >> np.uint64(20)) % np.uint64(parts)
        order = np.argsort(part)
        part = part[order].view(np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        offsets = pa.py_buffer((8 * np.append(cuts, len(part))).astype(np.int32))
        rows = [pa.Array.from_buffers(pa.binary(), len(cuts), [None, offsets, pa.py_buffer(a[order])]) for a in (entry, ids)]
        return pa.RecordBatch.from_arrays([pa.array(part[cuts]), *rows], ["part", "entry", "ids"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, ids, size = [], [], 0
        for batch in batches:
            bands = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u8").reshape(-1, LINES.groups)
            h = bands * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            entries.append(((h << np.uint64(4)) | np.arange(LINES.groups, dtype=np.uint64)).view(np.int64).ravel())
            ids.append(np.repeat(batch.column("id").to_numpy(), LINES.groups))
            size += h.size
            if size >= ENTRIES:
                yield packed(np.concatenate(entries), np.concatenate(ids))
                entries, ids, size = [], [], 0
        if size:
            yield packed(np.concatenate(entries), np.concatenate(ids))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> pa.RecordBatch:
            entry, own = _shared(*(np.frombuffer(b"".join(x), np.int64) for x in (entries, ids)))
            return pa.RecordBatch.from_arrays([pa.array(own), pa.array((entry & 15).astype(np.int32)), pa.array(entry)], ["id", "pair", "entry"])

        held, entries, ids = None, [], []
        for batch in batches:
            for part, e, i in zip(*(batch.column(c).to_pylist() for c in ("part", "entry", "ids")), strict=True):
                if part != held and entries:
                    yield found()
                    entries, ids = [], []
                held = part
                entries.append(e)
                ids.append(i)
        if entries:
            yield found()

    rows = signed.mapInArrow(deal, "part long, entry binary, ids binary")
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(meet, "id long, pair int, entry long")


def bloom(ids: DataFrame, count: int, most_bits: int = 1 << 27) -> np.ndarray:
    """A bit table of the longs in `ids`, of at most `most_bits`: it lets most other ids be left out early, never one of these."""
    bits = 1 << max(16, min(most_bits.bit_length() - 1, (16 * count).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _places(batch.column("id").to_numpy(), bits):
                np.bitwise_or.at(table, place >> 3, (1 << (place & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], ["t"])

    out = np.zeros(bits // 8, np.uint8)
    for row in ids.select("id").coalesce(8).mapInArrow(run, "t binary").toLocalIterator():
        out |= np.frombuffer(row["t"], np.uint8)
    return out


def _places(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    u = ids.view(np.uint64)
    return [((u >> np.uint64(s)) & np.uint64(bits - 1)).astype(np.int64) for s in (3, 29)]


def line_texts(docs: DataFrame, ids: DataFrame, key: str, text: str) -> DataFrame:
    """(id, line, n_shingles, sig), one row for each of the `ids`; lines of other ids are left out before any shuffle."""
    table = docs.sparkSession.sparkContext.broadcast(bloom(ids, ids.count()))  # at most 16 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = table.value, len(table.value) * 8
        for batch in batches:
            found = {}
            texts = texts_of(batch, "__text")
            for at in range(0, len(texts), 1024):
                lines = [line for t in texts[at : at + 1024] for _, line in lines_of(t)]
                own = line_ids(lines)
                hit = np.ones(len(own), bool)
                for place in _places(own, bits):
                    hit &= (known[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                found.update((int(own[i]), lines[i]) for i in np.flatnonzero(hit))
            lines = list(found.values())
            sizes = [sum(map(len, packed_shingles(x))) for x in lines]
            arrays = [pa.array(found.keys(), pa.int64()), pa.array(lines, pa.string()), pa.array(sizes, pa.int64()), _binary(signatures(lines))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "line", "n_shingles", "sig"])

    found = _lines(docs, key, text).mapInArrow(run, "id long, line string, n_shingles long, sig binary")
    return found.join(ids, "id").dropDuplicates(["id"])


def duplicate_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """(__key, __hash, dropped): for documents with lines to drop, their positions in text order.

    Lines are compared without outer white space; blank lines are neither dropped nor compared. Two lines are
    linked if they are equal or 100 * common shingles of eight characters >= percent * all of theirs. Of the
    lines that links connect, across and within documents, the first one by key and position stays. Documents
    with a null key take no part; rows that repeat a key and text are one document (__hash is of the text).
    """
    lines = written(signed_lines(docs, key, text), "lines")
    entries = written(shared_entries(lines), "bands")
    ids = written(entries.select("id").distinct(), "candidates")
    heads = written(line_texts(docs, ids, key, text), "heads")
    contents = lambda wanted: heads.select("id", F.col("line").alias("content")).join(wanted, "id", "left_semi")
    known = clustered(entries, entries, heads.select("id", "n_shingles", "sig"), contents, lambda x: packed_shingles(x.as_py()), percent, LINES)
    found = lines.select("__key", "__hash", "pos", "id").join(known, F.col("id") == F.col("node"), "left")
    found = written(found.select("__key", "__hash", "pos", F.coalesce("root", "id").alias("root")), "roots")
    place = F.struct("__key", "__hash", "pos")
    first = found.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("root", "first")
    gone = found.join(first, "root").where(place != F.col("first"))
    return gone.groupBy("__key", "__hash").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80, empty: bool = True) -> DataFrame:
    """`docs` with its text freed of duplicate lines, all columns and their order unchanged.

    See `duplicate_lines`. The lines that stay are joined by line feeds as they were; null texts stay null. With
    `empty` false, documents go whose lines were all dropped as duplicates; texts without any line stay.
    """
    gone = written(duplicate_lines(docs, key=key, text=text, percent=percent), "dropped")
    same = (docs[key] == gone["__key"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == gone["__hash"])
    dropped = gone["dropped"]
    left = F.filter(F.split(docs[text], "\n"), lambda _, i: ~F.array_contains(dropped, i))
    clean = F.when(dropped.isNull(), docs[text]).otherwise(F.array_join(left, "\n"))
    joined = docs.join(gone, same, "left")
    if not empty:
        joined = joined.where(dropped.isNull() | clean.rlike(r"[^\x20\x09-\x0D]"))
    return joined.select(*(clean.alias(c) if c == text else docs[c] for c in docs.columns))
