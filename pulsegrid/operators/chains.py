"""Greedy chains in time: of a key's moments, the first, and then each that comes a period or more after the last one taken.

Deduplication with a time to live and alert cooldown are both this rule. It looks sequential, but a stretch of time acts
on it like a function: from the moment at which the key is free again when the stretch begins, to the one when it ends.
Chains that meet stay together, so a few steps describe it.

1. Time is cut into blocks of some periods. Each (key, block) finds its function from its own moments alone.
2. Per key, the functions are applied one after the other. Only steps of functions pass here, in a stream that keeps one
   number per key: what a key holds in memory does not depend on its rows.
3. Each (key, block) follows the one chain that really enters it.

So a key with a third of all rows is dealt to as many tasks as it has blocks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERIODS = 16  # periods to a block
NEVER = -(2**63)


def starts_of_runs(batch: pa.RecordBatch, by: list[str]) -> np.ndarray:
    """Whether each row differs from the one before it in a column of `by`; nulls are equal. The first row does."""
    out = np.ones(batch.num_rows, bool)
    if batch.num_rows > 1:
        differs = np.zeros(batch.num_rows - 1, bool)
        for c in by:
            a, b = batch.column(c).slice(1), batch.column(c).slice(0, batch.num_rows - 1)
            unequal = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
            differs |= unequal.to_numpy(zero_copy_only=False)
        out[1:] = differs
    return out


def whole_runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of sorted rows dealt anew so that no run of equal `by` is cut, with the places where runs begin and the end."""
    held: list[pa.RecordBatch] = []  # rows of the run that is still open
    for batch in chain(batches, [None]):
        if batch is None:
            if held:
                done = _joined(held)
                yield done, [0, done.num_rows]
        elif batch.num_rows:
            begins = np.flatnonzero(starts_of_runs(batch, by)).tolist()
            if held and not starts_of_runs(_joined([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)]), by)[1]:
                begins = begins[1:]  # the open run goes on
            if not begins:
                held.append(batch)
                continue
            if held or begins[0]:
                done = _joined([*held, batch.slice(0, begins[0])])
                yield done, [0, done.num_rows]
            if len(begins) > 1:
                yield batch.slice(begins[0], begins[-1] - begins[0]), [x - begins[0] for x in begins]
            held = [batch.slice(begins[-1])]


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def block_steps(times: np.ndarray, start: int, end: int, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """The function of the block from `start` to `end`, from its sorted times: (until, free).

    A key that is free at or before until[i] (and after until[i - 1]) is free again at free[i] when the block is over,
    which is `end` for all that are free by then; one that is free only after the last of `until` takes nothing here.
    """
    following = np.append(np.searchsorted(times, times + ttl), len(times))
    # whoever took before the block is free less than a period after its start
    entries = np.arange(min(int(np.searchsorted(times, start + ttl)) + 1, len(times)))
    at = entries
    while len(moved := np.flatnonzero(following[at] < len(times))):
        at = at.copy()
        at[moved] = following[at[moved]]
    free = np.maximum(times[at] + ttl, end)
    last = np.append(free[1:] != free[:-1], True)
    return times[entries[last]], free[last]


def mark_chain(moments: DataFrame, keys: list[str], ts: str, ttl_ms: int, periods: int = PERIODS) -> DataFrame:
    """`moments` with `_taken`: whether the greedy chain of its key takes a row; other columns are carried along.

    Rows must be distinct by (keys, ts), and ts not null. Null keys are a key like any other.
    """
    columns, kinds = moments.columns, dict(moments.dtypes)
    block_ms = ttl_ms * periods
    own = moments.withColumn("_block", F.expr(f"({ts} - pmod({ts}, {block_ms}L)) div {block_ms}L"))
    group = [*keys, "_block"]
    key_kinds = ", ".join(f"`{k}` {kinds[k]}" for k in keys)

    def functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in whole_runs(batches, group):
            times, blocks = batch.column(ts).to_numpy(), batch.column("_block").to_numpy()
            source, until, free = [], [], []
            for a, b in zip(bounds, bounds[1:], strict=False):
                if b - a == 1:
                    u, f = times[a:b], times[a:b] + ttl_ms
                else:
                    u, f = block_steps(times[a:b], int(blocks[a]) * block_ms, (int(blocks[a]) + 1) * block_ms, ttl_ms)
                source.append(np.full(len(u), a))
                until.append(u)
                free.append(f)
            rows = pa.array(np.concatenate(source))
            arrays = [*(batch.column(c).take(rows) for c in group), pa.array(np.concatenate(until)), pa.array(np.concatenate(free))]
            yield pa.RecordBatch.from_arrays(arrays, [*group, "_until", "_free"])

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, free, block = None, NEVER, None
        for batch in batches:
            names = zip(*(batch.column(k).to_pylist() for k in keys), strict=True)
            found, entered = [], []
            for i, (name, b, until, after) in enumerate(zip(names, *(batch.column(c).to_pylist() for c in ("_block", "_until", "_free")), strict=True)):
                if name != key:
                    key, free, block = name, NEVER, None
                if b != block and until >= free:  # the first step that is not too early is the block's
                    found.append(i)
                    entered.append(free)
                    free, block = after, b
            rows = pa.array(found, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in group), pa.array(entered, pa.int64())], [*group, "_from"])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in whole_runs(batches, group):
            times = memoryview(np.ascontiguousarray(pc.fill_null(batch.column(ts), 0).to_numpy()))
            enters, taken = batch.column("_from").to_pylist(), np.zeros(batch.num_rows, bool)
            for a, b in zip(bounds, bounds[1:], strict=False):
                if enters[a] is not None:
                    i = bisect_left(times, enters[a], a + 1, b)
                    while i < b:
                        taken[i] = True
                        i = bisect_left(times, times[i] + ttl_ms, i + 1, b)
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(taken)], [*columns, "_taken"])
            yield out.filter(pc.is_null(batch.column("_from")))

    # All columns go both ways, so that both readers of `moments` share what it shuffles.
    dealt = own.repartition(*group).sortWithinPartitions(*group, ts)
    steps = dealt.mapInArrow(functions, f"{key_kinds}, _block bigint, _until bigint, _free bigint")
    entries = steps.repartition(*keys).sortWithinPartitions(*group, "_until").mapInArrow(applied, f"{key_kinds}, _block bigint, _from bigint")
    both = own.withColumn("_from", F.lit(None).cast("bigint")).unionByName(entries, allowMissingColumns=True)
    both = both.select(*columns, "_block", "_from").repartition(*group).sortWithinPartitions(*group, F.col("_from").desc_nulls_last(), ts)
    return both.mapInArrow(walked, ", ".join(f"`{c}` {k}" for c, k in moments.dtypes) + ", _taken boolean")
