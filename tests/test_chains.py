"""Greedy chains against a loop over sorted times."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pulsegrid.operators.chains import block_steps, mark_chain, whole_runs


def loop(times, ttl):
    taken = []
    for t in sorted(times):
        if not taken or t - taken[-1] >= ttl:
            taken.append(t)
    return taken


def chains(spark, rows, ttl, periods):
    df = spark.createDataFrame(rows, "k string, j int, t bigint, tag string")
    marked = mark_chain(df, ["k", "j"], "t", ttl, periods).collect()
    assert sorted((r.k or "", r.t, r.tag) for r in marked) == sorted((r[0] or "", r[2], r[3]) for r in rows)
    out = {}
    for r in marked:
        if r._taken:
            out.setdefault((r.k, r.j), []).append(r.t)
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("periods", [1, 2, 16])
@pytest.mark.parametrize("ttl", [1, 7, 100])
def test_random_keys_against_a_loop(spark, ttl, periods):
    rng = random.Random(ttl * periods)
    own = {}
    for i in range(60):
        span = rng.choice([3, 50, 2000, 10**6])
        own[rng.choice(["a", "b", None, ""]), i] = set(rng.sample(range(-span, span), min(2 * span, rng.choice([1, 2, 5, 400]))))
    own["hot", 0] = set(range(-3000, 9000, 3)) | set(range(20_000, 24_000, ttl))
    rows = [(k, j, t, f"x{t}") for (k, j), ts in own.items() for t in ts]
    assert chains(spark, rows, ttl, periods) == {k: loop(ts, ttl) for k, ts in own.items()}


def test_no_rows(spark):
    assert chains(spark, [], 5, 16) == {}


def test_a_rule_with_a_million_window_ends(spark):
    n = 1_000_000
    df = spark.range(n).selectExpr("'r' AS k", "id * 60000 + (id % 7) * 1000 AS t")
    marked = mark_chain(df, ["k"], "t", 300_000)
    got = sorted(r.t for r in marked.where("_taken").select("t").collect())
    assert got == loop([i * 60_000 + i % 7 * 1000 for i in range(n)], 300_000)


def test_steps_of_a_block_by_trial():
    rng = np.random.default_rng(5)
    for _ in range(200):
        ttl = int(rng.integers(1, 30))
        times = np.unique(rng.integers(100, 100 + 8 * ttl, rng.integers(1, 60)))
        until, free = block_steps(times, 100, 100 + 8 * ttl, ttl)
        assert (np.diff(until) > 0).all() and (np.diff(free) != 0).all()
        for at in range(100 - ttl, 100 + ttl):
            want = at
            for t in times.tolist():
                if t >= want:
                    want = t + ttl
            i = int(np.searchsorted(until, at))
            assert max(want, 100 + 8 * ttl) == (int(free[i]) if i < len(until) else max(at, 100 + 8 * ttl))


def test_runs_are_never_cut():
    rng = random.Random(9)
    names = sorted(rng.choice("abcdefgh") for _ in range(300)) + ["z"] * 50
    values = [None if n == "h" else n for n in names]
    for size in (1, 7, 64, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(values[i : i + size], pa.string())], ["n"]) for i in range(0, len(values), size)]
        seen = []
        for batch, bounds in whole_runs(iter(batches), ["n"]):
            column = batch.column("n").to_pylist()
            assert bounds[0] == 0 and bounds[-1] == len(column)
            for a, b in zip(bounds, bounds[1:], strict=False):
                assert len(set(column[a:b])) == 1
                seen.append((column[a], b - a))
        assert [s[0] for s in seen] == list(dict.fromkeys(values)) and sum(s[1] for s in seen) == len(values)
