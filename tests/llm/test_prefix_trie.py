"""The trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
from checking import connect, differences

from pulsegrid.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def by_dictionary(rebuilt):
    """rebuilt: {conv: [(role, text), ...]}"""
    members, out = {}, set()
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node, own in members.items():
        below = [p for p in members if p[: len(node)] == node]
        children = [p for p in members if len(p) == len(node) + 1 and p[:-1] == node]
        leaves = [p for p in below if not any(q[:-1] == p for q in members if q)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(own) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(own), len(node), parent, len(own), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt_from(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def nodes(spark, rows):
    return [tuple(r) for r in prefix_trie.trie_nodes(queries.shared_starts(spark.createDataFrame(rows, SCHEMA))).collect()]


def conversations(seed, n, depth=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        first = rng.randrange(2) if rng.random() < 0.8 else None
        for t in range(rng.randrange(1, depth)):
            rows.append((c, t if t or rng.random() < 0.9 else None, rng.choice(["u", "a", None, ""]), rng.choice(["", None, "hi", "hé", "long " * 50])))
            if t == 0 and first is not None:
                rows[-1] = (c, 0, "u", f"start {first}")
    return rows


def test_equal_to_a_dictionary(spark):
    rows = conversations(1, 300)
    found = nodes(spark, rows)
    assert len(found) == len(set(found))
    assert set(found) == by_dictionary(rebuilt_from(rows))


def test_small_blocks_copies_and_one_block(spark, monkeypatch):
    rows = conversations(2, 60) + [(1000 + i, t, "u", "the same") for i in range(400) for t in range(9)] + [(None, 0, "u", "x")]
    want = by_dictionary(rebuilt_from(rows))
    for size in (1, 3, 10**6):
        monkeypatch.setattr(prefix_trie, "BLOCK", size)
        assert set(nodes(spark, rows)) == want


def test_empty_table_empty_conversations_and_clashing_columns(spark):
    assert nodes(spark, []) == []
    c = next(c for c in range(6, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 3)
    assert nodes(spark, [(c, 0, "u", "gone")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    rows = spark.createDataFrame([(0, 0, "u", "a", 7, "k"), (0, 0, "u", "a", 8, "k")], SCHEMA + ", id int, keys string")
    assert sorted((r.depth, r.n_convs) for r in prefix_trie.trie_nodes(prefix_trie.turn_sequences(rows)).collect()) == [(0, 1), (1, 1), (2, 1)]


def test_long_conversation(spark):
    rows = [(0, t, "u", f"turn {t}") for t in range(3000)] + [(5, t, "u", f"turn {t}" if t < 2000 else "other") for t in range(2500)]
    found = {(r.conv_id, r.depth): r for r in prefix_trie.trie_nodes(prefix_trie.turn_sequences(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert len(found) == 1 + 3000 + 500
    assert found[0, 2000].n_children == 2 and found[0, 2000].n_leaves == 2 and found[0, 0].n_convs == 2


def test_range_minima_by_hand():
    rng = np.random.default_rng(3)
    values = rng.integers(-1, 5, 200)
    table = prefix_trie.Minima(values)
    left = rng.integers(0, 200, 500)
    right = np.minimum(199, left + rng.integers(0, 60, 500))
    assert table.between(left, right).tolist() == [int(values[a : b + 1].min()) for a, b in zip(left, right, strict=True)]
    for at, depth in zip(left, rng.integers(0, 5, 500), strict=True):
        low, high = at, at
        while low > 0 and values[low] >= depth:
            low -= 1
        while high < 199 and values[high + 1] >= depth:
            high += 1
        one = np.array([at]), np.array([depth])
        assert (table.left_ends(*one)[0], table.right_ends(*one)[0]) == (low, high)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    ours = queries.QUERIES["op12_prefix_trie"](spark, sf).toPandas()
    theirs = connect(sf).execute(queries.ORACLES["op12_prefix_trie"]).df()
    for side in (ours, theirs):  # the root's null makes one side floating point
        side["parent_conv_id"] = side["parent_conv_id"].fillna(-1).astype("int64")
    assert len(ours) and not differences(ours, theirs)
