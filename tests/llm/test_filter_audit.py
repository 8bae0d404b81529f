"""The filter audit against a plain simulation of every order."""

import random
from itertools import permutations

from checking import connect, differences
from conftest import ODD

from pulsegrid.llm import queries
from pulsegrid.llm.filter_audit import audit_filters, mask_counts, text_mask

ORDERS = ["".join(p) for p in permutations("ABCDE")]


def simulated(rows, labels):
    """Rows are (doc_id, text, lang); applies the five filters in each order, document by document."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        fails = {f for k, f in enumerate("ABCD") if text_mask(t or "") >> k & 1}
        if i is not None and first[t or ""] < i:
            fails.add("E")
        docs.append((lang or "", fails, i in good, i in toxic))
    out = set()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        removed_by = {(o, f): 0 for o in ORDERS for f in "ABCDE"}
        lines = []
        for order in ORDERS:
            left = own
            for step, f in enumerate(order, 1):
                gone, rest = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                fails = sum(f in d[1] for d in own)
                removed_by[order, f] = len(gone)
                lines.append((order, step, f, len(rest), len(gone), fails - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
                left = rest
        for order, step, f, *counts in lines:
            out.add((part, order, step, *counts, sum(removed_by[o, f] for o in ORDERS)))
    return out


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return [tuple(r) for r in audit_filters(mask_counts(docs, known)).collect()]


def test_text_mask():
    fine = " ".join(f"w{i}" for i in range(100))
    assert text_mask(fine) == 0
    assert text_mask(fine.rsplit(" ", 1)[0]) == 1
    assert text_mask("a " * 100) == 2
    assert text_mask(fine + " #") == 8
    assert text_mask(" ".join(f"WORD{i}" for i in range(100))) == 4
    assert text_mask("") == 1
    assert text_mask(" ".join("abc")) == 1  # only ASCII white space ends a word


def test_equal_to_simulation_with_nulls_ties_and_copies(spark):
    rng = random.Random(4)
    texts = [*ODD, " ".join(f"w{i}" for i in range(120)), " ".join(f"W{i} #" for i in range(120)), "same words " * 90]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    rows += rows[:20]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(40)] + [(None, 1, 1), (3, 1, 0), (3, 0, 1)]
    found = audited(spark, rows, labels)
    assert len(found) == len(set(found))
    assert set(found) == simulated(rows, labels)


def test_empty_tables_and_clashing_columns(spark):
    assert audited(spark, [], []) == []
    docs = spark.createDataFrame([(1, "a", "en", 5, "x"), (2, "a", "en", 6, "y")], "doc_id long, text string, lang string, n int, part string")
    labels = spark.createDataFrame([(1, 1, 0, "z")], "doc_id long, quality int, toxic int, mask string")
    rows = audit_filters(mask_counts(docs, labels)).where("filter_order = 'EABCD' AND step = 1").collect()
    assert [(r.part, r.kept, r.removed, r.good_lost) for r in rows] == [("en", 1, 1, 0)]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    ours = queries.QUERIES["op13_filter_audit"](spark, sf).toPandas()
    theirs = connect(sf).execute(queries.ORACLES["op13_filter_audit"]).df()
    assert len(ours) and not differences(ours, theirs)
