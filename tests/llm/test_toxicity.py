"""Class-conditional Kneser-Ney models: counts and ratios by hand, planted words and stems, odd rows."""

import random
import zlib
from collections import Counter
from math import log

import pytest
from conftest import ODD

from pulsegrid.llm import toxicity


def ratios_by_hand(texts):
    """Ratio of every seen gram, from plain counters; nothing is left out of the model."""
    counts = Counter((y, g) for t, y in texts for w in t.lower().split() for g in toxicity.grams(w))
    tops = {g for _, g in counts}
    history = Counter()
    for (y, g), n in counts.items():
        history[y, g[:-1]] += n
    kinds, d = Counter((y, g[:-1]) for y, g in counts), toxicity.DISCOUNT
    types, lower = {g for g in tops if len(g) == toxicity.ORDER}, {}
    for k in range(toxicity.ORDER - 1, 0, -1):
        lower[k] = Counter(g[1:] for g in types)
        types = set(lower[k]) | {g for g in tops if len(g) == k and g[0] == " "}

    def shared(g):
        if not g:
            return 1 / (len(lower[1]) + 1)
        after = {x: n for x, n in lower[len(g)].items() if x[:-1] == g[:-1]}
        if not after:
            return shared(g[1:])
        return (max(after.get(g, 0) - d, 0) + d * len(after) * shared(g[1:])) / sum(after.values())

    def p(y, g):
        n = history[y, g[:-1]]
        return (max(counts[y, g] - d, 0) + d * kinds[y, g[:-1]] * shared(g[1:])) / n if n else shared(g[1:])

    return {g: log(p(1, g) / p(0, g)) for g in tops}


def test_grams_of_a_word():
    assert toxicity.grams("ab") == [" a", " ab", " ab "]
    assert toxicity.grams("abcdef") == [" a", " ab", " abc", " abcd", " abcde", "abcdef", "bcdef "]


def test_ratios_equal_plain_counters(spark, prose):
    texts = [(prose(12, i), i % 2) for i in range(8)] + [("idiot Idiots", 1), ("", 0), (None, 1)]
    rows = spark.createDataFrame(texts, "text string, y int")
    model = toxicity.kneser_ney(toxicity.model_tables(toxicity.count_grams(rows)))
    want = ratios_by_hand([(t or "", y) for t, y in texts])
    assert model.ratio.keys() == want.keys()
    assert model.ratio == pytest.approx(want)


def test_grams_that_are_rare_among_many_have_ratios(spark):
    texts = [("the " * 200_000, 0), ("the zorp", 1), ("thin zorn", 0)]
    model = toxicity.kneser_ney(toxicity.model_tables(toxicity.count_grams(spark.createDataFrame(texts, "text string, y int"))))
    want = ratios_by_hand(texts)
    assert model.ratio.keys() == want.keys() and model.ratio == pytest.approx(want)
    words = ["the", "zorp", "thx", "q", "zornq"]
    unseen = {g[:-1]: 0.0 for w in words for g in toxicity.grams(w)} | {r.gram: r.value for r in model.entries.where("history").collect()}
    assert model.near.words(words).tolist() == pytest.approx([sum(want.get(g, unseen[g[:-1]]) for g in toxicity.grams(w)) for w in words])


def planted(prose, n):
    rng = random.Random(8)
    texts, toxic = [], []
    for i in range(n):
        words = prose(rng.randrange(8, 120), i).split()
        toxic.append(int(rng.random() < 0.25))
        if toxic[-1]:
            for _ in range(1 + len(words) // 30):
                words.insert(rng.randrange(len(words)), rng.choice(["Blockhead", "zorp" + rng.choice("a e i o u en ung ier os".split()) + rng.choice("stmnr")]))
        texts.append(" ".join(words))
    return texts, toxic


def test_planted_words_and_stems_are_caught(spark, docs_of, prose):
    texts, toxic = planted(prose, 900)
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic) if i < 600], "doc_id long, toxic int")
    docs = docs_of(texts)
    model = toxicity.fit_toxicity(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model, keep=["doc_id"]).where("doc_id >= 600").collect()}
    right = [(scores[i] >= 0.3) == bool(toxic[i]) for i in scores]
    assert len(right) == 300 and sum(right) >= 291


def test_words_with_grams_that_workers_do_not_hold(spark, docs_of, prose, monkeypatch):
    texts, toxic = planted(prose, 200)
    texts += [*ODD, texts[0], "unheard-of \U0001f600\x00 words 0", "x" * 3000]
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic) if i < 150], "doc_id long, toxic int")
    docs = docs_of(texts)
    scores = lambda: {r.doc_id: r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels), keep=["doc_id"]).collect()}
    want = scores()
    for bound in (300, 0):
        monkeypatch.setattr(toxicity, "NEAR_ROWS", bound)
        model = toxicity.fit_toxicity(docs, labels)
        assert len(model.near.keys) <= bound < model.entries.count() and model.near.rare is not None
        assert scores() == pytest.approx(want)


def test_odd_rows_and_labels(spark, docs_of, prose):
    texts, toxic = planted(prose, 120)
    docs = docs_of([*texts, *ODD])
    docs = docs.selectExpr("*", "'taken' AS score", "1 AS y").union(docs.selectExpr("CAST(NULL AS LONG)", "text", "lang", "source", "n_chars", "'taken'", "1").limit(3))
    known = [(i, y) for i, y in enumerate(toxic)] + [(None, 1), (3, None), (4, 1), (4, 0)]
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(known, "doc_id long, toxic int"))
    out = toxicity.score_toxicity(docs, model)
    assert out.columns == [*(c for c in docs.columns if c != "score"), "score"] and out.count() == docs.count()
    scores = [r.score for r in out.collect()]
    assert all(0 <= s <= 1 for s in scores)
    assert len({r.score for r in out.collect() if not (r.text or "").strip()}) == 1
    for labels, share in (([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)):
        one = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {r.score for r in toxicity.score_toxicity(docs, one).collect()} == {share}
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_text_keys(spark, prose):
    docs = spark.createDataFrame([(f"k{i}", prose(20, i) + (" blockhead" if i % 3 == 0 else "")) for i in range(90)], "doc_id string, text string")
    labels = spark.createDataFrame([(f"k{i}", int(i % 3 == 0)) for i in range(90)], "doc_id string, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert model.ratio[" bl"] > 0


def test_held_out_rows_are_not_learned_from(spark):
    labels = spark.createDataFrame([(i, 0) for i in range(200)], "doc_id long, toxic int")
    kept = {r.doc_id for r in toxicity.learnable(labels).collect()}
    assert kept == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}
