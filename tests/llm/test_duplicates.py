"""Near-duplicate documents and lines against all pairs, and pages against their own articles."""

import random

import pytest
from conftest import ODD

import corpus_pipeline
from pulsegrid.llm import components, fuzzy_lines, minhash, pages, queries


def find_roots(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(300, 300)] + [(500, i) for i in range(400, 500)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame([*links, (None, 1)], "a long, b long")).collect()}
    roots = find_roots(600, [x for x in links])
    assert got == {n: roots[n] for n in {x for a, b in links if a != b for x in (a, b)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def word_set(text, width):
    words = text.encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def variants(prose, count, seed, edits):
    rng, base = random.Random(seed), prose(120, seed).split()
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = rng.choice("abcdefgh") * 3
        yield " ".join(words)


@pytest.fixture(scope="module")
def texts(prose):
    out = [*ODD, "Same Words here", "same words HERE ", prose(3, 1)]
    for seed in range(12):
        out.extend(variants(prose, 12, seed, 6))
    return out + [prose(120, 900 + i) for i in range(30)]


def test_near_components_equal_all_pairs(spark, docs_of, texts):
    for width in (4, 5):
        sets = [word_set(t or "", width) for t in texts]
        links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        roots = find_roots(len(texts), links)
        rows = minhash.near_components(docs_of(texts, id="clash", sig="clash"), width=width).orderBy("doc_id").collect()
        assert [r["n_shingles"] for r in rows] == [len(s) for s in sets]
        assert [r["component_id"] for r in rows] == roots
        assert [r["kept"] for r in rows] == [r == i for i, r in enumerate(roots)]


def test_blocks_of_a_large_entry_lose_no_pair(spark, docs_of, texts, monkeypatch):
    before = {r["doc_id"]: r["component_id"] for r in minhash.near_components(docs_of(texts)).collect()}
    monkeypatch.setattr(minhash, "BLOCK", 3)
    after = {r["doc_id"]: r["component_id"] for r in minhash.near_components(docs_of(texts)).collect()}
    assert before == after


def test_keep_one(spark, docs_of, prose):
    docs = docs_of([prose(50, 1), prose(50, 1), None, None, "", prose(50, 2)], kept="clash")
    kept = minhash.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4, 5] and kept.columns == docs.columns
    assert minhash.keep_one(docs_of([])).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "a b c"), (1, "a b c")], "doc_id long, text string")
    rows = minhash.near_components(odd).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in rows) == [("1", "1", True)] * 2 + [("None", "None", True)] * 2


def plain_lines(texts):
    ids, places = {}, []
    for d, t in enumerate(texts):
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\n\x0b\x0c\r"):
                places.append((d, i, ids.setdefault(line.strip(" \t\n\x0b\x0c\r"), len(ids))))
    sets = [fuzzy_lines.shingles(x) for x in ids]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    roots, seen, gone = find_roots(len(sets), links), set(), set()
    for d, i, line in places:
        if roots[line] in seen:
            gone.add((d, i))
        seen.add(roots[line])
    return [None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in enumerate(texts)]


def test_lines_equal_all_pairs(spark, docs_of, prose):
    rng = random.Random(4)
    texts = [None, "", "\n \n", "short\nshort\nShort", "\U0001f642\n\u4e2d\u6587\U0001f642\n\U0001f642"]
    pool = [list(variants(prose, 5, s, 3)) for s in range(15)]
    texts += ["\n".join(rng.choice(rng.choice(pool)) + rng.choice(["", " "]) for _ in range(6)) for _ in range(25)] + ["long " * 3000 + "x\n" + "long " * 3000 + "y"]
    docs = docs_of(texts, pos="clash", __dropped="clash")
    got = fuzzy_lines.dedup_lines(docs)
    assert got.columns == docs.columns
    assert [r["text"] for r in got.orderBy("doc_id").collect()] == plain_lines(texts)


def test_a_repeated_line_is_signed_once_a_batch(spark, docs_of, prose):
    lines = [prose(20, 1), prose(20, 2), "short"]
    docs = docs_of(["\n".join(lines * 3)] * 40 + [None, "", "\n"]).coalesce(1)
    signed = fuzzy_lines.signed_lines(docs, "doc_id", "text").collect()
    assert len(signed) == 40 * 9 and len({(r["__key"], r["pos"]) for r in signed}) == 40 * 9
    assert sorted(r["sig"] for r in signed if r["sig"]) == sorted(s.tobytes() for s in fuzzy_lines.signatures(lines))


def test_shared_entries_equal_groups(spark, docs_of, prose, monkeypatch):
    texts = [x for s in range(8) for x in variants(prose, 6, s, 4)]
    lines = fuzzy_lines.signed_lines(docs_of([*texts, texts[0], "a\na"]), "doc_id", "text")
    groups = {}
    for r in lines.where("sig IS NOT NULL").collect():
        for i in range(13):
            groups.setdefault((i, r["sig"][8 * i : 8 * i + 8]), set()).add(r["id"])
    expected = sorted((k[0], tuple(sorted(v))) for k, v in groups.items() if len(v) > 1)
    for size in (1 << 19, 40):
        monkeypatch.setattr(fuzzy_lines, "ENTRIES", size)
        got = {}
        for r in fuzzy_lines.shared_entries(lines).collect():
            got.setdefault((r["pair"], r["entry"]), []).append(r["id"])
        assert sorted((k[0], tuple(sorted(v))) for k, v in got.items()) == expected


def test_packed_shingles_equal_plain_ones():
    rng = random.Random(2)
    odd = ["a", "abc\x00\x00\x00\x00\x00", "abc", "é" * 9, "\U0001f642" * 20, "it’s a line with one wide mark and more", "\ud800 lone surrogate here"]
    odd += ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 40))) for alphabet in ("ab", "aé", "a’", "aé’") for _ in range(30)]
    for x in odd:
        numbers, others = fuzzy_lines.packed_shingles(x)
        assert len(set(numbers.tolist())) == len(numbers) and len(numbers) + len(others) == len(fuzzy_lines.shingles(x))
        for y in odd:
            s, t = fuzzy_lines.shingles(x), fuzzy_lines.shingles(y)
            for percent in (5, 30, 80):
                assert minhash.linked((numbers, others), fuzzy_lines.packed_shingles(y), percent) == (100 * len(s & t) >= percent * len(s | t))


def test_documents_without_lines_left(spark, docs_of, prose):
    docs = docs_of([prose(20, 1), prose(20, 1), "", None])
    assert sorted(r["doc_id"] for r in fuzzy_lines.dedup_lines(docs, empty=False).collect()) == [0, 2, 3]
    assert fuzzy_lines.dedup_lines(docs).count() == 4
    assert fuzzy_lines.dedup_lines(docs_of([])).count() == 0
    odd = spark.createDataFrame([(None, "a\na"), (1, "b"), (1, "b")], "doc_id long, text string")
    assert sorted(r["text"] for r in fuzzy_lines.dedup_lines(odd).collect()) == ["a\na", "b", "b"]


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy {n}</div>{main}<aside class="sidebar">Side</aside>
<div id="comments"><div>A reader: {n}</div></div><form><input><p>Send</p></form><script>var x="</p>"</script><footer>&copy; x {n}</footer></body></html>"""


def test_pages(spark, prose):
    body = [f"<h2>Title &amp; {i}</h2><p>{prose(30, i)}\n  &lt;end&gt;<p><b>bold{i}</b>text{i}<br>next{i}</p><div class='ad'>no {i}</div><ul><li>one {i}<li>two {i}</ul>" for i in range(8)]
    want = [f"Title & {i}\n\n{prose(30, i)} <end>\n\nbold{i}text{i} next{i}\n\none {i}\n\ntwo {i}" for i in range(8)]
    rows = [(i, "http://a.com/x", PAGE.format(n=i, main=f"<article>{b}</article>"), "clash") for i, b in enumerate(body)]
    rows += [(100 + i, "http://b.com/", PAGE.format(n=i, main=f"<div class='content'>{b}</div>"), "clash") for i, b in enumerate(body[:2])]
    rows += [(200 + i, "http://c.com/", PAGE.format(n=i, main=f"<div>{b}</div>"), "clash") for i, b in enumerate(body)]
    rows += [(300 + i, "http://d.com/", PAGE.format(n=1, main=f"<article>{body[0]}</article>"), "clash") for i in range(60)]  # copies
    rows += [(400, None, None, ""), (401, "http://e.com/", "", ""), (402, "x", "plain &eacute; text", ""), (403, "http://e.com/", "<p>open <b>never <i>closed", ""), (404, "http://e.com/", "<article>a</article><article>b", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in pages.extract_pages(df).collect()}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got.values())
    for i in range(8):
        assert got[i]["text"] == want[i] and got[200 + i]["text"] == want[i]
    assert [got[100 + i]["text"] for i in range(2)] == want[:2]
    assert {got[300 + i]["text"] for i in range(60)} == {want[0]}
    assert [got[k]["text"] for k in range(400, 405)] == ["", "", "plain \u00e9 text", "open never closed", "a\n\nb"]
    assert pages.extract_pages(df.limit(0)).count() == 0


def test_template_holds_the_tags_that_pages_share(prose):
    parsed = [pages.tokens_of(PAGE.format(n=i, main=f"<article><p>{prose(5, i)}</p></article>")) for i in range(5)]
    template = pages.template_of(parsed)
    for page in parsed:
        labels = [t.label for t in page if t.role in template]
        assert labels.index("nav ") < labels.index("article ") < labels.index("/article") < labels.index("footer ")
        assert "div class=ad" in labels and "aside class=sidebar" in labels


def one_page(html):
    return pages.extract_group([html])[0]


@pytest.mark.parametrize(
    "html, text",
    [
        ("<html><head><title>T</title><meta charset=x><body><p>all of it</p>", "all of it"),
        ("<p>it <a title=it's href=x>link</a> then more</p><p>next</p>", "it link then more\n\nnext"),
        ("<div class=\"text-muted\">tiny</div><div><p>The whole long article is here.</p></div>", "tiny\n\nThe whole long article is here."),
        ("<article><div class=related-work><p>kept</p></div><div class='search-results'>kept too</div><div class='share-buttons'>gone</div></article>", "kept\n\nkept too"),
        ("<article><p>x is <math><mi>y</mi></math> and</p></article>", "x is y and"),
        ("<p>a</p><template>b<template>c</template>d</template><p>e</p>", "a\n\ne"),
        ("<div class=content><p>short</p></div><div><p>much longer text that no class marks at all</p></div>", "short\n\nmuch longer text that no class marks at all"),
        ("<p" + " a=b" * 20000 + " <p>unclosed tag</p>", "unclosed tag"),
    ],
)
def test_pages_lose_no_text(html, text):
    assert one_page(html) == text


def test_other_queries_have_rows(spark):
    for name in set(queries.QUERIES) - set(queries.ORACLES):
        key = "page_id" if "html" in name else "doc_id"
        got = queries.QUERIES[name](spark, "/root/testdata/sf0.001").select(key).distinct().count()
        assert got == (50 if key == "page_id" else 200), name


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    from pulsegrid.llm.common import written

    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = written(stage(spark, docs, sf), name)
        assert docs.columns == columns
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert set(after) <= before and len(after) == len(set(after))
        sizes.append(len(after))
    assert 0 < sizes[-1] < sizes[0]
    packed = corpus_pipeline.run(spark, sf).select("doc_id").distinct().count()
    assert packed == sizes[-1]
