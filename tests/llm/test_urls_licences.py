import pytest
from checking import connect, differences

from pulsegrid.llm import licences, queries, urls

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert differences(got, connect(SF).execute(queries.ORACLES[name]).df()) == []


def judged(spark, pages, outcomes=(), **options):
    pages = spark.createDataFrame(pages, "page_id long, url string, host string, upper double")
    outcomes = spark.createDataFrame(list(outcomes), "url string, good int")
    rows = urls.filter_urls(pages, outcomes, urls.rules_from(queries.URL_RULES), **options).collect()
    return {r["page_id"]: r for r in rows}


def test_hosts_paths_and_rules(spark):
    cases = {
        0: (None, "", "", None, "allow"),
        1: ("no scheme", "", "", None, "allow"),
        2: ("http://Www.Example.ORG/es/1?q", "www.example.org", "/es/1", "example.org/es/", "block"),
        3: ("http://example.org/en/12#x", "example.org", "/en/12", "example.org/en/1", "block"),
        4: ("http://badexample.org/en/12", "badexample.org", "/en/12", "org/", "allow"),
        5: ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
        6: ("http://a.org", "a.org", "", None, "allow"),
        7: ("http://a.com?x://b.org/", "a.com", "", None, "allow"),
        8: ("", "", "", None, "allow"),
        9: ("http://İ.com/fr/\nx", "İ.com", "/fr/\nx", "com/fr/", "allow"),
    }
    got = judged(spark, [(k, v[0], "clash", 1.0) for k, v in cases.items()])
    assert {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in got.items()} == {k: v[1:] for k, v in cases.items()}


def test_reputation_blocks_only_hosts_that_are_surely_bad(spark):
    outcomes = [(f"http://bad.x.net/{i}", 0) for i in range(40)] + [(f"http://good{i % 5}.y.net/{i}", 1) for i in range(100)]
    outcomes += [("http://once.z.net/1", 0), ("http://null.z.net/1", None)]
    pages = [(0, "http://bad.x.net/9", "", 0.0), (1, "http://good1.y.net/9", "", 0.0), (2, "http://once.z.net/2", "", 0.0), (3, "http://null.z.net/1", "", 0.0)]
    got = judged(spark, pages, outcomes)
    assert [got[i]["verdict"] for i in range(4)] == ["block", "allow", "allow", "allow"]
    assert (got[0]["host_labelled"], got[3]["host_labelled"]) == (40, 0)


def test_suffixes_and_domains(spark):
    df = spark.createDataFrame([("http://a.b.co.uk/",), ("http://a.b.com/",), ("http://com/",), (None,)], "url string")
    got = [(r["__suffix"], r["__domain"]) for r in urls.with_host_parts(df).collect()]
    assert got == [("co.uk", "b.co.uk"), ("com", "b.com"), ("com", "com"), ("", "")]


def test_no_rows(spark):
    assert judged(spark, []) == {}


MIT = "\n".join([
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and",
    "associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Something unknown in between.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES',
    "of merchantability, fitness for a particular purpose and noninfringement.",
])


def test_licences(spark, docs_of):
    texts = [MIT, "Prose. Released under the MIT License. More.\nLicensed under CC BY-NC 4.0.", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", None, "", "A licence of another kind."]
    got = licences.scan_licences(docs_of(texts, licences="clash")).orderBy("doc_id").collect()
    assert [r["licences"] for r in got] == [["MIT"], ["CC-BY-NC-4.0", "MIT"], [], [], [], []]
    assert got[0]["licence_rules"] == ["mit-text"] and got[0]["unmatched"] == []
    assert got[2]["unmatched"] == ["mit-notice"]
    assert len(got) == 6


def test_rules_take_what_they_match(spark, docs_of):
    text = "Released under the MIT License.\nReleased under the MIT License.\nThis work is licensed under the GNU General Public License, version 3."
    row = licences.scan_licences(docs_of([text])).first()
    assert row["sentence_ids"] == ["mit-released", "mit-released", "gpl3-work"] and row["licences"] == ["GPL-3.0-only", "MIT"]
    assert licences.scan_licences(docs_of([])).count() == 0
