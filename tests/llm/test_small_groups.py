from pulsegrid.llm import rules


def judged(spark, rows):
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    return rules.judge_quality(docs).orderBy("doc_id").collect()


def test_small_languages_are_judged_by_all_documents(spark, prose):
    junk = prose(40, 7).replace(" ", " ### ").upper()
    rows = [(prose(40, i), "en", "s") for i in range(150)] + [(prose(40, 200 + i), "de", f"s{i % 3}") for i in range(9)] + [(junk, "de", "s0"), (junk, None, None)]
    got = judged(spark, rows)
    assert all(r["distance"] is not None for r in got)
    assert [r["doc_id"] for r in got if not r["kept"]] == [159, 160]


def test_a_small_table_is_judged_by_itself(spark, prose):
    rows = [(prose(40, i), "en", f"s{i % 4}") for i in range(20)] + [(prose(40, 7).replace(" ", " ### ").upper(), "en", "s1")]
    got = judged(spark, rows)
    assert all(r["distance"] is not None for r in got)
    assert [r["doc_id"] for r in got if not r["kept"]] == [20]
