from pulsegrid.llm import urls


def test_unlabelled_hosts_are_judged_by_their_parents(spark):
    """A bad domain's new subdomain goes; under a good domain, a mixed suffix or an unknown one hosts stay."""
    outcomes = [(f"http://h{h}.bad{d}.net/{i}", 0) for d in range(3) for h in range(4) for i in range(20)]
    outcomes += [(f"http://h{h}.good{d}.net/{i}", 1) for d in range(3) for h in range(4) for i in range(20)]
    outcomes += [(f"http://h{h}.spam{d}.biz/{i}", 0) for d in range(20) for h in range(2) for i in range(20)]
    outcomes += [(f"http://h{h}.fine{d}.org/{i}", 1) for d in range(20) for h in range(2) for i in range(20)]
    pages = ["http://new.bad1.net/1", "http://new.good1.net/1", "http://other.net/1", "http://new.spam77.biz/1", "http://new.fine77.org/1", "http://a.unknown/1", "http://new.spam1.org/1"]
    want = ["block", "allow", "allow", "block", "allow", "allow", "allow"]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = urls.filter_urls(frame(list(enumerate(pages)), "page_id long, url string"), frame(outcomes, "url string, good int"), urls.rules_from("")).orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == want
    assert {(r["host_labelled"], r["host_good"]) for r in got} == {(0, 0)}
    assert sorted(got[0].__fields__) == sorted(["page_id", "url", "host", "path", "rule", "verdict", "host_labelled", "host_good"])


def test_if_all_labelled_pages_are_bad_unknown_hosts_go_too(spark):
    outcomes = spark.createDataFrame([(f"http://h{i % 9}.net/{i}", 0) for i in range(200)], "url string, good int")
    pages = spark.createDataFrame([(0, "http://a.unknown/")], "page_id long, url string")
    assert urls.filter_urls(pages, outcomes, []).first()["verdict"] == "block"
