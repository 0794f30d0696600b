"""Shapes of plans, and windows asked in several blocks."""

from docmill.llm import decontaminate, url_filter
from docmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_urls_are_judged_in_place(spark):
    plan = QUERIES["op9_url_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("NestedLoop", "Exchange", "Join", "Python", "Arrow"):
        assert word not in plan, word


def test_rules_without_tokens_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://10.0.0.1/x"), (2, "http://a.net/fr/x"), (3, None), (4, "http://a.net/fr/x")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.method_rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got == {1: (None, "numeric host", "block"), 2: ("net/fr/", None, "block"), 3: (None, None, "allow"), 4: ("net/fr/", None, "block")}
    assert {r.verdict for r in url_filter.judge(pages, (), ()).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0)).count() == 0
    bare = (url_filter.Rule("x", "block", "net", (), True),)
    assert [r.verdict for r in url_filter.judge(pages, (), bare).orderBy("page_id").collect()] == ["allow", "block", "allow", "block"]


def test_windows_in_twenty_blocks_are_the_windows_in_one(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"]
    whole = sorted(map(tuple, decontaminate.contamination(docs, items).select(*columns).collect()))
    n = decontaminate.windows(items, decontaminate.WINDOW).count()
    monkeypatch.setattr(decontaminate, "QUERY_WINDOWS", -(-n // 20))
    assert sorted(map(tuple, decontaminate.contamination(docs, items).select(*columns).collect())) == whole
    empty = docs.limit(0)
    assert decontaminate.contamination(empty, items).count() == 0 and decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0
