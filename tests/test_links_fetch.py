"""Link discovery and fetch bookkeeping semantics on small literal tables."""

from pyspark.sql import functions as F

from pagemill.operators import attempts as fb
from pagemill.operators import links as lk


def links_df(spark, links):
    return spark.createDataFrame(list(enumerate(links)), "pos long, link string")


def as_list(df):
    return [r["link"] for r in df.orderBy("pos").collect()]


def test_extract_links_class_and_resolve(spark):
    html = ('<a class="x card-link" href="/p/1">1</a><a href="/p/2">2</a>'
            '<A CLASS="card-link" HREF="https://o.org/3">3</A><a class="card-link" href="">e</a>'
            '<a class="card-linkx" href="/no">n</a><a class="card-link" href="rel/4">4</a>')
    pages = spark.createDataFrame([(0, "https://h.org/blog/list?p=0", html)],
                                  "page_no long, url string, html string")
    got = [r["link"] for r in lk.extract_links(pages, "card-link", base_url="url")
           .orderBy("idx").collect()]
    assert got == ["https://h.org/p/1", "https://o.org/3", "https://h.org/blog/rel/4"]
    assert len(lk.extract_links(pages).collect()) == 5


def test_hrefs_with_quotes_entities_and_comments(spark):
    html = ("""<a href="/it's">1</a><!-- <a href="/gone">x</a> --><a href='/a"b'>2</a>"""
            """<a href=/bare class=x>3</a><a href="/q?a=1&amp;b=2">4</a><a name="none">5</a>""")
    pages = spark.createDataFrame([(0, html), (1, None)], "page_no long, html string")
    got = lk.extract_links(pages).orderBy("page_no", "idx").collect()
    assert [r["link"] for r in got] == ["/it's", '/a"b', "/bare", "/q?a=1&b=2"]


def test_resolve_forms(spark):
    cases = [("x", "https://h.org", "https://h.org/x"),
             ("?p=2", "https://h.org/blog", "https://h.org/blog?p=2"),
             ("?p=2", "https://h.org", "https://h.org/?p=2"),
             ("#top", "https://h.org/blog?p=1#end", "https://h.org/blog?p=1#top"),
             ("../c", "https://h.org/a/b/list", "https://h.org/a/c"),
             ("../../../c", "https://h.org/a/b", "https://h.org/c"),
             ("./d/./e/..", "https://h.org/a/b?x=/y/z", "https://h.org/a/d/"),
             ("/r/../s?t=../u", "https://h.org/a", "https://h.org/s?t=../u"),
             ("//o.org/z", "https://h.org/a", "https://o.org/z"),
             ("mailto:a@b.c", "https://h.org/a", "mailto:a@b.c"),
             ("a/", "https://h.org/p/", "https://h.org/p/a/")]
    df = spark.createDataFrame(cases, "href string, base string, want string")
    for r in df.withColumn("got", lk.resolve(F.col("href"), F.col("base"))).collect():
        assert r["got"] == r["want"], (r["href"], r["base"])


def test_paginate_stops_at_empty_or_gap(spark):
    a = '<a href="/x">x</a>'
    pages = spark.createDataFrame([(0, a), (1, a), (2, ""), (3, a)], "page_no long, html string")
    assert sorted({r["page_no"] for r in lk.paginate(lk.extract_links(pages), pages).collect()}) == [0, 1]
    gap = spark.createDataFrame([(0, a), (1, a), (3, a)], "page_no long, html string")
    assert sorted({r["page_no"] for r in lk.paginate(lk.extract_links(gap), gap).collect()}) == [0, 1]
    hollow = spark.createDataFrame([(0, a), (1, '<a href="">x</a>'), (2, a), (3, None), (4, a)],
                                   "page_no long, html string")
    got = lk.paginate(lk.extract_links(hollow), hollow)
    assert sorted(r["page_no"] for r in got.collect()) == [0, 2]
    classed = spark.createDataFrame([(0, '<a class="i" href="/x">x</a>'), (1, a)], "page_no long, html string")
    got = lk.paginate(lk.extract_links(classed, "i"), classed, css_class="i")
    assert [r["page_no"] for r in got.collect()] == [0]
    late = spark.createDataFrame([(1, a)], "page_no long, html string")
    assert lk.paginate(lk.extract_links(late), late).count() == 0


def test_ordered_distinct(spark):
    df = links_df(spark, ["b", "a", "b", "c", "a"])
    out = lk.ordered_distinct(df, ["pos"], F.shiftright("pos", 10))
    assert [(r["pos"], r["link"]) for r in out.orderBy("pos").collect()] == [(0, "b"), (1, "a"), (2, "c")]


def test_top_n_delta_and_prepend(spark):
    saved = links_df(spark, ["s1", "s2", "s3", "n2", "s5"])
    same = links_df(spark, ["s1", "s2"])
    assert lk.top_n_delta(saved, same).count() == 0
    top = links_df(spark, ["n1", "s1", "n2"])           # n2 is saved deeper than N=3
    new, updated = lk.update_links(saved, top)
    assert as_list(new) == ["n1", "n2"]
    assert as_list(updated) == ["n1", "n2", "s1", "s2", "s3", "s5"]
    empty = links_df(spark, [])
    new, updated = lk.update_links(saved, empty)
    assert new.count() == 0 and as_list(updated) == ["s1", "s2", "s3", "n2", "s5"]


ATT = ("link string, round int, attempt int, error string, "
       "payload struct<title:string,text:string>")


def test_folds(spark):
    p = ("T", "body")
    att = spark.createDataFrame([
        ("ok_late", 1, 1, "e1", None), ("ok_late", 1, 2, "e2", None), ("ok_late", 1, 3, None, p),
        ("ok_late", 2, 1, None, ("X", "ignored")),
        ("fail", 1, 1, "f1", None), ("fail", 1, 2, "f2", None), ("fail", 2, 1, "f3", None),
        ("fail", 6, 1, None, p),                                  # beyond 5 rounds
        ("empty_err", 1, 1, "", None),
    ], ATT)
    folded = {r["link"]: r for r in fb.round_fold(att).collect()}
    assert folded["ok_late"]["ok"] and folded["ok_late"]["payload"]["title"] == "T"
    assert folded["ok_late"]["rounds"] == 1
    assert not folded["fail"]["ok"] and folded["fail"]["error"] == "f3"
    assert folded["fail"]["rounds"] == 2
    assert folded["empty_err"]["error"] == ""
    per_round = {(r["link"], r["round"]): r for r in fb.attempt_fold(att).collect()}
    assert per_round[("ok_late", 1)]["attempts"] == 3 and per_round[("fail", 1)]["error"] == "f2"
    tight = {r["link"]: r for r in fb.round_fold(att, max_rounds=1, attempts_per_round=2).collect()}
    assert not tight["ok_late"]["ok"] and tight["ok_late"]["error"] == "e2"


def test_needs_upsert_failed_report(spark):
    recs = spark.createDataFrame([
        (0, "a", "A", "x", None), (1, "b", None, None, ""), (2, "c", "C", "y", None),
        (3, "a", "A2", "x2", None), (4, "z", None, None, "old")],
        "pos long, link string, title string, text string, error string")
    ds = fb.load_dataset(recs)
    assert {r["link"]: (r["pos"], r["title"]) for r in ds.collect()}["a"] == (0, "A2")
    links = links_df(spark, ["a", "b", "n"])
    need = as_list(fb.needs_fetch(links, ds))
    assert need == ["b", "n"]                       # '' error is a key: refetch
    att = spark.createDataFrame([("b", 1, 1, None, ("B", "bb")), ("n", 1, 1, "down", None)], ATT)
    after = fb.upsert(ds, fb.round_fold(att), links)
    got = {r["link"]: (r["pos"], r["title"], r["error"]) for r in after.collect()}
    assert got["b"] == (1, "B", None) and got["n"] == (4 + 1 + 2, None, "down")
    assert sorted(r["link"] for r in fb.failed_links(after).collect()) == ["n", "z"]
    rep = fb.fetch_report(after).first()
    assert (rep["total"], rep["successful"], rep["failed"]) == (5, 3, 2)


def test_folds_take_each_slot_once_and_do_not_sort_payloads(spark):
    p = ("T", "body")
    att = spark.createDataFrame([
        ("twice", 1, 1, None, p), ("twice", 1, 1, None, p),
        ("both", 1, 1, "e", None), ("both", 1, 1, None, p), (None, 1, 1, None, p)], ATT)
    got = {r["link"]: (r["ok"], r["payload"]["title"]) for r in fb.round_fold(att).collect()}
    assert got == {"twice": (True, "T"), "both": (True, "T")}
    recs = spark.createDataFrame([(0, "a", "A")], "pos long, link string, title string")
    plan = fb.load_dataset(recs)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_upsert_replaces_the_whole_record(spark):
    ds = spark.createDataFrame(
        [(0, "a", "A", ["k"], "old summary", None), (1, "b", "B", ["x"], "s", "down")],
        "pos long, link string, title string, keywords array<string>, summary string, error string")
    att = spark.createDataFrame(
        [("b", 1, 1, None, ("B2", ["y"], "2024"))],
        "link string, round int, attempt int, error string, "
        "payload struct<title:string,keywords:array<string>,publish_date:string>")
    after = {r["link"]: r for r in fb.upsert(ds, fb.round_fold(att), links_df(spark, ["a", "b"])).collect()}
    assert after["a"].asDict() == {"pos": 0, "link": "a", "title": "A", "keywords": ["k"],
                                   "summary": "old summary", "publish_date": None, "error": None}
    assert after["b"].asDict() == {"pos": 1, "link": "b", "title": "B2", "keywords": ["y"],
                                   "summary": None, "publish_date": "2024", "error": None}
