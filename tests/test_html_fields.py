"""Extraction against pages written by hand (the SQL forms share patterns)."""

from html import unescape

import pytest
from pyspark.sql import functions as F

from pagemill.functions import html as hx
from pagemill.operators import extract as ex
from pagemill.operators import links as lk

PAGES = [
    # page, title, text
    ("<title>A &hellip; B</title><p title='a>b'>it&#8217;s &hellip;</p>", "A … B", "it’s …"),
    ('<h1 data-x="1 > 0">H</h1><article class="x>y"><p>one<br class="a>b"/>two<p>three</article><p>out', "H", "one two\n\nthree"),
    ("<p data=it's>hello</p><p>it's</p>", "", "hello\n\nit's"),
    ('<p>a <a href="x"">link</a> b</p>', "", "a link b"),
    ("<p>&amp;lt; &lt;b&gt; &#38;amp; &#x1F600; &nosuch; &amp &copy;</p>", "", "&lt; <b> &amp; 😀 &nosuch; &amp ©"),
    ('<script x="</script">no</script><p>1 &lt; 2 = <i x=y>3</i></p>', "", "1 < 2 = 3"),
    ("<nav a='>'>gone</nav><p>stays", "", "stays"),
    ("", "", ""),
]


def test_fields_of_pages(spark):
    rows = [(i, f"u{i}", h) for i, (h, _, _) in enumerate(PAGES)] + [(99, "u", None)]
    got = {r["page_id"]: (r["title"], r["text"]) for r in ex.extract_articles(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: (t, x) for i, (_, t, x) in enumerate(PAGES)}, 99: ("", "")}


def test_references_as_the_standard_library(spark):
    texts = ["&eacute;&notin;&NotEqualTilde;&fjlig;", "&#0;&#128;&#150;&#xD800;&#x110000;&#99999999;&#x0000041;",
             "&amp;#65; &#38;#65;", "no reference & none; &; &#; &#x;", "&AMP;lt; &quot;&apos;", "&#233;" * 3]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(hx.decode_entities(F.col("t"))).collect()]
    want = [unescape(t) for t in texts]
    want[3] = texts[3]
    assert got == want


@pytest.mark.parametrize("html,want", [
    ('<div class="a card b" href="/1">x</div><a class="cards" href="/2">y</a><a href="/3">z</a>', ["/1"]),
    ("<a class=\"card\" data-x='>' href=\"/q?a=1&amp;b=2\">1</a><CARD class='card' href=''>", ["/q?a=1&b=2"]),
    ('<!-- <a class="card" href="/no"> --><span class="card">none</span>', []),
])
def test_links_by_class(spark, html, want):
    pages = spark.createDataFrame([(0, html)], "page_no long, html string")
    assert [r["link"] for r in lk.extract_links(pages, "card").orderBy("idx").collect()] == want


def test_a_page_of_stray_signs_is_read(spark):
    """No pattern may overflow the stack on a page without tag ends."""
    pages = spark.createDataFrame([(0, "u", "<p a=b>ok</p><" + "x='" * 40_000),
                                   (1, "u", "<p " + "a='1' " * 5_000 + ">y</p>")], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in ex.extract_articles(pages).collect()}
    assert got[0].startswith("ok")
