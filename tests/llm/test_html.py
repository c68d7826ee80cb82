"""Operator 10: literal layouts, robustness, and that no visible word is lost."""

import html
import random
import re

from pagemill.llm import html_layout as hl

from ..conftest import SF01

CASES = [
    ("", ""), (None, ""), ("plain  text\n here", "plain text here"),
    ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a<br>b<br><br>c", "a\nb\n\nc"), ("<b>x</b><i>y</i> <u>z</u>", "xy z"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol><li>a</li><li><p>b</p><p>c</p></li></ol>", "1. a\n2. b\n\n   c"),
    ("<table><tr><th>k<th>value<tr><td>long key<td>1</table>", "k        | value\nlong key | 1"),
    ("<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>", "wide cell\na | b"),
    ("<table><tr><td>x<br>y</td><td>z</td></tr></table>", "x | z\ny |"),
    ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"),
    ("<script>var a='<p>no</p>'</script><style>p{}</style>yes<!-- no -->", "yes"),
    ("<p hidden>no</p><p style='display: none'>no<b>no</b></p><div style=\"visibility:hidden\">no</div>ok", "ok"),
    ("<head><title>T &amp; U</title><meta x></head><body>b", "b"),
    ("<blockquote>q<p>r</blockquote>s", "> q\n>\n> r\n\ns"), ("a<hr>b", "a\n\n---\n\nb"),
    ("&lt;tag&gt; &eacute;&#233;&nosuch;", "<tag> éé&nosuch;"), ("<a href='x>y'>l</a>", "l"),
    ("</div></p>a</b>", "a"), ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"), ("<p>cut <b", "cut"),
    ("<div hidden/>x", ""), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
]


def test_layouts():
    for page, want in CASES:
        assert hl.render(page)[0] == want, page
    assert hl.render("<title>A\n b</title>x") == ("x", "A b")


OMITTED = [
    ("<table><colgroup><col><col><tr><td>x</table>", "x"),
    ("<table><colgroup><col><tbody><tr><td>x<td>y</table>", "x | y"), ("<table><colgroup>x<tr><td>y</table>", "x\ny"),
    ("<table><tbody><td>x<td>y<tr><td>z</table>", "x | y\nz"),
    ("<table><thead><th>A<th>B<tbody><td>c<td>d</table>", "A | B\nc | d"), ("<table><td>x</table>", "x"),
    ("<table><tbody><form><tr><td>x<td>y</form><tr><td>z</table>", "x | y\nz"),
    ("<table><tbody>stray<tr><td>x</table>", "stray\nx"), ("<table><tbody><div>s<tr><td>x<td>y</table>", "s\nx | y"),
    ("<table><caption>c<tr><td>x<td>y</table>", "c\nx | y"), ("<table><tr><td>a<form><b>b</b></form><td>c</table>", "a | c\nb |"),
    ("<head><title>T</title><b>hi</b>", "hi"), ("<head><title>T</title>hi", "hi"), ("<head><meta x>\n<p>a", "a"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>", "x=1"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td>x<td rowspan=2>z<tr><td>y</table>", "x | z\ny |"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d<tbody><tr><td>e</table>", "a | b\n  | c\n  | d\ne"),
    ("<table><tr><td>a<td colspan=2 rowspan=2>b<td>c<tr><td>d<td>e</table>", "a | b   | c\nd |     | e"),
]


def test_omitted_tags_and_spans():
    for page, want in OMITTED:
        assert hl.render(page)[0] == want, page
    # no word is lost whatever hangs between the parts of a table
    rng = random.Random(2)
    bits = ["<table>", "</table>", "<colgroup>", "<col>", "<tbody>", "<thead>", "<tr>", "<td>", "<td rowspan=3>",
            "<th colspan=2 rowspan=2>", "</td>", "</tr>", "<form>", "</form>", "<div>", "</div>", "<p>", "<caption>",
            "<b>", "<head>", "<li>"]
    for _ in range(2000):
        parts = [f"{rng.choice(bits)} w{i} " if rng.random() < .5 else rng.choice(bits) for i in range(25)]
        page = "".join(parts)
        assert sorted(re.findall(r"w\d+", hl.render(page)[0])) == sorted(re.findall(r"w\d+", page)), page


def test_no_visible_word_is_lost(spark):
    """Against a plain rule: take out what is not shown, then the tags."""
    rows = spark.read.parquet(f"{SF01}/pages.parquet").select("html").collect()
    gone = re.compile(r"<!--.*?-->|<(script|style|head)\b.*?</\1>|<!doctype[^>]*>", re.S | re.I)
    for r in rows:
        page = r["html"]
        if "hidden" in page or "display" in page:
            continue
        words = html.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", gone.sub(" ", page))).split()
        text = re.sub(r"(?m)^(?:> |- |\d+\. | )*|^---$| \| ?", " ", hl.render(page)[0])
        assert re.sub(r"[\s|>-]", "", "".join(words)) == re.sub(r"[\s|>-]", "", text)


def test_broken_markup_never_fails():
    rng = random.Random(1)
    bits = ["<p", ">", "</", "<table>", "<tr>", "<td", " colspan=99999", "x ", "<li>", "<ul>", "&#", "&amp", "'", '"',
            "<!--", "-->", "<script>", "</script>", "<pre>\n", "<", "/>", "</td>", "</table>", "<br>", "\x00"]
    for _ in range(3000):
        hl.render("".join(rng.choice(bits) for _ in range(rng.randrange(40))))
    hl.render("<div>" * 5000 + "deep")
    hl.render("<" * 20_000)
    hl.render("<a '" * 5000)


def test_query(spark):
    df = spark.createDataFrame([(1, None, "z"), (2, "<p>a", "z"), (2, "<p>a", "z"), (None, "b" * 300_000, "z")],
                               "page_id long, html string, text string")
    got = sorted(((r["page_id"] or 0), r["n_chars"], r["n_lines"]) for r in hl.extract(df).collect())
    assert got == [(0, 300_000, 1), (1, 0, 0), (2, 1, 1), (2, 1, 1)]
    assert hl.extract(df.limit(0)).count() == 0


MORE = [
    ("<p data=it's>hello</p><p>it's</p>", "hello\n\nit's"),
    ('<p>a <a href="x"">Hello</a> b', "a Hello b"),
    ("<p title='a>b' x = \"c>d\">t", "t"),
    ('<p style="display:none;display:block">yes</p><p style="display:block; display : none">no', "yes"),
    ("<p style='visibility:hidden;color:red'>no<p style='x-display:none'>yes", "yes"),
    ("<details><summary>s</summary>no<p>no</p></details><details open><summary>t</summary>u</details>", "s\nt\nu"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<ruby>a<rp>(</rp><rt>b</rt><rp>)</rp></ruby>", "ab"),
    ("<table><tr><td>" + "w" * 300 + "<td>x<tr><td>y<td>z</table>", "w" * 300 + " | x\ny" + " " * 299 + " | z"),
]


def test_quotes_visibility_and_wide_columns():
    for page, want in MORE:
        assert hl.render(page)[0] == want, page


def test_hidden_text_stays_hidden_at_any_depth():
    for n in (10, 199, 200, 201, 500):
        deep = "<div>" * n
        page = f"{deep}a<b hidden>no<b>no</b>no</b>b<div style='display:none'>no<div>no</div></div>c" + "</div>" * n + "d"
        assert "no" not in hl.render(page)[0] and "".join(hl.render(page)[0].split()) == "abcd", n
        # the ends of what lies beyond the depth do not end what holds it
        inner = "<i>" * n + "no" + "</i>" * n
        assert hl.render(f"<i hidden>{inner}no</i>yes")[0] == "yes", n


def characters(tag: str) -> tuple[str, dict]:
    """A start tag's name and attributes, character by character as the
    standard's tokenizer reads them."""
    i, name = 1, ""
    while i < len(tag) and tag[i] not in " \t\n\r\f/>":
        name, i = name + tag[i].lower(), i + 1
    attrs = {}
    while i < len(tag) and tag[i] != ">":
        if tag[i] in " \t\n\r\f/":
            i += 1
            continue
        key = tag[i]
        i += 1
        while i < len(tag) and tag[i] not in " \t\n\r\f/>=":
            key, i = key + tag[i], i + 1
        j = i
        while j < len(tag) and tag[j] in " \t\n\r\f":
            j += 1
        value = ""
        if j < len(tag) and tag[j] == "=":
            i = j + 1
            while i < len(tag) and tag[i] in " \t\n\r\f":
                i += 1
            if i < len(tag) and tag[i] in "\"'":
                end = tag.find(tag[i], i + 1)
                if end < 0:
                    return name, None
                value, i = tag[i + 1:end], end + 1
            else:
                while i < len(tag) and tag[i] not in " \t\n\r\f>":
                    value, i = value + tag[i], i + 1
        attrs.setdefault(key.lower(), value)
    return name, (attrs if i < len(tag) else None)


def test_tags_end_where_the_standard_ends_them():
    """Fuzzed attributes: text after the tag is shown, whatever the quotes,
    unless the element is hidden."""
    rng = random.Random(6)
    some = ["a", "hidden", "x", "=", '"', "'", " ", ">", "/", "style", "b=c", "='d>e'", '="f g"', "\n"]
    shown = 0
    for _ in range(4000):
        raw = "".join(rng.choices(some, k=rng.randrange(9)))
        page = f"<b {raw}>TEXT</b>"
        name, attrs = characters(page)
        if attrs is None or name != "b":
            continue
        text = hl.render(page)[0]
        if "hidden" not in attrs:
            assert "TEXT" in text, page
            shown += 1
        elif "hidden" in raw and not re.search(r"hidden\s*=|[=\"'/]", raw):
            assert "TEXT" not in text, page
    assert shown > 1000
