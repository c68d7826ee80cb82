"""Article fields from stored HTML (EX1-EX3), as column expressions.

Our contract (the crawler delegated this to a parser library whose rules are
not part of the pipeline):

* comments and ``script``, ``style``, ``nav``, ``footer`` elements are
  dropped; an element cut off by the end of the page runs to the end;
* title = ``<title>``, else the first ``<h1>``;
* text = the ``<p>`` blocks inside ``<article>`` (whole page when there is
  none), tags removed, whitespace collapsed, empty blocks dropped, joined by
  a blank line; a block ends at ``</p>``, the next ``<p>`` or the end;
* authors = ``<meta name="author">`` contents; publish date = the
  ``article:published_time`` meta or the first ``<time datetime>``, as an
  ISO date-time string with its offset if it has one, NULL when absent or
  unparsable;
* a ``>`` in a quoted attribute value does not end a tag, and a quote that
  does not follow ``=`` is no value;
* numeric and named entities with their semicolon are decoded once.

Regular expressions avoid look-around and back-references, so the DuckDB
oracle uses the same patterns.
"""

from __future__ import annotations

import json
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, WS_CHARS

SPACE_RE = WS + "+"

DROPPED_ELEMENTS = ("script", "style", "nav", "footer")
COMMENT_RE = r"(?s)<!--.*?(-->|\z)"
#: The rest of a tag up to its end, with up to 100 attribute values.  What a
#: value is depends on its first character alone, so no match is tried twice.
REST = r"""[^>=]*(?:=\s*(?:"[^"]*"|'[^']*'|[^\s"'>])[^>=]*){0,100}(?:=\s*)?>"""
TITLE_RE = rf"(?is)<title\b{REST}(.*?)(</title\s*>|\z)"
H1_RE = rf"(?is)<h1\b{REST}(.*?)(</h1\s*>|\z)"
ARTICLE_RE = rf"(?is)<article\b{REST}(.*?)(</article\s*>|\z)"
P_OPEN_RE = rf"(?i)<p\b{REST}"
P_CLOSE_RE = r"(?is)</p\s*>.*"
BR_RE = rf"(?i)<br\b{REST}"
TAG_RE = rf"(?s)<{REST}"
META_RE = rf"(?i)<meta\s{REST}"
TIME_RE = rf"(?i)<time\s{REST}"
IS_AUTHOR_RE = r"""(?i)\sname\s*=\s*["']?author["'\s/>]"""
IS_PUBLISHED_RE = r"""(?i)\sproperty\s*=\s*["']?article:published_time["'\s/>]"""
# The zone after the seconds of an ISO date-time.
ZONE_RE = r"(:\d{2}(?:\.\d+)?)\s*(Z|[+-]\d{2}:?\d{2})$"


def attr_re(name: str) -> str:
    """Value of an attribute in a tag: one of the three groups."""
    return rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


CONTENT_RE, DATETIME_RE = attr_re("content"), attr_re("datetime")

# The entities of the test pages, '&amp;' last (for the SQL form).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&middot;", "·"),
            ("&copy;", "©"), ("&amp;", "&")]


def element_re(tag: str) -> str:
    return rf"(?is)<{tag}\b{REST}.*?(</{tag}\s*>|\z)"


def strip_boilerplate(html: Column) -> Column:
    out = F.regexp_replace(html, COMMENT_RE, "")
    for tag in DROPPED_ELEMENTS:
        out = F.regexp_replace(out, element_re(tag), "")
    return out


#: The named references of the HTML standard, as the standard library has them.
_NAMED = json.dumps({f"&{name}": char for name, char in html5.items() if name.endswith(";")})
_C1 = json.dumps({c: unescape(f"&#{c};") for c in range(0x80, 0xA0)})
ENTITY_RE = "&(?:#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,8}|[A-Za-z][A-Za-z0-9]{1,31});"


def _entity(e: Column) -> Column:
    """The characters of one reference, itself if it is none."""
    hexed = F.regexp_extract(e, "^&#[xX]0*([0-9a-fA-F]*);", 1)
    code = (F.when(e.rlike("^&#[xX]"), F.conv(F.concat(F.lit("0"), hexed), 16, 10).cast("long"))
            .otherwise(F.regexp_extract(e, "^&#([0-9]+);", 1).try_cast("long")))
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    # C1 codes stand for the characters of Windows-1252
    c1 = F.element_at(F.from_json(F.lit(_C1), "map<string,string>"), code.cast("string"))
    number = F.when(bad, F.lit("\ufffd")).otherwise(F.coalesce(c1, char))
    named = F.element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), e)
    return F.when(e.startswith("&#"), number).otherwise(F.coalesce(named, e))


def decode_entities(s: Column) -> Column:
    """Character references decoded, each once: those for ``&`` come last, so
    what they leave is not read again."""
    found = F.array_distinct(F.regexp_extract_all(s, F.lit(ENTITY_RE), 0))
    pairs = F.transform(found, lambda e: F.struct(e.alias("e"), _entity(e).alias("c")))
    ordered = F.concat(F.filter(pairs, lambda p: p["c"] != "&"), F.filter(pairs, lambda p: p["c"] == "&"))
    return F.when(F.contains(s, F.lit("&")), F.aggregate(ordered, s, lambda t, p: F.replace(t, p["e"], p["c"]))
                  ).otherwise(s)


def _plain(fragment: Column) -> Column:
    """Tags removed, whitespace runs to one space, trimmed, entities decoded."""
    no_tags = F.regexp_replace(F.regexp_replace(fragment, BR_RE, " "), TAG_RE, "")
    return decode_entities(F.btrim(F.regexp_replace(no_tags, SPACE_RE, " "), F.lit(WS_CHARS)))


def title(html: Column) -> Column:
    t = _plain(F.regexp_extract(html, TITLE_RE, 1))
    h = _plain(F.regexp_extract(html, H1_RE, 1))
    return F.when(t != "", t).otherwise(h)


def body_text(html: Column) -> Column:
    region = F.when(html.rlike(r"(?i)<article\b"), F.regexp_extract(html, ARTICLE_RE, 1)
                    ).otherwise(html)
    blocks = F.slice(F.split(region, P_OPEN_RE, -1), 2, 1 << 30)
    paras = F.transform(blocks, lambda b: _plain(F.regexp_replace(b, P_CLOSE_RE, "")))
    return F.array_join(F.filter(paras, lambda p: p != ""), "\n\n")


def attr(tag: Column, pattern: str) -> Column:
    """The value matched by an :func:`attr_re` pattern, ``""`` when absent."""
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def _meta_contents(html: Column, which: str) -> Column:
    tags = F.filter(F.regexp_extract_all(html, F.lit(META_RE), 0), lambda t: t.rlike(which))
    return F.transform(tags, lambda t: attr(t, CONTENT_RE))


def authors(html: Column) -> Column:
    return F.transform(_meta_contents(html, IS_AUTHOR_RE),
                       lambda a: decode_entities(F.btrim(a, F.lit(WS_CHARS))))


def publish_date(html: Column) -> Column:
    """Wall-clock date-time, followed by the offset when the page names one;
    the session's zone plays no part."""
    meta = F.get(_meta_contents(html, IS_PUBLISHED_RE), 0)
    times = F.transform(F.regexp_extract_all(html, F.lit(TIME_RE), 0), lambda t: attr(t, DATETIME_RE))
    tm = F.get(F.filter(times, lambda t: t != ""), 0)
    raw = F.when(meta != "", meta).otherwise(tm)
    zone = F.regexp_extract(raw, ZONE_RE, 2)
    offset = (F.when(zone == "Z", "+00:00")
              .when(F.length(zone) == 5, F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
              .otherwise(zone))
    wall = F.regexp_replace(raw, ZONE_RE, "$1").try_cast("timestamp_ntz")
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), offset)
