"""Link discovery and deltas (LK1-LK6) over stored listing pages.

A link list is ``DataFrame(pos BIGINT, link STRING)``; ``pos`` is the list
order (newest first).  Listing pages are ``DataFrame(page_no, html)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import COMMENT_RE, REST, attr, attr_re, decode_entities
from .sequence import prefix_sum

ANCHOR_RE = rf"(?i)<a\s{REST}"
#: Any tag, for elements that are found by their class.
ELEMENT_RE = rf"(?i)<[a-z][^\s/>]*\s{REST}"
HREF_RE = attr_re("href")
# Listing pages per bucket of the dense re-numbering (pages hold tens of links).
PAGE_BUCKET_BITS = 4


def class_pattern(css_class: str) -> str:
    """Regex for an anchor tag whose ``class`` attribute lists ``css_class``."""
    import re
    cls = re.escape(css_class)
    return rf"""(?i)\sclass\s*=\s*["']([^"']*\s)?{cls}(\s[^"']*)?["']"""


def _without_dots(path: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments resolved."""
    parts = F.slice(F.split(path, "/", -1), 2, 1 << 30)
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc)
        .when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(x))))
    folder = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(folder, "/").otherwise(""))


def resolve(href: Column, base_url: Column) -> Column:
    """Absolute URL for ``href`` relative to ``base_url`` (as a browser's
    ``href`` property returns it): absolute, scheme-relative, host-relative,
    path-relative, query-only and fragment-only forms."""
    scheme = F.regexp_extract(base_url, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    origin = F.regexp_extract(base_url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    own = F.regexp_extract(base_url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    own = F.when(own == "", "/").otherwise(own)
    query = F.regexp_extract(base_url, r"^[^?#]*(\?[^#]*)", 1)
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    directory = F.regexp_extract(own, r"^(.*/)", 1)
    return (F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("?"), F.concat(origin, own, href))
            .when(path == "", F.concat(origin, own, query, rest))
            .when(href.startswith("/"), F.concat(origin, _without_dots(path), rest))
            .otherwise(F.concat(origin, _without_dots(F.concat(directory, path)), rest)))


def anchors(css_class: str | None = None) -> Column:
    """Anchor tags of ``html`` outside comments; with ``css_class`` the tags of
    any element that carries it."""
    shown = F.regexp_replace("html", COMMENT_RE, "")
    tags = F.regexp_extract_all(shown, F.lit(ELEMENT_RE if css_class else ANCHOR_RE), 0)
    if css_class:
        pat = class_pattern(css_class)
        tags = F.filter(tags, lambda t: t.rlike(pat))
    return tags


def extract_links(pages: DataFrame, css_class: str | None = None,
                  base_url: str | None = None) -> DataFrame:
    """LK1: ``(page_no, idx, link)`` for anchors with a non-empty ``href``,
    in page order; with ``css_class`` for any element that carries it and has
    an ``href``.  Tags in comments do not count, and entities in an ``href`` are
    decoded.

    ``base_url`` names a column holding the page URL; when given, links are
    resolved against it.
    """
    tags = anchors(css_class)
    hrefs = F.filter(F.transform(tags, lambda t: decode_entities(attr(t, HREF_RE))),
                     lambda h: h != "")
    cols = ["page_no"] + ([base_url] if base_url else [])
    out = pages.select(*cols, F.posexplode(hrefs).alias("idx", "link"))
    if base_url:
        out = out.withColumn("link", resolve(F.col("link"), F.col(base_url))).drop(base_url)
    return out


def paginate(page_links: DataFrame, pages: DataFrame, start: int = 0,
             css_class: str | None = None) -> DataFrame:
    """LK2: links of pages ``start, start+1, ...`` up to (not including) the
    first page that is missing or has no matching anchor.  A page whose
    anchors all have an empty ``href`` gives no links and does not stop.

    ``page_links`` is the output of :func:`extract_links` over ``pages`` with
    the same class.  Every page marks its own number (with matches or not) and
    the next one; the stop page is the first number without matches.
    """
    own = F.struct("page_no", (F.coalesce(F.size(anchors(css_class)), F.lit(0)) > 0).alias("ok"))
    following = F.struct((F.col("page_no") + 1).alias("page_no"), F.lit(False).alias("ok"))
    marks = (pages.filter(F.col("page_no") >= start)
             .select(F.explode(F.array(own, following)).alias("m")).select("m.*")
             .groupBy("page_no").agg(F.max("ok").alias("ok")))
    first = marks.agg(F.min("page_no").alias("first"),
                      F.min(F.when(~F.col("ok"), F.col("page_no"))).alias("stop"))
    stop = first.select(F.when(F.col("first") == start, F.col("stop"))).scalar()
    return page_links.filter((F.col("page_no") >= start) & (F.col("page_no") < stop))


def ordered_distinct(links: DataFrame, order: list[str], bucket: Column,
                     key: str = "link") -> DataFrame:
    """LK3: first occurrence wins; ``(pos, link)`` with dense 0-based ``pos``.

    The first occurrence per link is a map-side ``min`` of the order struct,
    then the survivors are renumbered with a bucketed prefix sum.
    ``bucket`` is evaluated on the order columns and must not decrease
    along the order.
    """
    first = (links.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
             .select(key, *[F.col(f"_first.{c}").alias(c) for c in order]))
    numbered = prefix_sum(first, [], order, bucket, None, name="pos")
    return numbered.select(F.col("pos").cast("long").alias("pos"), F.col(key).alias("link"))


def top_n_delta(saved: DataFrame, top: DataFrame) -> DataFrame:
    """LK4: first-page links that are new against the first N saved links.

    N = number of first-page links.  No change when the union of both sets is
    as large as the saved top N; else the first-page links absent from the
    saved top N, in page order (a link saved deeper than N counts as new).
    """
    n = top.select(F.count(F.lit(1))).scalar()
    saved_top = saved.filter(F.col("pos") < n)
    union_size = (top.select("link").unionByName(saved_top.select("link"))
                  .select(F.count_distinct("link")).scalar())
    saved_size = saved_top.select(F.count(F.lit(1))).scalar()
    return (top.join(saved_top.select("link"), "link", "left_anti")
            .filter(union_size != saved_size)
            .select("pos", "link"))


def prepend(new: DataFrame, saved: DataFrame) -> DataFrame:
    """LK5: new links first, then the saved ones; ordered distinct."""
    both = (new.select(F.lit(0).alias("_grp"), "pos", "link")
            .unionByName(saved.select(F.lit(1).alias("_grp"), "pos", "link")))
    bucket = F.col("_grp") * (1 << 50) + F.shiftright(F.col("pos"), 10)
    return ordered_distinct(both, ["_grp", "pos"], bucket)


def update_links(saved: DataFrame, first_page: DataFrame) -> tuple[DataFrame, DataFrame]:
    """LK6: returns ``(new_links, updated_list)``.

    ``first_page`` is the ordered, de-duplicated link list of page 0.  When it
    is empty, or nothing is new, the list is unchanged.
    """
    new = top_n_delta(saved, first_page)
    return new, prepend(new, saved)
