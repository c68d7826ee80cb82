"""Pipeline inputs derived from the driver tables.

The crawler's own inputs (article JSON, fetch attempts, listing pages, a
ledger) are derived here from ``documents``, ``events`` and ``pages`` with
plain column expressions, so Spark and DuckDB can both build them from the
same parquet files.  Every derivation keeps all rows of its source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import hour_bucket, row_number
from ..schema import ARTICLE

LF = "\n"

# The synthetic article layout used to exercise the cleaner.
LINK_PREFIX = "https://example.org/a/"
DUP_EVERY, DUP_AT = 50, 49          # doc_id % 50 = 49 shares the previous link
ERR_TIMEOUT_EVERY = 17              # '_error' = 'timeout'
ERR_EMPTY_EVERY = 53                # '_error' = '' (key present, falsy)
EMPTY_TEXT_EVERY = 29               # 'Text' = ''
LEDGER_EVERY = 3                    # ledger holds links of pos % 3 = 0
LEDGER_STRAY_LINK = "https://example.org/not-in-dataset"
ATTEMPTS_PER_ROUND = 3
POISON_EVERY = 7                    # the failing splitter: texts of length % 7 = 0
DEAD_EVERY, DEAD_AT = 20, 7         # links of user_id % 20 = 7 fail every time


# Text tables: parsing and cleaning cost CPU per byte, so their scans are
# spread over all cores when the file layout gives fewer splits.
TEXT_TABLES = {"documents", "pages"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin over ``defaultParallelism`` partitions, only when the scan
    has fewer splits than that (a few large row groups).  A large input has
    many more splits than cores and is left as it is, with no shuffle."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def _article_link(doc_id: Column) -> Column:
    shifted = doc_id - F.when(doc_id % DUP_EVERY == DUP_AT, 1).otherwise(0)
    return F.concat(F.lit(LINK_PREFIX), shifted.cast("string"))


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """Articles (ARTICLE schema) with headers, dates, errors and duplicates."""
    d = F.col("doc_id")
    body = F.col("text")
    failed = (d % ERR_TIMEOUT_EVERY == 0) | (d % ERR_EMPTY_EVERY == 0)
    error = (F.when(d % ERR_TIMEOUT_EVERY == 0, F.lit("timeout"))
             .when(d % ERR_EMPTY_EVERY == 0, F.lit("")))
    raw = (
        F.when(failed, F.lit(None).cast("string"))
        .when(d % EMPTY_TEXT_EVERY == 0, F.lit(""))
        .when(d % 4 == 0, F.concat(
            F.lit("# Title "), d.cast("string"), F.lit(LF + LF + "Published May "),
            (1 + d % 28).cast("string"), F.lit(", 2024 Update on GitHub" + LF),
            body, F.lit(LF * 4 + "**b**  __c__ snake_case_x \t" + LF + "* i" + LF + "* j  ")))
        .when(d % 4 == 1, F.concat(
            F.lit("T" + LF + "Published  2024-01-0"), (1 + d % 9).cast("string"),
            F.lit(LF + LF), body))
        .when(d % 4 == 2, F.concat(F.lit("Published x" + LF), body))
        .otherwise(body))
    cols = {
        "pos": d,
        "link": _article_link(d),
        "title": F.concat(F.lit("Title "), d.cast("string")),
        "text": raw,
        "error": error,
    }
    return documents.select(*[
        (cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in ARTICLE.fields])


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(read_table(spark, sf_dir, "documents"))


def control_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with C0/C1 controls, tab, CR and U+200B spliced in."""
    d = F.col("doc_id")
    t = F.col("text")
    return read_table(spark, sf_dir, "documents").select(
        d.alias("pos"),
        F.concat(F.expr("chr(1 + cast(doc_id % 8 as int))"), F.substring(t, 1, 40),
                 F.lit("\x0b\t"), F.expr("substr(text, 41)"),
                 F.expr("chr(127 + cast(doc_id % 33 as int))"), F.lit("\r\u200b"),
                 F.expr("chr(28 + cast(doc_id % 4 as int))")).alias("text"))


# Compatibility characters put in front of every document, and their known
# normal form (ligature, Roman numeral, unit, full-width and circled signs,
# a letter with a combining mark).
COMPAT = "\ufb01 \u2163 \u338f \uff21\u2460 e\u0301 "
COMPAT_NFKC = "fi IV kg A1 \u00e9 "


def compat_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pos"), F.concat(F.lit(COMPAT), "text").alias("text"))


def ledger_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger: links of articles with ``pos % 3 = 0`` plus one stray link."""
    arts = articles(spark, sf_dir)
    known = arts.filter(F.col("pos") % LEDGER_EVERY == 0).select("link")
    stray = spark.range(1).select(F.lit(LEDGER_STRAY_LINK).alias("link"))
    return known.unionByName(stray).select(
        "link", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_at"))


def fetch_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch attempts from ``events``: one link per user, ordered by (ts, id).

    ``round`` and ``attempt`` number the events of a link in groups of three.
    The row number is computed per (link, hour) and offset by the earlier
    hours of the link, so a link with a third of all events still spreads
    over many tasks.
    """
    ev = read_table(spark, sf_dir, "events").select(
        F.concat(F.lit(LINK_PREFIX), F.col("user_id").cast("string")).alias("link"),
        "event_id", "ts", "event_type",
        (F.col("user_id") % DEAD_EVERY == DEAD_AT).alias("dead"))
    failed = (F.col("event_type") == "error") | F.col("dead")
    event = F.col("event_id")
    numbered = row_number(ev, ["link"], ["ts", "event_id"],
                          bucket=hour_bucket("ts"), name="rn")
    return numbered.select(
        "link", "event_id", "ts", "rn",
        F.ceil(F.col("rn") / ATTEMPTS_PER_ROUND).cast("int").alias("round"),
        (1 + (F.col("rn") - 1) % ATTEMPTS_PER_ROUND).cast("int").alias("attempt"),
        F.when(failed, F.concat(F.lit("error at event "), event.cast("string"))).alias("error"),
        F.when(~failed, F.struct(
            F.concat(F.lit("Article "), event.cast("string")).alias("title"),
            F.array(F.concat(F.lit("Author "), (event % 7).cast("string"))).alias("authors"),
            F.concat(F.lit("2024-01-0"), (1 + event % 9).cast("string")).alias("publish_date"),
            F.concat(F.lit("Body of "), F.col("link"), F.lit(" from event "),
                     event.cast("string")).alias("text"),
            F.concat(F.lit("Summary of event "), event.cast("string")).alias("summary"),
            F.array(F.lit("event"), F.concat(F.lit("k"), (event % 5).cast("string"))).alias("keywords"),
        )).alias("payload"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages: page number = ``page_id``."""
    return read_table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("page_no"), "url", "html")


def listing_pages_with_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages with an end: the next-to-last page is missing (a gap)
    and the last page has no anchors, so pagination must stop at the gap."""
    pages = listing_pages(spark, sf_dir)
    last = pages.select(F.max("page_no")).scalar()
    return (pages.filter(F.col("page_no") != last - 1)
            .withColumn("html", F.when(F.col("page_no") == last, F.lit(""))
                        .otherwise(F.col("html"))))


def attempt_links(attempts: DataFrame) -> DataFrame:
    """The crawl's link list: attempt links in order of their first attempt."""
    from ..operators.links import ordered_distinct
    return ordered_distinct(attempts, ["ts", "event_id"], hour_bucket("ts"))


# Head tags put in front of every stored page, by page_id modulo their number:
# both attribute orders, an apostrophe, entities, offsets, no byline at all.
BYLINES = [
    """<meta name="author" content="Pat O'Brien"><meta property="article:published_time" """
    """content="2024-01-01T10:00:00+02:00">""",
    """<meta content='Ann &amp; Bo' name='author'><meta name="author" content="Cy"><time """
    """datetime="2024-02-03T04:05:06Z">today</time>""",
    """<meta name="authority" content="nobody"><time class="x" datetime='2023-12-31'>""",
    "",
]


def pages_with_bylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.element_at(F.array(*[F.lit(b) for b in BYLINES]),
                        (F.col("page_id") % len(BYLINES) + 1).cast("int"))
    return read_table(spark, sf_dir, "pages").withColumn("html", F.concat(head, "html"))


# Entries of the crawler's article files: an unknown member first, every 97th
# entry a JSON string and every 101st null.
STRING_EVERY, NULL_EVERY = 97, 101
FILE_OF = 256                       # consecutive positions per file


def crawl_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name, pos, json`` of article files with members and entries that the
    cleaner does not know."""
    from ..sources.io import article_json
    arts = articles(spark, sf_dir)
    pos = F.col("pos")
    extra = F.concat(F.lit('{"_crawl": {"id": '), pos.cast("string"), F.lit(', "tags": ["a", null, 1.50]}, '))
    obj = F.concat(extra, F.expr("substr(json, 2)"))
    return (article_json(arts).select(
        F.format_string("articles-%06d.json", (pos / FILE_OF).cast("int")).alias("name"), "pos",
        F.when(pos % STRING_EVERY == 0, F.concat(F.lit('"'), pos.cast("string"), F.lit('"')))
        .when(pos % NULL_EVERY == 0, F.lit("null")).otherwise(obj).alias("json")))


def text_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name, pos, json``: the texts of each source as JSON strings."""
    return read_table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit(".json")).alias("name"), F.col("doc_id").alias("pos"),
        F.expr("substr(to_json(array(text)), 2, length(to_json(array(text))) - 2)").alias("json"))


def pages_with_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages whose anchors carry the class ``card`` on even pages and
    ``cards`` on odd ones, after one element of the class that is no anchor."""
    even = F.col("page_no") % 2 == 0
    tag = F.when(even, F.lit("<a class='item card' ")).otherwise(F.lit("<a class=\"cards\" "))
    own = F.concat(F.lit('<area title="a>b" class="card" href="/area/'), F.col("page_no").cast("string"), F.lit('?a&#61;1&amp;b">'))
    return listing_pages(spark, sf_dir).withColumn("html", F.concat(own, F.replace("html", F.lit("<a "), tag)))
