"""Chunk index build (CK2-CK4, IX1-IX8).

An article is *new* when it has no error flag and its link is not in the
ledger.  Every article whose link belongs to a new article is *visited*
(even a flagged one that shares the link); a visited article is *processed*
when it is the first, by position, with text that yields chunks.  The rest of
the visited articles are *skipped*.  Chunk ids are dense, start after the
largest id already stored, and rise in article order, then chunk order.

Per-link facts come from one ``groupBy(link)`` with map-side partial
aggregation, so a link held by a third of the rows collapses before the
shuffle.  The splitter runs only on processed articles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..batches import all_parts
from ..functions import splitter as sp
from ..functions.text import WS_CHARS
from ..session import ship_package, stage
from .clean import flagged

# Defaults the index applies to missing metadata.
DEFAULT_TITLE = "Untitled"
DEFAULT_DATE = ""

SKIP_ERROR = "error"
SKIP_NO_TEXT = "no_text"
SKIP_NO_CHUNKS = "no_chunks"
SKIP_DUPLICATE = "already_processed"
SKIP_IN_LEDGER = "in_ledger"


def link_key(link: Column) -> Column:
    """A missing link acts as the key ``""``."""
    return F.coalesce(link, F.lit(""))


def yields_chunks(text: Column) -> Column:
    """True exactly when the splitter returns at least one chunk.

    Every character lands in some emitted run and runs are whitespace
    stripped, so chunks exist iff the text has a non-whitespace character.
    Checked natively, so skipped rows never reach the Python splitter.
    """
    return F.coalesce(F.length(F.btrim(text, F.lit(WS_CHARS))) > 0, F.lit(False))


def ledger_keys(ledger: DataFrame) -> DataFrame:
    return ledger.select(link_key(F.col("link")).alias("link_key")).distinct()


def unprocessed_links(articles: DataFrame, ledger: DataFrame) -> DataFrame:
    """IX1: links of error-free articles not in the ledger; order and
    duplicates kept (``pos`` carries the order).  The ledger's keys are staged:
    with a plain scan on both sides AQE can split a hot link."""
    a = articles.filter(~flagged(F.col("error"))).withColumn("link_key", link_key(F.col("link")))
    return (a.join(stage(ledger_keys(ledger), "ledger-keys"), "link_key", "left_anti")
            .select("pos", F.col("link_key").alias("link")))


def validate_articles(articles: DataFrame, ledger: DataFrame) -> DataFrame:
    """CK4 / IX8: one light row per article -- ``pos, link, link_key, new,
    visited, skip_reason`` (NULL skip_reason = to process).

    Only positions, links and flags computed from the text travel through
    the shuffle; the text stays in the input.  ``pos`` must be unique.

    The light rows are staged, so the text is read once, and so are the facts
    per link: the join has a plain scan on both sides, and AQE splits a link
    that holds a large part of the rows.
    """
    a = articles.select(
        "pos", "link", link_key(F.col("link")).alias("link_key"),
        (~flagged(F.col("error"))).alias("_ok"),
        (F.coalesce(F.col("text"), F.lit("")) != "").alias("_has_text"),
        yields_chunks(F.col("text")).alias("_yields"))
    a = stage(a.withColumn("_cand", F.col("_ok") & F.col("_has_text") & F.col("_yields")), "articles-light")
    keys = (a.groupBy("link_key")
            .agg(F.max(F.col("_ok").cast("int")).alias("_key_ok"),
                 F.min(F.when(F.col("_cand"), F.col("pos"))).alias("_first_pos"))
            .join(ledger_keys(ledger).withColumn("_in_ledger", F.lit(True)),
                  "link_key", "left"))
    j = a.join(stage(keys, "link-facts"), "link_key", "left")
    in_ledger = F.coalesce(F.col("_in_ledger"), F.lit(False))
    visited = (F.col("_key_ok") == 1) & ~in_ledger
    reason = (F.when(in_ledger, F.lit(SKIP_IN_LEDGER))
              .when(~visited, F.lit(SKIP_ERROR))
              .when(~F.col("_ok"), F.lit(SKIP_ERROR))
              .when(~F.col("_has_text"), F.lit(SKIP_NO_TEXT))
              .when(~F.col("_cand"), F.lit(SKIP_NO_CHUNKS))
              .when(F.col("pos") != F.col("_first_pos"), F.lit(SKIP_DUPLICATE)))
    return j.select(
        "pos", "link", "link_key",
        (F.col("_ok") & ~in_ledger).alias("new"),
        visited.alias("visited"),
        reason.alias("skip_reason"))


#: Positions that are broadcast at most (some 100 MB as a table).
BROADCAST = 1 << 21


@dataclass
class Work:
    """The articles to index: the input, and the positions to take from it."""
    articles: DataFrame
    keep: DataFrame
    rows: int


def to_process(validated: DataFrame, articles: DataFrame) -> Work:
    """The positions whose ``skip_reason`` is NULL, written once.  The articles
    stay where they are until :func:`assign_chunks` moves them."""
    keep = stage(validated.filter(F.col("skip_reason").isNull()).select("pos", "link_key"), "articles-to-process")
    return Work(articles, keep, keep.count())


def _in_ranges(work: Work) -> DataFrame:
    """Rows ``mark, pos, link_key, title, publish_date, text`` of the articles
    to index in ranges of ``pos``, ordered within a range: the one exchange that
    carries text.

    A small set of positions is broadcast and filters the scan.  A large one
    takes part in the exchange as marked rows, each before its article.  The
    bounds of the ranges come from the positions, so no text is read to find
    them."""
    spark = work.articles.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = work.articles.select("pos", "title", "publish_date", "text")
    if work.rows <= BROADCAST:
        rows = rows.join(F.broadcast(work.keep), "pos").withColumn("mark", F.lit(False))
    else:
        rows = rows.withColumn("link_key", F.lit(None).cast("string")).withColumn("mark", F.lit(False)).unionByName(
            work.keep.select("pos", "link_key", F.lit(True).alias("mark")), allowMissingColumns=True)
    shares = [i / parts for i in range(1, parts)]
    bounds = work.keep.agg(F.percentile_approx("pos", shares, max(10_000, 20 * parts)).alias("b")).first()[0] \
        if shares else None
    # as many bounds as partitions, so this is short beside the text of a row
    part = F.lit(0) if not bounds else F.size(F.filter(F.lit(bounds), lambda b: b <= F.col("pos")))
    return (rows.repartitionById(parts, part)
            .sortWithinPartitions("pos", F.desc("mark"))
            .select("mark", "pos", "link_key", "title", "publish_date", "text"))


CHUNKED = ("part int, before long, pos long, link_key string, title string, publish_date string, "
           "chunks array<string>")


def _chunk_ranges(rows: DataFrame, marked: bool, one: Callable[[str | None], list[str] | None]) -> DataFrame:
    """Chunks of every article, and the number of chunks before it in its range."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, key = TaskContext.get().partitionId(), 0, None
        for batch in all_parts(batches):
            out: list[list] = [[] for _ in range(7)]
            for mark, pos, link, title, date, text in zip(*(c.to_pylist() for c in batch.columns)):
                if mark:
                    key = (pos, link)
                    continue
                if marked:
                    if key is None or key[0] != pos:
                        continue
                    link = key[1]
                chunks = one(text)
                for col, v in zip(out, (part, before, pos, link, title, date, chunks)):
                    col.append(v)
                before += len(chunks or ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (
                    pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                    pa.list_(pa.string())))],
                names=[f.split(" ")[0] for f in CHUNKED.split(", ")])

    return rows.mapInArrow(run, CHUNKED)


def assign_chunks(work: Work, base_id: Column | int = 0,
                  size: int = sp.CHUNK_SIZE, overlap: int = sp.CHUNK_OVERLAP,
                  split: Callable[[str | None, int, int], list[str]] | None = None) -> DataFrame:
    """CK1-CK3: chunk rows with dense ids ``base_id + 1 ...``.

    An article on which the splitter (``split``, if given) fails has no chunks
    and takes no ids; its neighbours are not affected.

    ``base_id`` is the largest chunk number already stored (0 when empty).  The
    articles are cut where one exchange puts them in ranges of ``pos``, and a
    range counts its chunks as it goes.  The chunks are written once; the totals
    per range (one row a partition) give each range its first id.
    """
    one = sp.safe_splitter(size, overlap, split=split)
    spark = work.articles.sparkSession
    chunked = stage(_chunk_ranges(_in_ranges(work), work.rows > BROADCAST, one), "chunked")
    totals = sorted(chunked.groupBy("part").agg(F.min("pos"), F.max("pos"),
                                                F.sum(F.greatest(F.size("chunks"), F.lit(0)))).collect(),
                    key=lambda r: r[1])
    if any(a[2] >= b[1] for a, b in zip(totals, totals[1:])):
        raise ValueError("positions repeat, or ranges of them overlap")
    starts = [(r[0], sum(t[3] for t in totals[:i])) for i, r in enumerate(totals)]
    # one row per partition
    numbered = chunked.join(F.broadcast(spark.createDataFrame(starts, "part int, _first long")), "part")
    base = base_id if isinstance(base_id, Column) else F.lit(base_id)
    exploded = numbered.select(
        "pos", "link_key", "title", "publish_date", (F.col("_first") + F.col("before")).alias("_offset"),
        F.posexplode("chunks").alias("_i", "chunk_text"))
    no = (base.cast("long") + F.col("_offset") + F.col("_i") + 1).alias("chunk_no")
    return exploded.select(
        F.concat(F.lit("id"), no.cast("string")).alias("chunk_id"),
        no,
        F.col("link_key").alias("link"),
        F.coalesce(F.col("title"), F.lit(DEFAULT_TITLE)).alias("title"),
        F.coalesce(F.col("publish_date"), F.lit(DEFAULT_DATE)).alias("publish_date"),
        "chunk_text",
        F.col("pos").alias("article_pos"),
        F.col("_i").alias("chunk_index"),
    )


def _tagged(df: DataFrame, tag: str, **cols: Column) -> DataFrame:
    return df.select(F.lit(tag).alias("_src"), *[c.alias(k) for k, c in cols.items()])


def build_stats(validated: DataFrame, chunks: DataFrame) -> DataFrame:
    """IX5: counters of one build run (one row, one aggregate over a union).

    IX8: an article that should have been indexed and has no chunk is an error.
    One article per link is indexed, so the links with chunks are counted."""
    no = F.lit(None).cast("string")
    rows = _tagged(validated, "article", new=F.col("new"), visited=F.col("visited"),
                   reason=F.col("skip_reason"), chunk_of=no).unionByName(
        _tagged(chunks, "chunk", new=F.lit(False), visited=F.lit(False), reason=no,
                chunk_of=F.col("link")))
    processed = F.count_distinct("chunk_of")
    art = F.col("_src") == "article"
    return rows.agg(
        F.count_if(art).alias("total_articles"),
        F.count_if(art & F.col("new")).alias("new_articles"),
        F.count_if(F.col("_src") == "chunk").alias("chunks_added"),
        processed.alias("articles_processed"),
        F.count_if(art & F.col("visited") & F.col("reason").isNotNull()).alias("articles_skipped"),
        (F.count_if(art & F.col("visited") & F.col("reason").isNull()) - processed).alias("errors"))


def ledger_marks(validated: DataFrame, at: Column | None = None,
                 chunks: DataFrame | None = None) -> DataFrame:
    """IX2: ledger rows for the articles processed in this run; with ``chunks``
    only for those that have some, so a failed article is tried again."""
    ts = at if at is not None else F.current_timestamp()
    done = validated.filter(F.col("skip_reason").isNull())
    if chunks is not None:
        done = done.join(chunks.select(F.col("link").alias("link_key")), "link_key", "left_semi")
    return (done
            .select(F.col("link_key").alias("link"), ts.alias("processed_at")))


def _counts(articles: DataFrame | None, ledger: DataFrame, chunks: DataFrame) -> DataFrame:
    parts = [_tagged(ledger_keys(ledger), "ledger"), _tagged(chunks, "chunk")]
    if articles is not None:
        parts.append(_tagged(articles, "article"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.agg(
        F.count_if(F.col("_src") == "article").alias("total_articles"),
        F.count_if(F.col("_src") == "ledger").alias("processed_articles"),
        F.count_if(F.col("_src") == "chunk").alias("total_chunks"))


def status_summary(articles: DataFrame, ledger: DataFrame, chunks: DataFrame) -> DataFrame:
    """IX6: dataset size, ledger size, chunk count, up-to-date flag."""
    return (_counts(articles, ledger, chunks)
            .withColumn("up_to_date", F.col("processed_articles") == F.col("total_articles"))
            .withColumn("remaining", F.col("total_articles") - F.col("processed_articles")))


def store_stats(chunks: DataFrame, ledger: DataFrame, name: str, path: str) -> DataFrame:
    """IX7: collection name, chunk count, processed articles, store path."""
    return _counts(None, ledger, chunks).select(
        F.lit(name).alias("collection_name"), "total_chunks", "processed_articles",
        F.lit(path).alias("vector_store_path"))
