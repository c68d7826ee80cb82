"""The pipeline's three runs as Spark jobs, composed from the operators.

* :func:`crawl_update` -- link discovery or update, fetch-attempt folding and
  dataset upsert (the scrape run, starting from stored pages and attempts);
* :func:`clean_dataset` -- read, optional snapshot, clean, write, statistics
  (the clean run), :func:`clean_json_files` the same from files to files;
* :func:`build_index` -- incremental or forced build of the chunk store (the
  index run).

Each returns small result DataFrames (statistics, new or failed links);
tables are written to the given paths.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import attempts as fb
from ..operators import clean as cl
from ..operators import links as lk
from ..sources import arrays, files, io
from ..schema import ARTICLE
from ..session import ensure_checkpoint_dir, scratch_path, stage
from ..sources.store import ChunkStore


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).limit(0).collect()
        return True
    except AnalysisException:
        return False


def crawl_update(spark: SparkSession, pages: DataFrame, attempts: DataFrame,
                 links_path: str, dataset_path: str, out_dataset_path: str,
                 css_class: str | None = None,
                 max_rounds: int = fb.MAX_ROUNDS,
                 attempts_per_round: int = fb.ATTEMPTS_PER_ROUND) -> dict[str, DataFrame]:
    """Scrape run over stored listing pages ``(page_no, html)`` and fetch
    attempts.

    With a saved link list, only page 0 is read and new links are prepended
    (LK6); without one, pages are collected until the first missing or empty
    page (LK2).  Links that are new or failed are folded from the attempts
    and upserted into the dataset, written to ``out_dataset_path`` (Parquet,
    keyed by link).  Returns the new links, the failed set and the report.
    """
    ensure_checkpoint_dir(spark)
    page_links = lk.extract_links(pages, css_class)
    order, bucket = ["page_no", "idx"], F.shiftright("page_no", lk.PAGE_BUCKET_BITS)
    if _exists(spark, links_path):
        saved = spark.read.parquet(links_path)
        first = lk.ordered_distinct(page_links.filter(F.col("page_no") == 0), order, bucket)
        new, updated = lk.update_links(saved, first)
        new = new.checkpoint(eager=True)
        # the list is rewritten in place: cut the lineage to the old files
        # first (reliable checkpoint), then overwrite
        updated.checkpoint(eager=True).write.mode("overwrite").parquet(links_path)
        links = spark.read.parquet(links_path)
    else:
        links = lk.ordered_distinct(lk.paginate(page_links, pages, css_class=css_class), order, bucket)
        links.write.mode("overwrite").parquet(links_path)
        links = spark.read.parquet(links_path)
        new = links
    dataset = (spark.read.parquet(dataset_path) if _exists(spark, dataset_path)
               else spark.createDataFrame([], ARTICLE))
    need = fb.needs_fetch(links, dataset)
    fetched = fb.round_fold(stage(attempts.join(need.select("link"), "link", "left_semi"), "attempts"),
                            max_rounds, attempts_per_round)
    fb.upsert(dataset, fetched, links).write.mode("overwrite").parquet(out_dataset_path)
    after = spark.read.parquet(out_dataset_path)
    return {"new_links": new, "failed": fb.failed_links(after), "report": fb.fetch_report(after)}


def clean_dataset(spark: SparkSession, input_path: str, output_path: str,
                  backup: bool = True, source: str = "json") -> DataFrame:
    """Clean run: read the article JSON (entries that are not objects are
    counted as errors) or, with ``source="parquet"``, the table that
    :func:`crawl_update` wrote; clean, write Parquet, return the statistics
    (CL9).

    A malformed file raises before anything is written.  When cleaning in
    place with ``backup``, the files are first copied byte by byte to
    ``<input>_backup`` (IO8), under their names and with a manifest.
    """
    articles = (io.read_mixed_articles(spark, input_path) if source == "json"
                else spark.read.parquet(input_path))
    if input_path == output_path:
        # cut the lineage to the files being replaced; this also parses them all
        path = scratch_path(spark, "clean-input")
        articles.write.parquet(path)
        articles = spark.read.parquet(path)
        if backup and source == "parquet":
            io.snapshot(spark, input_path, input_path.rstrip("/") + "_backup")
        elif backup:
            files.copy_files(spark, input_path, input_path.rstrip("/") + "_backup")
    cleaned = cl.clean_articles(articles)
    cleaned.write.mode("overwrite").parquet(output_path)
    return cl.clean_stats(spark.read.parquet(output_path))


def clean_json_files(spark: SparkSession, input_path: str, output_path: str,
                     backup: bool = True) -> DataFrame:
    """Clean run from JSON array files to JSON array files (IO7): one output
    file per input file, under its name and in the crawler's form.

    ``Text`` and, where a date was found, ``Publish Date`` of the cleaned
    articles are replaced.  All other members, skipped articles and entries that
    are not objects stay as they are, in their order.  Files are written to a
    fresh folder that takes the place of ``output_path`` when it is whole; in
    place with ``backup``, the old files are copied to ``<input>_backup`` first.
    The statistics (CL9) are counted while the files are written.
    """
    if input_path == output_path and backup:
        files.copy_files(spark, input_path, input_path.rstrip("/") + "_backup")
    elements = arrays.read_elements(spark, input_path)
    rows = io.article_columns(elements.withColumn("entry", arrays.parsed(F.col("json"))))
    seen = Observation()
    cleaned = cl.clean_articles(rows).observe(seen, *cl.stats_columns())
    done = F.col("clean_status") == cl.CLEANED
    new = arrays.update_elements(
        cleaned.withColumn("_text", F.when(done, F.col("text")))
        .withColumn("_date", F.when(done & (F.col("extracted_date") != ""), F.col("extracted_date"))),
        {"Text": "_text", "Publish Date": "_date"})
    # an empty array has no element, but stays a file
    names = files.listing(spark, input_path).select(
        "name", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("json"))
    empty = names.join(elements.select("name").distinct(), "name", "left_anti")
    fresh = f"{output_path.rstrip('/')}.{os.urandom(6).hex()}"
    arrays.write_arrays(new.unionByName(empty), fresh)
    files.replace_folder(spark, fresh, output_path)
    return spark.createDataFrame([tuple(seen.get[c] for c in cl.STATS)],
                                 ", ".join(f"{c} long" for c in cl.STATS))


def build_index(spark: SparkSession, cleaned_path: str, store_root: str,
                rebuild: bool = False, embed: bool = True) -> dict[str, DataFrame]:
    """Index run: the chunk store is built from the cleaned articles (only
    objects).  Returns the run statistics, the status summary and the store
    statistics."""
    articles = spark.read.parquet(cleaned_path)
    if "is_object" in articles.columns:
        articles = articles.filter(F.coalesce(F.col("is_object"), F.lit(True)))
    articles = articles.drop("clean_status", "extracted_date", "is_object")
    store = ChunkStore(spark, store_root, embed=embed)
    stats = store.build(articles, rebuild=rebuild)
    return {"stats": stats, "status": store.status(articles), "store": store.stats()}
