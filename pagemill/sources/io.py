"""Readers and writers (IO1-IO10).

The crawler exchanges whole JSON arrays.  The strict readers cut them in
splits (:mod:`pagemill.sources.arrays`); the lenient ones parse each file in
one task, since a file counts as a whole or not at all.  The readers are the
conversion step, and everything downstream works on Parquet tables with an
explicit ``pos`` column.  Positions are unique and rise in file order, then
element order (within a file they are consecutive); they need not be dense.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attempts import load_dataset
from ..operators.links import ordered_distinct
from ..session import stage
from ..schema import ARTICLE, ARTICLE_JSON, JSON_KEYS, LEDGER, LINKS
from .arrays import parsed, read_elements


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def _entries(spark: SparkSession, path: str, strict: bool) -> DataFrame:
    """``(pos, entry VARIANT)`` for every element of the JSON array(s).

    Strict: malformed JSON, text after the array and a top level that is not
    an array raise.  Lenient: such a file has no entries; its positions are
    ``(rank of the file path) << 32 | element index``, with the file ranks from
    the scan's file list (metadata the driver holds anyway).
    """
    if strict:
        return read_elements(spark, path).select("pos", parsed(F.col("json")).alias("entry"))
    raw = (spark.read.option("singleVariantColumn", "_v").option("multiLine", True)
           .option("mode", "PERMISSIVE").json(path))
    ranks = spark.createDataFrame(list(enumerate(sorted(raw.inputFiles()))),
                                  "_fr long, _file string")
    arr = F.try_variant_get(F.col("_v"), "$", "array<variant>")
    return (raw.select(F.input_file_name().alias("_file"), arr.alias("_a"))
            .join(ranks, "_file")
            .select("_fr", F.posexplode("_a").alias("_i", "entry"))
            .select((F.shiftleft("_fr", 32) + F.col("_i")).alias("pos"), "entry"))


def _field(entry, key: str, dtype: str):
    return F.try_variant_get(entry, f"$['{key}']", dtype)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """IO1 strict reader: a missing file or malformed JSON raises.  Returns
    the object entries with their positions (an entry that is not an object
    would stop the index build, so it is not returned)."""
    arts = article_columns(_entries(spark, path, strict=True))
    return arts.filter(F.col("is_object")).drop("is_object")


def article_columns(e: DataFrame) -> DataFrame:
    """The article columns of ``entry VARIANT``, null where it is no object, and
    ``is_object``; other columns stay."""
    is_obj = F.coalesce(F.schema_of_variant(F.col("entry")).startswith("OBJECT"), F.lit(False))
    cols = [F.when(is_obj, _field(F.col("entry"), f.name, f.dataType.simpleString()))
            .alias(JSON_KEYS[f.name]) for f in ARTICLE_JSON.fields]
    return e.select(*[c for c in e.columns if c != "entry"], *cols, is_obj.alias("is_object"))


def read_mixed_articles(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """IO2: tolerant of array entries that are not objects; a file that is not
    a JSON array raises.

    Every entry becomes a row; ``is_object`` is false for entries that are
    not JSON objects (their fields are NULL), which the cleaner counts as
    errors.
    """
    return article_columns(_entries(spark, path, strict))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """IO3 lenient link reader: missing or unreadable -> empty list."""
    try:
        e = _entries(spark, path, strict=False)
    except AnalysisException:
        return _empty(spark, LINKS)
    return (e.select("pos", F.try_variant_get(F.col("entry"), "$", "string").alias("link"))
            .filter(F.col("link").isNotNull()))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """IO4: keyed dataset from an article file; error -> empty."""
    try:
        arts = read_mixed_articles(spark, path, strict=False).filter(F.col("is_object")).drop("is_object")
    except AnalysisException:
        return _empty(spark, ARTICLE)
    return load_dataset(stage(arts, "dataset-rows"))     # read twice, parsed once


def write_links(links: DataFrame, path: str) -> None:
    """IO5: ordered distinct, then overwrite (Parquet ``pos, link``)."""
    bucket = F.shiftright(F.col("pos"), 10)
    ordered_distinct(links, ["pos"], bucket).write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO6 / IO7: dataset or cleaned dataset, same columns as read."""
    df.write.mode(mode).parquet(path)


def snapshot(spark: SparkSession, path: str, backup_path: str) -> DataFrame:
    """IO8: copy the current table to ``backup_path`` and return the copy.

    An in-place rewrite must not read and overwrite the same path in one job,
    so the rewrite reads from the snapshot.
    """
    spark.read.parquet(path).write.mode("overwrite").parquet(backup_path)
    return spark.read.parquet(backup_path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """IO9: ledger rows; missing or unreadable -> empty."""
    try:
        df = spark.read.parquet(path)
        return df.select("link", "processed_at")
    except AnalysisException:
        return _empty(spark, LEDGER)


def read_ledger_json(spark: SparkSession, path: str) -> DataFrame:
    """IO9 for the crawler's ledger object ``{processed_links: [...]}``."""
    try:
        raw = (spark.read.option("singleVariantColumn", "_v").option("multiLine", True)
               .option("mode", "PERMISSIVE").json(path))
    except AnalysisException:
        return _empty(spark, LEDGER)
    links = F.try_variant_get(F.col("_v"), "$.processed_links", "array<string>")
    ts = F.try_to_timestamp(F.try_variant_get(F.col("_v"), "$.last_updated", "string"))
    return raw.select(F.explode(links).alias("link"), ts.alias("processed_at")).distinct()


def append_ledger(marks: DataFrame, path: str) -> None:
    """IO10: append ``(link, processed_at)``; the count is derived on read."""
    marks.select("link", "processed_at").write.mode("append").parquet(path)


def write_json_arrays(entries: DataFrame, path: str, bits: int = 12) -> None:
    """Write ``(pos, json STRING)`` rows as JSON array files, one per block of
    ``2^bits`` positions, elements in ``pos`` order.  A block is one group,
    so its size is bounded by ``2^bits`` entries."""
    block = F.shiftright(F.col("pos"), bits)
    # A multi-line JSON file holds one document, so every block gets its own
    # file (one directory per block).
    (entries.groupBy(block.alias("block"))
     .agg(F.sort_array(F.collect_list(F.struct("pos", "json"))).alias("_e"))
     .select("block", F.concat(F.lit("["), F.array_join(F.transform("_e", lambda x: x["json"]), ","),
                               F.lit("]")).alias("value"))
     .write.mode("overwrite").partitionBy("block").text(path))


def article_json(articles: DataFrame) -> DataFrame:
    """``(pos, json)``: each article as a JSON object with the crawler's keys;
    NULL fields are left out, as a missing key."""
    inverse = {v: k for k, v in JSON_KEYS.items()}
    fields = [F.col(c).alias(inverse[c]) for c in inverse if c in articles.columns]
    return articles.select("pos", F.to_json(F.struct(*fields)).alias("json"))
