"""The corpus pipeline: language identification, exact and near
de-duplication, secret redaction, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and returns the columns of ``documents`` (the last: one row per packed
piece).  :func:`run` writes every stage to the shared folder and rereads it,
so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import exact_dedup, language_id, near_dedup, packing, secret_scan
from pagemill.llm.common import documents, stage
from pagemill.llm.queries import WORD_BPE
from pagemill.session import ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identifiable language: no letter at all.
    The posterior rejects nothing.  Where no row has a label there is no model,
    and the texts with a letter stay."""
    ship_package(spark)
    model = language_id.train(docs.filter(~language_id.held_out()))
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    kept = language_id.predict(docs, model).filter(F.col("lang_pred") != language_id.UND)
    return kept.select(*docs.columns)


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs``, staged, plus ``_key``, unique per row: ids may be null or repeat."""
    return stage(docs.withColumn("_key", F.monotonically_increasing_id()), name)


#: Rows by id, null last, then by key.
ORDER = ["doc_id is null as unnamed", "doc_id", "_key"]


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest id, then any
    one row of it."""
    rows = _keyed(docs, "exact-rows").withColumn("_order", F.struct(*map(F.expr, ORDER)))
    return exact_dedup.drop_copies(rows, "_order").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays, of
    equal ids any one."""
    ship_package(spark)
    rows = _keyed(docs, "near-rows")
    # a row alone in its component is its own label, so only the labels that
    # another row has as well are grouped
    label = stage(near_dedup.near_dedup(rows, "_key").select(
        F.col("doc_id").alias("_key"), F.col("component_id").alias("_comp")), "near-labels")
    shared = label.filter("_key != _comp").select("_comp").distinct()
    member = stage(label.join(shared, "_comp", "left_semi")
                   .join(rows.select("_key", "doc_id"), "_key"), "near-members")
    first = (member.groupBy("_comp").agg(F.min(F.struct(*map(F.expr, ORDER))).alias("o"))
             .select(F.col("o._key").alias("_key")))
    gone = member.select("_key").join(first, "_key", "left_anti")
    return rows.join(gone, "_key", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret; documents stay, with their new length."""
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: The tokenizer and the language model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
