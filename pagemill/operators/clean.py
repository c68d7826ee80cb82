"""Article cleaning (CL7-CL9): a narrow plan, no shuffle except the stats row.

Rows are classified first and only rows classified ``cleaned`` get new text.
Skipped rows pass through unchanged, so writing the result gives the same
shape as the input (IO7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

CLEANED = "cleaned"
SKIPPED_ERROR = "skipped_error"
SKIPPED_NO_TEXT = "skipped_no_text"


def flagged(error: Column) -> Column:
    """The cleaner's and chunker's notion of failure: a non-empty ``_error``."""
    return F.coalesce(error, F.lit("")) != ""


def clean_status(df: DataFrame) -> Column:
    """One of cleaned / skipped_error / skipped_no_text for every row.

    ``is_object`` (present when read through the mixed-entry reader) marks
    array entries that were not JSON objects; they count as errors.
    """
    status = F.when(flagged(F.col("error")), F.lit(SKIPPED_ERROR))
    if "is_object" in df.columns:
        status = F.when(~F.col("is_object"), F.lit(SKIPPED_ERROR)).when(
            flagged(F.col("error")), F.lit(SKIPPED_ERROR))
    return (status.when(F.coalesce(F.col("text"), F.lit("")) == "", F.lit(SKIPPED_NO_TEXT))
            .otherwise(F.lit(CLEANED)))


def clean_articles(df: DataFrame, extract_dates: bool = True, nfkc: bool = True) -> DataFrame:
    """CL8: replace ``text`` (and ``publish_date`` when a date was found).

    Adds ``clean_status`` and ``extracted_date``; ``raw`` columns are not kept.
    """
    status = clean_status(df)
    is_clean = F.col("clean_status") == CLEANED
    date = tx.extract_date(F.col("text")) if extract_dates else F.lit("")
    staged = (df.withColumn("clean_status", status)
              .withColumn("extracted_date", F.when(is_clean, date))
              .withColumn("_clean", F.when(is_clean, F.col("text"))))
    staged = tx.apply_steps(staged, "_clean", tx.clean_steps(nfkc))
    return (staged
            .withColumn("text", F.when(is_clean, F.col("_clean")).otherwise(F.col("text")))
            .withColumn("publish_date",
                        F.when(is_clean & (F.col("extracted_date") != ""),
                               F.col("extracted_date")).otherwise(F.col("publish_date")))
            .drop("_clean"))


STATS = ["total", "cleaned", "date_extracted", "skipped_errors", "skipped_no_text"]


def stats_columns() -> list[Column]:
    """The counters of CL9; statuses partition the rows."""
    st = F.col("clean_status")
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(st == CLEANED).alias("cleaned"),
        F.count_if((st == CLEANED) & (F.col("extracted_date") != "")).alias("date_extracted"),
        F.count_if(st == SKIPPED_ERROR).alias("skipped_errors"),
        F.count_if(st == SKIPPED_NO_TEXT).alias("skipped_no_text"),
    ]


def clean_stats(cleaned: DataFrame) -> DataFrame:
    """CL9: one row of counters."""
    return cleaned.agg(*stats_columns())
