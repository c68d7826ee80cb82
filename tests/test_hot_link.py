"""A link that holds a third of the rows does not end up in one task."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators import index as ix

ROWS = 200_000
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    link = F.when(F.col("id") % 3 == 0, F.lit("https://h.org/hot")).otherwise(
        F.concat(F.lit("https://h.org/"), F.col("id")))
    yield spark.range(0, ROWS, 1, 8).select(
        F.col("id").alias("pos"), link.alias("link"), F.lit("Words.").alias("text"),
        F.lit(None).cast("string").alias("error"))
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_and_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_validate_splits_the_hot_link(spark, skewed):
    ledger = spark.createDataFrame([("https://h.org/1",)], "link string")
    rows, plan = rows_and_plan(ix.validate_articles(skewed, ledger))
    assert "skew=true" in plan
    by = {}
    for r in rows:
        by[r["skip_reason"]] = by.get(r["skip_reason"], 0) + 1
    hot = (ROWS + 2) // 3
    assert by == {None: ROWS - hot, ix.SKIP_IN_LEDGER: 1, ix.SKIP_DUPLICATE: hot - 1}


def test_unprocessed_splits_the_hot_link(spark, skewed):
    ledger = spark.createDataFrame([("https://h.org/1",)], "link string")
    rows, plan = rows_and_plan(ix.unprocessed_links(skewed, ledger))
    assert "skew=true" in plan
    assert len(rows) == ROWS - 1
