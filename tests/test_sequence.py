"""Bucketed prefix sums against a brute-force window, with a hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill.operators.sequence import prefix_sum, row_number


def test_row_number_hot_key_matches_window(spark):
    rnd = random.Random(5)
    # key "hot" holds about a third of the rows, spread over many buckets
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 40)}", i, rnd.randint(0, 9))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "key string, t long, v long")
    got = row_number(df, ["key"], ["t"], bucket=F.shiftright("t", 6), name="rn")
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("t")))
    assert got.select("key", "t", "rn").exceptAll(exp.select("key", "t", "rn")).count() == 0
    assert got.count() == 6000


def test_global_prefix_sum_matches_window(spark):
    rnd = random.Random(9)
    rows = [(i * 3 + rnd.randint(0, 2), rnd.randint(0, 5)) for i in range(20000)]
    df = spark.createDataFrame(rows, "pos long, n long")
    got = prefix_sum(df, [], ["pos"], bucket=F.shiftright("pos", 5), value=F.col("n"), name="off")
    w = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("off", F.coalesce(F.sum("n").over(w), F.lit(0)))
    assert got.select("pos", "off").exceptAll(exp.select("pos", "off")).count() == 0
