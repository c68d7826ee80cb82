"""Cleaning functions: literal cases, and Spark vs DuckDB on fuzzed strings."""

import random

import pytest
from pyspark.sql import functions as F

from pagemill.functions import text as tx
from pagemill.operators import clean as cl
from pagemill.plans import oracle as orc

LF = "\n"


def one(spark, fn, value):
    df = spark.createDataFrame([(value,)], "s string")
    return df.select(fn(F.col("s")).alias("o")).first()["o"]


def stepwise(spark, steps, value):
    df = spark.createDataFrame([(value,)], "s string")
    return tx.apply_steps(df, "s", steps).first()["s"]


@pytest.mark.parametrize("value,expected", [
    ("T\nPublished  May 1, 2024 Update on GitHub\nx", "May 1, 2024"),
    ("it was Published in May\nx", "in May"),
    ("T\nPublished May 1", ""),
    ("Published May 1, 2024 Update on GitHub  \nx", "May 1, 2024 Update on GitHub"),
])
def test_extract_date(spark, value, expected):
    assert one(spark, tx.extract_date, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("T\n\nPublished May 1\n\nbody ", "body"),
    ("Published May 1\nbody", "Published May 1\nbody"),
    ("intro\nmore\nPublished here\nrest", "rest"),
])
def test_remove_header(spark, value, expected):
    assert one(spark, tx.remove_header, value) == expected


def test_nfkc(spark):
    assert one(spark, tx.normalize_unicode, "ﬁＡ ") == "fiA "
    assert one(spark, tx.normalize_unicode, "plain ascii") == "plain ascii"
    assert one(spark, tx.normalize_unicode, "è") == "è"
    assert one(spark, tx.normalize_unicode, None) is None


def test_control_chars(spark):
    assert one(spark, tx.remove_control_chars, "a\x00b\tc​\x7f\x9f\r") == "ab\tc​\r"


@pytest.mark.parametrize("value,expected", [
    ("## Head", "Head"),
    ("####### x", "####### x"),
    ("snake_case_x", "snakecasex"),
    ("* i\n* j", " i\n j"),
    ("**b** and __c__", "b and c"),
])
def test_markdown(spark, value, expected):
    assert one(spark, tx.clean_markdown, value) == expected
    assert stepwise(spark, tx.MARKDOWN_STEPS, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("a\n\n\n\nb  c \n d ", "a\n\nb c\n d"),
    ("a\n \n \nb", "a\n\n\nb"),
    ("x　\ny ", "x\ny"),
])
def test_whitespace(spark, value, expected):
    assert one(spark, tx.normalize_whitespace, value) == expected
    assert stepwise(spark, tx.WHITESPACE_STEPS, value) == expected


def test_clean_statuses_partition_rows(spark):
    df = spark.createDataFrame(
        [(0, "l0", None, "x"), (1, "l1", "", "x"), (2, "l2", "boom", "x"),
         (3, "l3", None, ""), (4, "l4", None, None), (5, "l5", None, "T\n\nPublished May 1\n\nbody")],
        "pos long, link string, error string, text string").withColumn(
        "publish_date", F.lit(None).cast("string"))
    out = {r["pos"]: r for r in cl.clean_articles(df).collect()}
    assert [out[i]["clean_status"] for i in range(6)] == [
        "cleaned", "cleaned", "skipped_error", "skipped_no_text", "skipped_no_text", "cleaned"]
    assert out[5]["text"] == "body" and out[5]["publish_date"] == "May 1"
    assert out[2]["text"] == "x"                       # skipped rows unchanged
    stats = cl.clean_stats(cl.clean_articles(df)).first()
    assert stats["total"] == stats["cleaned"] + stats["skipped_errors"] + stats["skipped_no_text"]


TOKENS = ["Published", " ", "  ", "\n", "\n\n", "\t", " ", "　", " ", "\x1c",
          "Update on GitHub", "#", "## ", "*", "**", "_", "__", "a", "bc", "x_y", "\r", "\x85"]


def fuzz(n, seed=7):
    rnd = random.Random(seed)
    return [(i, "".join(rnd.choice(TOKENS) for _ in range(rnd.randint(0, 25)))) for i in range(n)]


def test_fuzz_against_duckdb(spark, duck):
    data = fuzz(1500)
    sdf = spark.createDataFrame(data, "pos long, text string")
    got = {r["pos"]: (r["d"], r["h"], r["m"], r["w"]) for r in tx.apply_steps(
        tx.apply_steps(
            sdf.select("pos", "text",
                       tx.extract_date(F.col("text")).alias("d"),
                       tx.remove_header(F.col("text")).alias("h"),
                       F.col("text").alias("m"), F.col("text").alias("w")),
            "m", tx.MARKDOWN_STEPS), "w", tx.WHITESPACE_STEPS).collect()}
    duck.execute("create or replace temp table fz(pos bigint, text varchar)")
    duck.executemany("insert into fz values (?, ?)", data)
    exp = {r[0]: r[1:] for r in duck.sql(
        f"select pos, {orc.date_sql('text')}, {orc.header_sql('text')}, "
        f"{orc.markdown_sql('text')}, {orc.whitespace_sql('text')} from fz").fetchall()}
    bad = [p for p in got if got[p] != exp[p]]
    assert not bad, [(data[p][1], got[p], exp[p]) for p in bad[:3]]
