"""Attempts in any number and order of files give the folds of one batch."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from pagemill.operators import attempts as fb
from pagemill.plans import fixtures as fx
from pagemill.streaming import fetch

from .conftest import SF001

COLUMNS = ["link", "ok", "rounds", "payload", "error"]


def scratch():
    return tempfile.mkdtemp(prefix="pagemill-fold-", dir="/tmp")


def rows(df):
    return sorted(str(r.asDict(True)) for r in df.select(COLUMNS).collect())


def stream(spark, files, out, checkpoint, source):
    for i, df in files:
        df.coalesce(1).write.parquet(os.path.join(source, f"part{i}"))
    fetch.run_fold_stream(spark, os.path.join(source, "*"), files[0][1].schema, out, checkpoint,
                          max_files_per_trigger=1)


def test_streams_equal_the_batch_fold(spark):
    att = fx.fetch_attempts(spark, SF001).select("link", "round", "attempt", "error", "payload").cache()
    want = rows(fb.round_fold(att))
    assert rows(fetch.link_folds(att)) == want
    for seed, n in ((0, 1), (1, 3)):
        out, ckpt, source = (os.path.join(scratch(), x) for x in ("out", "ckpt", "in"))
        part = F.pmod(F.xxhash64("link", "round", "attempt", F.lit(seed)), F.lit(n))
        order = list(range(n))
        random.Random(seed).shuffle(order)
        stream(spark, [(i, att.filter(part == k)) for i, k in enumerate(order)], out, ckpt, source)
        assert rows(fetch.folds(spark, out)) == want
    # files delivered later, one of them again: only what changed is written
    again = att.filter("attempt = 1")
    stream(spark, [(90, again)], out, ckpt, source)
    assert rows(fetch.folds(spark, out)) == want
    fetch.compact(spark, out, out + "_small")
    assert rows(fetch.folds(spark, out + "_small")) == want
    assert len([d for d in os.listdir(out + "_small") if d.startswith("epoch=")]) == 1


def test_a_late_success_replaces_the_error(spark):
    ddl = "link string, round int, attempt int, error string, payload struct<title:string>"
    first = spark.createDataFrame([("a", 2, 1, "e2", None), ("b", 1, 1, None, ("B",)), ("c", 9, 1, None, ("late",)),
                                   (None, 1, 1, "x", None), ("d", 1, 1, "e1", None)], ddl)
    second = spark.createDataFrame([("a", 1, 3, None, ("A",)), ("b", 1, 2, None, ("no",)), ("d", 3, 1, "e3", None)], ddl)
    out, ckpt, source = (os.path.join(scratch(), x) for x in ("out", "ckpt", "in"))
    stream(spark, [(0, first)], out, ckpt, source)
    got = {r["link"]: (r["ok"], r["rounds"], r["error"]) for r in fetch.folds(spark, out).collect()}
    assert got == {"a": (False, 2, "e2"), "b": (True, 1, None), "d": (False, 1, "e1")}
    stream(spark, [(1, second)], out, ckpt, source)
    got = {r["link"]: (r["ok"], r["rounds"], r["payload"] and r["payload"]["title"], r["error"])
           for r in fetch.folds(spark, out).collect()}
    assert got == {"a": (True, 1, "A", None), "b": (True, 1, "B", None), "d": (False, 3, None, "e3")}
    dataset = spark.createDataFrame([(0, "d", "old", None)], "pos long, link string, title string, error string")
    links = spark.createDataFrame([(0, "a"), (1, "b"), (2, "d")], "pos long, link string")
    after = fb.upsert(dataset, fetch.folds(spark, out), links).orderBy("pos").collect()
    assert [(r["link"], r["title"], r["error"]) for r in after] == [("d", None, "e3"), ("a", "A", None), ("b", "B", None)]
