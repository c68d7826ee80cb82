"""Splitter contract, chunk ids and the index build quirks."""

import random

from pyspark.sql import functions as F

from pagemill.functions import splitter as sp
from pagemill.functions.text import WS_CHARS
from pagemill.operators import index as ix
from pagemill.plans import oracle as orc


def fuzz_texts(n, seed=3):
    rnd = random.Random(seed)
    toks = ["a", "bb", "ccc", " ", "  ", "\n", "\n\n", "\n\n\n", "xyz ", "\t", " 　"]
    return [(i, "".join(rnd.choice(toks) for _ in range(rnd.randint(0, 40)))) for i in range(n)]


def test_split_properties():
    for _, t in fuzz_texts(2000):
        chunks = sp.split_text(t, 20, 6)
        assert all(0 < len(c) <= 20 for c in chunks)
        assert all(c == c.strip(WS_CHARS) for c in chunks)
        # every non-space character survives in order
        assert "".join(t.split()) in "".join("".join(c.split()) for c in chunks) or len(chunks) > 1
        assert bool(chunks) == bool(t.strip(WS_CHARS))


def test_split_examples():
    assert sp.split_text("") == [] and sp.split_text(None) == [] and sp.split_text(" \n ") == []
    assert sp.split_text("  short text \n") == ["short text"]
    assert sp.split_text("aaaa bbbb cccc", 10, 5) == ["aaaa bbbb", "bbbb cccc"]
    assert sp.split_text("aaaa bbbb cccc", 9, 4) == ["aaaa bbbb", "cccc"]   # " bbbb" > overlap
    assert sp.split_text("p1 p1\n\np2 p2", 7, 0) == ["p1 p1", "p2 p2"]
    assert sp.split_text("abcdefgh", 3, 1) == ["abc", "cde", "efg", "gh"]


def test_split_matches_sql_fold(duck):
    data = fuzz_texts(1500, seed=11)
    duck.execute("create or replace temp table ck(pos bigint, text varchar)")
    duck.executemany("insert into ck values (?, ?)", data)
    got = {}
    for p, ci, c in duck.sql(orc.chunks_sql("select * from ck", 20, 6)).fetchall():
        got.setdefault(p, {})[ci] = c
    for p, t in data:
        exp = sp.split_text(t, 20, 6)
        assert [got.get(p, {})[k] for k in sorted(got.get(p, {}))] == exp, t


def test_chunk_column_and_yields_chunks(spark):
    data = fuzz_texts(300, seed=5) + [(1000, None), (1001, ""), (1002, " 　\n")]
    df = spark.createDataFrame(data, "pos long, text string")
    out = df.select("pos", "text", sp.chunk_column(F.col("text"), 20, 6).alias("c"),
                    ix.yields_chunks(F.col("text")).alias("y")).collect()
    for r in out:
        assert r["c"] == sp.split_text(r["text"], 20, 6)
        assert r["y"] == (len(r["c"]) > 0)


def test_native_splitter_matches(spark):
    data = fuzz_texts(500, seed=21) + [(2000, None), (2001, "x" * 45 + "\n\n" + "y z " * 9)]
    df = spark.createDataFrame(data, "pos long, text string")
    out = df.select("text", sp.chunk_column_native(F.col("text"), 20, 6).alias("c")).collect()
    for r in out:
        assert r["c"] == sp.split_text(r["text"], 20, 6), r["text"]


def articles(spark, rows):
    return spark.createDataFrame(
        rows, "pos long, link string, title string, publish_date string, text string, error string")


def test_index_quirks(spark):
    arts = articles(spark, [
        (0, "a", "A", None, "alpha text", None),
        (1, "a", "A2", None, "again", None),          # second occurrence: skipped, counted new
        (2, "b", None, None, "", None),               # no text: not processed, not in ledger
        (3, "b", "B", "d", "beta", None),             # later occurrence with text is processed
        (4, None, "N", None, "no link", None),        # missing link -> key ""
        (5, None, "N2", None, "no link 2", None),     # second link-less article skipped
        (6, "c", "C", None, "gamma", "boom"),         # flagged error
        (7, "d", "D", None, "delta", None),           # already in ledger
        (8, "e", "E", None, "   ", None),             # blank text: no chunks
    ])
    ledger = spark.createDataFrame([("d", None)], "link string, processed_at timestamp")
    v = ix.validate_articles(arts, ledger)
    got = {r["pos"]: (r["new"], r["visited"], r["skip_reason"]) for r in v.collect()}
    assert got[0] == (True, True, None)
    assert got[1] == (True, True, "already_processed")
    assert got[2] == (True, True, "no_text")
    assert got[3] == (True, True, None)
    assert got[4] == (True, True, None)
    assert got[5] == (True, True, "already_processed")
    assert got[6] == (False, False, "error")
    assert got[7] == (False, False, "in_ledger")
    assert got[8] == (True, True, "no_chunks")
    chunks = ix.assign_chunks(ix.to_process(v, arts), base_id=10)
    c = sorted((r["chunk_no"], r["chunk_id"], r["link"], r["title"], r["publish_date"])
               for r in chunks.collect())
    assert c == [(11, "id11", "a", "A", ""), (12, "id12", "b", "B", "d"),
                 (13, "id13", "", "N", "")]
    stats = ix.build_stats(v, chunks).first().asDict()
    assert stats == {"total_articles": 9, "new_articles": 7, "chunks_added": 3,
                     "articles_processed": 3, "articles_skipped": 4, "errors": 0}
    marks = sorted(r["link"] for r in ix.ledger_marks(v).collect())
    assert marks == ["", "a", "b"]


def test_ids_dense_and_ordered(spark):
    rows = [(i, f"l{i}", "t", None, ("word " * (i % 7 * 60)).strip() or "x", None) for i in range(3000)]
    arts = articles(spark, rows)
    empty = spark.createDataFrame([], "link string, processed_at timestamp")
    chunks = ix.assign_chunks(ix.to_process(ix.validate_articles(arts, empty), arts), base_id=0)
    got = [(r["article_pos"], r["chunk_index"], r["chunk_no"]) for r in chunks.collect()]
    got.sort()
    assert [g[2] for g in got] == list(range(1, len(got) + 1))
