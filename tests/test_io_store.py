"""Readers, writers, the chunk store (exactly-once batches) and the stream."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pagemill.operators import clean as cl
from pagemill.plans import fixtures as fx
from pagemill.plans import queries as q
from pagemill.sources import io
from pagemill.sources.store import ChunkStore
from pagemill.streaming.incremental import run_build_stream

from .conftest import SF001


def scratch():
    return tempfile.mkdtemp(prefix="pagemill-test-", dir="/tmp")


def write(path, obj_or_text):
    with open(path, "w") as f:
        f.write(obj_or_text if isinstance(obj_or_text, str) else json.dumps(obj_or_text))


def test_mixed_reader_counts_non_objects_as_errors(spark):
    d = scratch()
    write(os.path.join(d, "a.json"), [
        {"link": "l1", "Text": "T\n\nPublished May 1\n\nbody", "Title": "t"},
        5, "str", [1, 2], {"link": "l2", "_error": ""}, {"link": "l3", "Text": ""}])
    arts = io.read_mixed_articles(spark, d)
    assert [r["is_object"] for r in arts.orderBy("pos").collect()] == [True, False, False, False, True, True]
    s = cl.clean_stats(cl.clean_articles(arts)).first().asDict()
    assert s == {"total": 6, "cleaned": 1, "date_extracted": 1, "skipped_errors": 3, "skipped_no_text": 2}


def test_strict_and_lenient_readers(spark):
    d = scratch()
    write(os.path.join(d, "bad.json"), '[{"link": "a", ')
    with pytest.raises(Exception):
        io.read_articles(spark, d).collect()
    with pytest.raises(Exception):
        io.read_articles(spark, os.path.join(d, "missing")).collect()
    assert io.read_links(spark, os.path.join(d, "missing")).count() == 0
    assert io.read_links(spark, d).count() == 0
    ok = scratch()
    write(os.path.join(ok, "links.json"), ["u1", "u2", "u1"])
    assert [r["link"] for r in io.read_links(spark, ok).orderBy("pos").collect()] == ["u1", "u2", "u1"]
    out = os.path.join(scratch(), "links")
    io.write_links(io.read_links(spark, ok), out)
    assert [r["link"] for r in spark.read.parquet(out).orderBy("pos").collect()] == ["u1", "u2"]


def test_dataset_reader_last_value_first_position(spark):
    d = scratch()
    write(os.path.join(d, "ds.json"), [{"link": "a", "Title": "1"}, {"Title": "nolink"},
                                       {"link": "b"}, {"link": "a", "Title": "2"}, 7])
    got = {r["link"]: (r["pos"], r["title"]) for r in io.read_dataset(spark, d).collect()}
    assert got == {"a": (0, "2"), "b": (2, None)}
    assert io.read_dataset(spark, os.path.join(d, "missing")).count() == 0


def test_positions_unique_across_files(spark):
    d = scratch()
    write(os.path.join(d, "f1.json"), [{"link": "a", "Title": "1"}, {"link": "b"}])
    write(os.path.join(d, "f2.json"), [{"link": "a", "Title": "2"}, 7])
    pos = [r["pos"] for r in io.read_mixed_articles(spark, d).collect()]
    assert len(set(pos)) == 4
    got = {r["link"]: (r["pos"], r["title"]) for r in io.read_dataset(spark, d).collect()}
    assert got["a"] == (0, "2")            # later file wins, first position kept


def test_ledger_json_reader(spark):
    d = scratch()
    write(os.path.join(d, "processed.json"), {"processed_links": ["a", "b", "a"],
                                              "last_updated": "2024-05-01T10:00:00", "total_count": 2})
    assert sorted(r["link"] for r in io.read_ledger_json(spark, d).collect()) == ["a", "b"]
    assert io.read_ledger_json(spark, os.path.join(d, "none")).count() == 0
    assert io.read_ledger(spark, os.path.join(d, "none")).count() == 0


def test_store_incremental_equals_full_and_reruns_once(spark):
    arts = q.cleaned_articles(spark, SF001)
    inc = ChunkStore(spark, scratch(), embed=False)
    s0 = inc.build(arts.filter(F.col("pos") < 100)).first()
    inc.build(arts)
    again = inc.build(arts).first()
    assert again["chunks_added"] == 0 and again["articles_processed"] == 0
    full = ChunkStore(spark, scratch(), embed=False)
    full.build(arts)
    cols = ["chunk_id", "link", "chunk_text"]
    assert inc.chunks().select(cols).exceptAll(full.chunks().select(cols)).count() == 0
    assert inc.chunks().count() == full.chunks().count()
    # re-running a committed batch id adds nothing
    before = inc.chunks().count()
    inc.build(arts.filter(F.col("pos") < 100), batch_id=0)
    assert inc.chunks().count() == before and s0["batch_id"] == 0
    # forced rebuild empties both tables first
    r = inc.build(arts, rebuild=True).first()
    assert inc.chunks().count() == full.chunks().count() and r["chunks_added"] == full.chunks().count()
    assert inc.chunks().agg(F.min("chunk_no")).first()[0] == 1
    st = inc.stats().first()
    assert st["total_chunks"] == full.chunks().count()
    status = inc.status(arts).first()
    assert status["remaining"] == status["total_articles"] - status["processed_articles"]


def test_dead_runs_never_show(spark):
    """A run that died after writing, then a retry with nothing new."""
    arts = q.cleaned_articles(spark, SF001)
    st = ChunkStore(spark, scratch(), embed=False)
    junk = spark.createDataFrame([("id1", 1, "x", "t", "", "junk", None)],
                                 "chunk_id string, chunk_no long, link string, title string, "
                                 "publish_date string, chunk_text string, embedding array<float>")
    st._write(junk, st.chunks_path, "dead")
    st._write(spark.createDataFrame([("x", None)], "link string, processed_at timestamp"),
              st.ledger_path, "dead")
    assert st.chunks().count() == st.ledger().count() == 0
    st.build(arts.limit(0))
    assert st.chunks().count() == st.ledger().count() == 0
    st.build(arts)
    assert st.chunks().filter(F.col("chunk_text") == "junk").count() == 0 < st.chunks().count()


def test_epochs_and_batches_do_not_collide(spark):
    arts = q.cleaned_articles(spark, SF001)
    part = lambda a, b: arts.filter((F.col("pos") >= a) & (F.col("pos") < b))
    st = ChunkStore(spark, scratch(), embed=False)
    st.build(part(0, 40), run_key="s:0")
    st.build(part(40, 80))
    assert st.build(part(80, 120), run_key="s:1").first()["chunks_added"] > 0
    n = st.chunks().count()
    st.build(part(80, 120), run_key="s:1")            # delivered again
    assert st.chunks().count() == n and st.commits().count() == 3
    full = ChunkStore(spark, scratch(), embed=False)
    full.build(part(0, 120))
    assert full.chunks().count() == n
    st.clear()
    assert st.chunks().count() == st.ledger().count() == 0


def test_unreadable_log_is_not_an_empty_store(spark):
    st = ChunkStore(spark, scratch(), embed=False)
    os.makedirs(st.commits_path)
    write(os.path.join(st.commits_path, "part-0.parquet"), "no parquet")
    with pytest.raises(Exception):
        st.next_batch()


def test_clean_in_place_keeps_the_raw_files(spark):
    from pagemill.plans.jobs import clean_dataset
    d = scratch()
    raw = [{"link": "a", "Text": "x", "Extra": 1}, 7]
    write(os.path.join(d, "a.json"), raw)
    clean_dataset(spark, d, d)
    assert [json.loads(r[0]) for r in spark.read.text(d + "_backup").collect()] == [raw]
    for bad in ('[{"link": ', '{"link": "a"}'):
        b = scratch()
        write(os.path.join(b, "bad.json"), bad)
        with pytest.raises(Exception):
            clean_dataset(spark, b, b)
        assert os.listdir(b) == ["bad.json"]


def test_stream_equals_batch(spark):
    docs = fx.read_table(spark, SF001, "documents")
    store = ChunkStore(spark, scratch(), embed=False)

    def prepare(raw):
        return cl.clean_articles(fx.articles_from_documents(raw)).drop("clean_status", "extracted_date")

    run_build_stream(spark, SF001, docs.schema, store, os.path.join(scratch(), "ckpt"),
                     prepare=prepare, glob="documents.parquet")
    batch = ChunkStore(spark, scratch(), embed=False)
    batch.build(q.cleaned_articles(spark, SF001))
    cols = ["chunk_id", "chunk_no", "link", "title", "publish_date", "chunk_text"]
    assert store.chunks().select(cols).exceptAll(batch.chunks().select(cols)).count() == 0
    assert store.chunks().count() == batch.chunks().count() > 0


def test_stream_of_several_files_equals_batch(spark):
    src = scratch()
    arts = q.cleaned_articles(spark, SF001)
    # four files in position order; one file per micro-batch
    for i in range(4):
        (arts.filter((F.col("pos") >= i * 50) & (F.col("pos") < (i + 1) * 50))
         .coalesce(1).write.mode("overwrite").parquet(os.path.join(src, f"part{i}")))
    import glob
    import shutil
    import time
    flat = scratch()
    now = time.time() - 100
    for i, f in enumerate(sorted(glob.glob(os.path.join(src, "part*", "*.parquet")))):
        dst = os.path.join(flat, f"articles-{i}.parquet")
        shutil.copy(f, dst)
        os.utime(dst, (now + 10 * i, now + 10 * i))   # the source takes oldest files first
    store = ChunkStore(spark, scratch(), embed=False)
    run_build_stream(spark, flat, arts.schema, store, os.path.join(scratch(), "ckpt"),
                     max_files_per_trigger=1)
    assert store.commits().count() == 4
    batch = ChunkStore(spark, scratch(), embed=False)
    batch.build(arts)
    # ids follow arrival order; content must match whatever the order
    content = ["link", "title", "publish_date", "chunk_text"]
    a, b = store.chunks().select(content), batch.chunks().select(content)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ids = sorted(r["chunk_no"] for r in store.chunks().select("chunk_no").collect())
    assert ids == list(range(1, len(ids) + 1))
    # with files arriving in position order the ids match the batch build too
    cols = ["chunk_id", "chunk_no", "link", "chunk_text"]
    a, b = store.chunks().select(cols), batch.chunks().select(cols)
    assert a.exceptAll(b).count() == 0
