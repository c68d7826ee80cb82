"""The three runs end to end on files derived from the driver tables."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from pagemill.plans import fixtures as fx
from pagemill.plans import jobs
from pagemill.sources import io
from pagemill.sources.store import ChunkStore

from .conftest import SF001


def scratch():
    return tempfile.mkdtemp(prefix="pagemill-job-", dir="/tmp")


def test_clean_then_index(spark):
    src = os.path.join(scratch(), "articles")
    io.write_json_arrays(io.article_json(fx.articles(spark, SF001)), src, bits=6)
    stats = jobs.clean_dataset(spark, src, src + "_clean").first().asDict()
    assert stats == {"total": 200, "cleaned": 179, "date_extracted": 134,
                     "skipped_errors": 12, "skipped_no_text": 9}
    out = jobs.build_index(spark, src + "_clean", os.path.join(scratch(), "store"), embed=False)
    first = out["stats"].first()
    assert first["chunks_added"] > 0 and first["errors"] == 0
    again = jobs.build_index(spark, src + "_clean", out["store"].first()["vector_store_path"],
                             embed=False)["stats"].first()
    assert again["chunks_added"] == 0


def test_clean_in_place_keeps_backup(spark):
    d = scratch()
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump([{"link": "l", "Text": "T\n\nPublished May 1\n\n**body**"}, 3], f)
    stats = jobs.clean_dataset(spark, d, d).first()
    assert stats["cleaned"] == 1 and stats["skipped_errors"] == 1
    assert len(json.loads(spark.read.text(d + "_backup").first()[0])) == 2
    assert spark.read.parquet(d).filter(F.col("link") == "l").first()["text"] == "body"


def test_crawl_first_run_then_update(spark):
    pages = fx.listing_pages(spark, SF001).select("page_no", "html")
    att = fx.fetch_attempts(spark, SF001)
    root = scratch()
    links, ds = os.path.join(root, "links"), os.path.join(root, "dataset")
    out = jobs.crawl_update(spark, pages, att, links, ds, ds + "_1")
    n_links = spark.read.parquet(links).count()
    assert n_links > 0 and out["report"].first()["total"] == 0   # attempts hold other links
    # second run: page 0 is compared with the saved list
    out2 = jobs.crawl_update(spark, pages, att, links, ds + "_1", ds + "_2")
    assert out2["new_links"].count() == 0
    assert spark.read.parquet(links).count() == n_links          # rewritten in place


def test_crawl_folds_attempts_for_discovered_links(spark):
    pages = fx.listing_pages(spark, SF001).select("page_no", "html")
    root = scratch()
    links, ds = os.path.join(root, "links"), os.path.join(root, "dataset")
    # discover links first (no attempts yet), then fold attempts for three of them
    empty = spark.createDataFrame([], "link string, round int, attempt int, error string, "
                                      "payload struct<title:string,text:string>")
    jobs.crawl_update(spark, pages, empty, links, ds, ds + "_0")
    first3 = [r["link"] for r in spark.read.parquet(links).orderBy("pos").limit(3).collect()]
    att = spark.createDataFrame([
        (first3[0], 1, 1, None, ("T0", "body0")),
        (first3[1], 1, 1, "e1", None), (first3[1], 1, 2, None, ("T1", "body1")),
    ] + [(first3[2], r, a, f"down {r}.{a}", None) for r in range(1, 6) for a in range(1, 4)],
        "link string, round int, attempt int, error string, payload struct<title:string,text:string>")
    out = jobs.crawl_update(spark, pages, att, links, ds + "_0", ds + "_1")
    rep = out["report"].first()
    assert (rep["total"], rep["successful"], rep["failed"]) == (3, 2, 1)
    assert [r["error"] for r in out["failed"].collect()] == ["down 5.3"]
    got = {r["link"]: r["title"] for r in spark.read.parquet(ds + "_1").collect()}
    assert got[first3[0]] == "T0" and got[first3[1]] == "T1"


def test_runs_chain_from_crawl_to_index(spark):
    pages = fx.listing_pages(spark, SF001).select("page_no", "html")
    root = scratch()
    links, ds = os.path.join(root, "links"), os.path.join(root, "dataset")
    att = spark.createDataFrame(
        [("https://example.org/x", 1, 1, None, ("T", "Published May 3, 2024 x\n\nSome  body"))],
        "link string, round int, attempt int, error string, payload struct<title:string,text:string>")
    jobs.crawl_update(spark, pages, att, links, ds, ds + "_0")
    first = spark.read.parquet(links).orderBy("pos").first()["link"]
    att = att.withColumn("link", F.lit(first))
    jobs.crawl_update(spark, pages, att, links, ds + "_0", ds)
    before = spark.read.parquet(ds).count()
    stats = jobs.clean_dataset(spark, ds, ds, source="parquet").first()
    assert (stats["total"], stats["cleaned"]) == (1, 1)
    assert spark.read.parquet(ds + "_backup").count() == before
    out = jobs.build_index(spark, ds, os.path.join(root, "store"), embed=False)["stats"].first()
    assert (out["articles_processed"], out["errors"]) == (1, 0)


def test_failing_row_is_reported_and_neighbours_are_indexed(spark):
    arts = spark.createDataFrame(
        [(0, "a", "good one"), (1, "b", "poison"), (2, "c", "good two")],
        "pos long, link string, text string").selectExpr(
        "pos", "link", "'t' as title", "text", "cast(null as string) as publish_date",
        "cast(null as string) as error")

    def model(texts):
        if (texts == "poison").any():
            raise ValueError("bad text")
        return [[1.0, 2.0]] * len(texts)

    store = ChunkStore(spark, os.path.join(scratch(), "store"), model=model)
    stats = store.build(arts.coalesce(1)).first()
    assert (stats["errors"], stats["articles_processed"], stats["chunks_added"]) == (1, 2, 2)
    assert [tuple(r)[:2] for r in store.errors().select("link", "reason").collect()] == [
        ("b", "ValueError: bad text")]
    assert sorted(r["link"] for r in store.ledger().collect()) == ["a", "c"]
    assert {tuple(r["embedding"]) for r in store.chunks().collect()} == {(1.0, 2.0)}
