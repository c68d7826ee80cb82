"""Operator 2: held-out accuracy, fixed cases, and scores by brute force."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import language_id as li


def test_held_out_accuracy(docs01):
    got = {r["doc_id"]: r for r in li.identify(docs01).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs01.collect()}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [i for i, r in got.items() if r["held_out"]]
    right = sum(got[i]["lang_pred"] == truth[i] for i in held)
    assert len(held) > 150 and right / len(held) >= 0.97


def test_labels_and_ids_are_not_inputs(docs01):
    model = li.train(docs01.filter(~li.held_out()))
    a = li.predict(docs01.select("doc_id", "text"), model)
    b = li.predict(docs01.select("doc_id", "text", F.lit("zz").alias("lang")), model).drop("lang")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_edges(make, spark):
    t = ["", None, "123 _ !? ²", "a", "the of and " * 20_000]
    df = make(t).withColumn("lang_score", F.lit("clash")).drop("lang_score")
    got = {r["doc_id"]: r for r in li.identify(df).collect()}
    assert [got[i]["lang_pred"] for i in range(5)] == ["und", "und", "und", "en", "en"]
    assert [got[i]["score"] for i in range(3)] == [0, 0, 0]
    assert {r["lang_pred"] for r in li.identify(make(["a b", "c d"], lang=None)).collect()} == {"und"}
    assert li.identify(make([])).count() == 0


def test_batch_scores_equal_one_by_one(texts01):
    rng = np.random.RandomState(0)
    model = li.Model(["a", "b"], rng.randn(li.BUCKETS, 2).astype(np.float32), np.zeros(2))
    raw = [None, "", "x", *list(texts01.values())[:40], "é"]
    langs, scores = li.score_texts(model, raw)
    for t, lang, s in zip(raw, langs, scores):
        one_lang, one = li.score_texts(model, [t])
        assert (one_lang[0], round(float(one[0]), 9)) == (lang, round(float(s), 9))
        p = li.plain(t)
        if lang != "und":
            hs, oks, _ = li.grams([p])
            total = sum(model.logp[h[ok]].astype(float).sum(axis=0) for h, ok in zip(hs, oks))
            assert model.langs[int(np.argmax(total))] == lang
