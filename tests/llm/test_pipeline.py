"""The pipeline against its stages' brute-force rules on a small table."""

import random

import corpus_pipeline as cp

from ..conftest import SF001
from .test_dedup import brute_components
from .test_packing import ids_of, verify
from .test_scan import brute


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    cols, seen = docs.columns, docs
    for name, step in cp.STAGES[:-1]:
        seen = cp.stage(step(spark, seen, SF001), f"test-{name}")
        assert seen.columns == cols, name
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = {i: t for i, t in texts.items() if any(map(str.isalpha, t or ""))}
    best = {}
    for i, t in sorted(left.items()):
        key = "".join(c for c in t if c not in " \t\n\x0b\x0c\r")
        if key not in best or len(t) > len(left[best[key]]):
            best[key] = i
    left = {i: left[i] for i in best.values()}
    left = {i: left[i] for i, (_, c) in brute_components(left).items() if c == i}
    got = {r["doc_id"]: r for r in seen.collect()}
    assert got.keys() == left.keys()
    for i, t in left.items():
        if not brute(t):
            assert got[i]["text"] == t or "[SECRET]" in got[i]["text"]
        else:
            assert "[SECRET]" in got[i]["text"] and not brute(got[i]["text"])
        assert got[i]["n_chars"] == len(got[i]["text"])
    rows = cp.run(spark, SF001).collect()
    final = {i: r["text"] for i, r in got.items()}
    used, least = verify(rows, dict(zip(final, ids_of(final.values()))))
    assert used <= least + 1


def test_no_label_no_model_and_no_loss(spark, make):
    docs = make(["some words", "123 !", None, "été"], lang=None)
    got = cp.identify_language(spark, docs, SF001)
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 3] and got.columns == docs.columns


def test_rows_with_repeated_or_null_ids_are_decided_by_row(spark, make):
    rng = random.Random(7)
    a, b, c, d = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(80)) for _ in range(4))
    near = a + " and a little more"
    docs = make([(1, a), (2, near), (2, b), (3, c), (3, c), (None, d), (None, d), (None, near + " x")])
    seen = cp.drop_near_copies(spark, cp.drop_exact_copies(spark, docs, SF001), SF001)
    assert seen.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"]) for r in seen.collect())
    assert got == [(0, d), (1, a), (2, b), (3, c)]
    alone = sorted((r["doc_id"] or 0, r["text"]) for r in cp.drop_near_copies(spark, docs, SF001).collect())
    assert alone == got
