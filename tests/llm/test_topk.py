"""Operator 13 against all products."""
import numpy as np
import pytest

from pagemill.llm import topk_search as ts

SCHEMA = "vec_id long, embedding array<float>, query_id string, rank int, score string"


def brute(rows, k=10):
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(kept):
        if q is None or q % 100:
            continue
        found = [(-sum(s * t for s, t in zip(x, y)), i is None, i or 0, i)
                 for b, (i, y) in enumerate(kept) if a != b]
        out += [(q, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 9, "y") for i, v in rows], SCHEMA)


def result(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(n, dim=64, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(0, 1, (n, dim)) + 2 * rng.normal(0, 1, (8, dim))[rng.integers(0, 8, n)]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, list(map(float, x))) for i, x in enumerate(v)]


@pytest.mark.parametrize("range_rows", [1 << 18, 100])
def test_equals_brute_force(spark, range_rows):
    rows = vectors(900)
    rows += [(1000 + i, rows[3][1]) for i in range(300)]         # a third: ties to the smaller id
    rows += [(5000, None), (5100, [None] * 64), (5200, [float("nan")] * 64), (5300, [float("-inf")] * 64),
             (5400, [0.0] * 64), (-100, [-1.0] * 64)]
    assert result(ts.top_k(frame(spark, rows).repartition(5), range_rows=range_rows)) == brute(rows)


def test_other_lengths_repeats_and_null_ids(spark):
    rows = vectors(60, 20) + [(100, [1.0]), (100, [1.0]), (200, []), (300, [0.5] * 90), (None, [3.0] * 20),
                              (None, None), (7, [0.25] * 90)]
    assert result(ts.top_k(frame(spark, rows))) == brute(rows)


def test_few_rows_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (100, [1.0, -2.0]), (5, [0.0, 0.5])]
    assert result(ts.top_k(frame(spark, rows))) == brute(rows)
    assert result(ts.top_k(frame(spark, rows[:1]))) == []
    assert result(ts.top_k(frame(spark, []))) == []
    assert result(ts.top_k(frame(spark, [(3, [1.0])]))) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i * 50, list(map(float, rng.normal(0, 60_000, 64)))) for i in range(60)]
    assert result(ts.top_k(frame(spark, rows))) == brute(rows)
    with pytest.raises(Exception, match="beyond"):
        ts.top_k(frame(spark, [(0, [1e9])])).collect()


def test_bounds_compact_and_lose_nothing(monkeypatch):
    """Small tiles: the floor rises while the blocks go by, and most
    candidates are dropped before the last dimensions."""
    rows = vectors(3000)
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64).T
    block = ts.Block(np.arange(3000), np.arange(3000), np.ones(3000, bool), x)
    q = block.take(np.arange(0, 3000, 100))
    seen = []
    einsum = np.einsum
    monkeypatch.setattr(ts.np, "einsum", lambda s, a, b: seen.append(a.shape[1]) or einsum(s, a, b))
    best = ts.search(q, np.full(30, ts.NONE), block, 10, tile=256)
    assert sum(seen) < 30 * 3000
    scores = q.x.T @ x
    for j in range(30):
        s = scores[j].copy()
        s[q.keys[j]] = -(1 << 62)
        want = sorted(zip(-s, np.arange(3000)))[:10]
        mine = best.rows[0] == j
        assert list(zip(best.rows[1][mine], best.rows[3][mine])) == want
