"""Operator 11 against plain integer arithmetic."""
import hashlib

import numpy as np
import pytest

from pagemill.llm import plane_clustering as pc

SCHEMA = "vec_id long, embedding array<float>, id string, cluster int, planes string"


def brute(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())
    v = np.array([r[1] for r in kept])
    c = v[:k].copy()

    def assign():
        d = ((v[:, None, :] - c[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        a, _ = assign()
        for j in range(len(c)):
            if (a == j).any():
                c[j] = [int(s) // int((a == j).sum()) for s in v[a == j].sum(axis=0)]
    a, d = assign()
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c.tolist()]
    return sorted((r[0], int(j), int(x), int(d[a == j].sum()), int(d.sum()), sha[j])
                  for r, j, x in zip(kept, a, d))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 9, "y") for i, v in rows], SCHEMA)


def result(df):
    cols = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert df.columns == cols
    return sorted(tuple(r) for r in df.collect())


def test_planes_give_exact_products():
    rng = np.random.default_rng(5)
    for top in (1, 3, 100, 1 << 20, (1 << 27) - 1):
        x, c = rng.integers(-top, top, (50, 64)), rng.integers(-top // 2 - 1, top, (7, 64))
        px, pcs = pc.planes_of(x), pc.planes_of(c)
        assert (pc.bits(px) @ pc.weights(px.shape[1]) == x).all()
        assert (pc.dots(px, pcs) == x @ c.T).all()
        assert (pc.norms(px) == (x * x).sum(axis=1)).all()


def test_rows_with_fewer_planes_keep_their_sign():
    small, large = np.full((2, 64), -3), np.full((1, 64), 900)
    raw = [r.tobytes() for r in [*pc.planes_of(small), *pc.planes_of(large)]]
    x = pc.words_of(raw)
    assert (pc.bits(x) @ pc.weights(x.shape[1]) == np.concatenate([small, large])).all()


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(i, list(map(float, rng.normal(0, 0.4 + (i % 5), 64)))) for i in range(300)]
    rows += [(900 + i, rows[0][1]) for i in range(150)]        # a third are one vector
    rows += [(2000, None), (2001, []), (2002, [0.5] * 63), (2003, [0.5] * 65), (2004, [None] + [0.5] * 63),
             (2005, [float("nan")] + [0.5] * 63), (2006, [float("inf")] + [0.5] * 63), (2007, [0.0] * 64)]
    got = result(pc.report(frame(spark, rows).repartition(7)))
    assert got == brute(rows)


def test_few_or_no_vectors(spark):
    rows = [(3, [0.25] * 64), (1, [-0.25] * 64), (2, [0.25] * 64)]
    assert result(pc.report(frame(spark, rows))) == brute(rows)
    assert result(pc.report(frame(spark, []))) == []
    assert result(pc.report(frame(spark, [(1, None), (2, [1.0])]))) == []


def test_null_and_repeated_ids(spark):
    rows = [(None, [float(i)] * 64) for i in range(5)] + [(4, [9.0] * 64)] * 3
    got = pc.report(frame(spark, rows), k=2).collect()
    assert sorted(r["vec_id"] is None for r in got) == [False] * 3 + [True] * 5
    assert sum(r["distance"] for r in got) == got[0]["inertia"]


def test_components_that_cannot_be_exact_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        pc.report(frame(spark, [(1, [1e9] * 64)])).collect()
