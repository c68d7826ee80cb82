"""Operator 7 against a dictionary of all windows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pagemill.llm import repeats as rp


def brute(texts):
    where = defaultdict(list)
    raw = {i: (t or "").encode() for i, t in texts.items()}
    for i, b in raw.items():
        for s in range(len(b) - rp.LENGTH + 1):
            where[b[s:s + rp.LENGTH]].append((i, s))
    mark = {i: np.zeros(len(b) + 2, bool) for i, b in raw.items()}
    for at in where.values():
        if len(at) > 1:
            for i, s in at:
                mark[i][s + 1:s + rp.LENGTH + 1] = True
    out = {}
    for i, b in raw.items():
        m = mark[i]
        kept = bytes(x for x, gone in zip(b, m[1:]) if not gone)
        out[i] = (len(b), int(m.sum()), int((m[1:] & ~m[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out


def run(df):
    return {r["doc_id"]: tuple(r)[1:] for r in rp.remove_repeats(df).collect()}


def crowd(seed, n):
    """Documents with shared passages at odd places, borders off by one, and
    passages just below and at the length."""
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    shared = [noise(k) for k in (399, 400, 401, 650, 1500)]
    texts = {}
    for i in range(n):
        parts = [noise(rng.randrange(500))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(shared)
            cut = rng.randrange(60) if rng.random() < 0.5 else 0
            parts += [p[cut:], noise(rng.randrange(300))]
        texts[i] = "".join(parts)
    return texts


def test_crowds(make):
    t = crowd(1, 150)
    t |= {1000: t[3] + "!", 1001: "ab" * 900, 1002: "é" * 500, 1003: "z" * 401, 1004: "y" * 400,
          1005: None, 1006: "", 1007: "short", 1008: "short", 1009: t[5], 1010: t[5], 1011: "q" * 30_000}
    assert run(make(list(t.items()))) == brute(t)


def test_crowded_anchors_by_windows(make, monkeypatch):
    monkeypatch.setattr(rp, "LIMIT", 3)
    t = crowd(2, 60)
    assert run(make(list(t.items()))) == brute(t)


@pytest.mark.parametrize("conf", [
    {"spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"},
    {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
     "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
     "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
     "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1"}])
def test_groups_stay_whole_beside_crowded_anchors(spark, make, monkeypatch, conf):  # noqa: F811
    """Groups of an anchor meet in one task however Spark would join them."""
    monkeypatch.setattr(rp, "LIMIT", 8)
    conf = conf | {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                   "spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    rng = random.Random(5)
    noise = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    common, pairs = noise(700), [noise(600) for _ in range(100)]
    texts = {i: noise(80) + pairs[i % 100] + noise(50) + (common if i % 10 == 0 else "") for i in range(200)}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert run(make(list(texts.items())).repartition(16)) == brute(texts)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_windows_of_crowded_anchors_leave_once():
    rng = random.Random(6)
    text = bytes(rng.randrange(97, 105) for _ in range(3000))
    pos, h = rp.anchors(text)
    ctx = pa.RecordBatch.from_arrays([pa.array(h), pa.array([1] * len(pos), pa.int64()), pa.array(pos), pa.array(
        [text[max(0, p - rp.SIDE):p + rp.LENGTH] for p in pos.tolist()], pa.binary())], names=["h", "d", "p", "c"])
    starts = [s for b in rp._windows(iter([ctx])) for s in b.column(1).to_pylist()]
    assert sorted(starts) == list(range(3000 - rp.LENGTH + 1))


def test_whole_table(docs01, texts01):
    assert run(docs01) == brute(texts01)


def test_what_is_left_of_every_text(make):
    rng = random.Random(8)
    noise = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    common = noise(700)
    head, tail = "ä" + common, "ö" + common          # the second byte of ä and ö differs
    rows = [(1, noise(90) + head + "x"), (2, tail + noise(80)), (3, noise(500)), (4, "é" * 300), (4, "é" * 300),
            (5, None), (6, "short"), (None, noise(60) + common)]
    got = {(r["doc_id"], bytes(r["kept"])) for r in rp.kept_bytes(make(rows)).collect()}
    left = lambda t: t.encode().replace(common.encode(), b"")
    assert got == {(i, b"" if i == 4 else left(t or "")) for i, t in rows}
    assert rp.kept_bytes(make(rows)).count() == len(rows)


def test_repeated_ids_and_empty(make):
    rows = [(1, "a" * 500), (1, "a" * 500), (1, "b"), (None, "c" * 450)]
    got = sorted(map(tuple, rp.remove_repeats(make(rows)).collect()), key=repr)
    assert sorted((r[0], r[2]) for r in got if r[0]) == [(1, 0), (1, 500), (1, 500)]
    assert [r[2] for r in got if r[0] is None] == [450]
    assert rp.remove_repeats(make([])).count() == 0


def test_small_batches_and_parts(make, monkeypatch):
    rng = random.Random(3)
    cols = np.array([[rng.randrange(2) for _ in range(40)] for _ in range(rp.WIDE)], np.int16)
    cols[:, 7] = cols[:, 3]
    cols[:500, 11] = cols[:500, 5]
    got = rp.repeated_ends(cols)
    want = np.zeros_like(got)
    for j in range(rp.LENGTH - 1, rp.WIDE):
        win = [bytes(cols[j - rp.LENGTH + 1:j + 1, c].astype(np.uint8)) for c in range(40)]
        for c in range(40):
            want[c, j] = win.count(win[c]) > 1
    assert (got == want).all()
    text = bytes(rng.randrange(97, 105) for _ in range(9000))
    whole = rp.anchors(text)
    monkeypatch.setattr(rp, "PART", 1000)
    for a, b in zip(whole, rp.anchors(text)):
        assert (a == b).all()
