"""Operators 3 and 8 against brute force."""

import random
import re
from collections import defaultdict

import numpy as np

from pagemill.llm import exact_dedup, near_dedup
from tools.oracle_check import compare

from ..conftest import SF01


def brute_sets(texts):
    out = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    return out


def brute_components(texts):
    sets = brute_sets(texts)
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    shared = defaultdict(int)
    for ids in by.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[a], ids[b]] += 1
    up = {i: i for i in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in texts}


def near(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_dedup(df).collect()}


def test_near_whole_table(docs01, texts01):
    assert near(docs01) == brute_components(texts01)


def test_near_edges(make):
    t = {0: None, 1: "", 2: " \n", 3: "One two", 4: "one  TWO", 5: "a b c d e", 6: "a b c d e\n",
         7: "x" * 200_000, 8: "É b c d e", 9: "é b c d e"}
    assert near(make(list(t.items()))) == brute_components(t)
    assert near(make([])) == {}


def test_near_chains_and_crowds(make):
    """Chains whose ends are not similar, crowds of near copies whose members
    are not all similar to the hub, and two crowds that share words."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts, chain = {}, [word() for _ in range(200)]
    for i in range(12):
        texts[i] = " ".join(chain)
        at = rng.randrange(180)
        chain = chain[:at] + [word() for _ in range(3)] + chain[at + 3:]
    base = [word() for _ in range(120)]
    other = base[:60] + [word() for _ in range(60)]
    for i in range(100, 420):
        d = list(base if i % 3 else other)
        for _ in range(rng.randrange(5)):
            d[rng.randrange(len(d))] = word()
        texts[i] = " ".join(d)
    assert near(make(list(texts.items()))) == brute_components(texts)


def test_near_crowd_with_shorter_copies(make):
    """Copies with words replaced or left out, many of them below the
    threshold to the original but not to each other."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    texts = {500: " ".join(base)}
    for i in range(160):
        d = list(base)
        for _ in range(rng.randrange(9)):
            d[rng.randrange(len(d))] = f"v{rng.randrange(10**6)}"
        if i % 2:
            at, n = rng.randrange(100), rng.randrange(45)
            d = d[:at] + d[at + n:]
        texts[i] = " ".join(d)
        if i % 5 == 0:
            d[rng.randrange(len(d))] = "again"
            texts[200 + i] = " ".join(d)
    assert near(make(list(texts.items()))) == brute_components(texts)


def test_crowd_below_the_threshold_leaves_few_pairs(make, monkeypatch):
    """Copies with words replaced from a small vocabulary share rare shingles
    with many others, but few of the pairs can be linked."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(400):
        d = list(base)
        for _ in range(rng.randrange(13)):
            d[rng.randrange(len(d))] = f"v{rng.randrange(4)}"
        texts[i] = " ".join(d)
    made, write = {}, near_dedup.stage

    def counted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out
    monkeypatch.setattr(near_dedup, "stage", counted)
    assert near(make(list(texts.items()))) == brute_components(texts)
    assert made["near-asks-mixed"] and made["near-more"] <= 2 * len(texts)


def test_marks_lose_no_link(spark):
    """The bound holds for sets of up to five times as many shingles as marks,
    and is exact where places do not collide and nothing is novel."""
    rng = np.random.default_rng(4)
    rows, linked = [], []
    for k in range(600):
        hub = np.unique(rng.integers(0, 1 << 62, rng.integers(8, 1300)).astype(np.uint64))
        extra = rng.integers(0, 1 << 62, len(hub) // 2 + 1).astype(np.uint64)
        # a common variant of the hub, then each member's own changes
        base = np.union1d(hub[rng.random(len(hub)) > 0.3], extra[rng.random(len(extra)) > 0.5])
        u, c = (np.union1d(base[rng.random(len(base)) > p], extra[rng.random(len(extra)) > 1 - p / 4])
                for p in rng.random(2) * 0.35)
        row = [k, len(hub)]
        for x in (u, c):
            new = np.setdiff1d(x, hub)
            row += [len(x), len(x) - len(new), near_dedup.marks(x, hub, new).tolist()]
        rows.append(row)
        both = len(np.intersect1d(u, c))
        linked.append(100 * both >= 75 * (len(u) + len(c) - both))
    df = spark.createDataFrame(rows, "k long, nb long, nu long, bu long, mu array<long>, "
                                     "nc long, bc long, mc array<long>")
    may = {r["k"] for r in df.filter(near_dedup._may_link()).collect()}
    assert {k for k, x in enumerate(linked) if x} <= may and 100 < sum(linked) < len(may) < 600


def test_groups_by_join_and_by_blocks(spark, make, monkeypatch):
    """All pairs across components of one group of 150, either way."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(150):
        d = list(base)
        for _ in range(rng.randrange(12)):
            d[rng.randrange(60)] = f"v{rng.randrange(10**6)}"
        texts[i] = " ".join(d)
    sets = brute_sets(texts)
    want = {(a, b) for a in texts for b in range(a)
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    df = make(list(texts.items()))
    sigs = near_dedup.sign(df).select("doc_id", "sig")
    far = df.selectExpr("1L as key", "doc_id")
    none = spark.createDataFrame([], "id long, comp long")
    for small in (1000, 4):
        monkeypatch.setattr(near_dedup, "SMALL", small)
        monkeypatch.setattr(near_dedup, "BLOCK", 16)
        got = {tuple(r) for r in near_dedup._by_groups(far, none, sigs).select("a", "b").collect()}
        close = {tuple(r) for r in near_dedup._near(
            spark.createDataFrame(sorted(got), "a long, b long"), sigs, near_dedup.FLOOR).collect()}
        assert want <= got and want <= close


def test_exact_oracle(spark):
    assert compare(spark, SF01, ["op8_exact_dedup"]) == []


def test_exact_edges(spark, make):
    df = make([(0, None), (1, ""), (2, "\t \x0b"), (3, "a b"), (4, "ab"), (5, " a b"), (6, "a b"),
               (7, "x" * 100_000), (None, "ab"), (9, "q"), (9, "q")]).withColumn("sha", __import__(
                   "pyspark.sql.functions", fromlist=["lit"]).lit("clash"))
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"])
                  for r in exact_dedup.decide(df).collect()), key=repr)
    want = sorted([(0, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True), (3, 5, 4, False),
                   (4, 5, 4, False), (5, 5, 4, True), (None, 5, 4, False), (6, 6, 1, True),
                   (7, 7, 1, True), (9, 9, 2, True), (9, 9, 2, True)], key=repr)
    assert got == want
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5, 6, 7, 9, 9]
    assert exact_dedup.decide(make([])).count() == 0


def test_exact_filter_may_be_full(monkeypatch, make):
    """A saturated filter sends every row through the shuffle; same result."""
    df = make([f"t{i % 60}" for i in range(100)])
    want = sorted(map(tuple, exact_dedup.decide(df).collect()))
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 64)
    assert sorted(map(tuple, exact_dedup.decide(df).collect())) == want
