"""Operator 12 against counting in Python."""
import random
import re
from collections import Counter, defaultdict

import pytest

from pagemill.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, digest string"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=30, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = WORD.findall((text or "").translate(lower))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for (lang, source), n in groups.items():
        kept = [t for t, c in docs[lang].items() if c >= min_docs]
        of = {s: g for (la, s), g in groups.items() if la == lang}
        whole = sum(of.values(), Counter())

        def share(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p = {s: share(c) for s, c in of.items()}
        q = share(whole)
        pair = [(-sum(abs(p[source][t] - p[s][t]) for t in kept), s.encode(), s) for s in of if s != source]
        term = [(q[t] - p[source][t], t.encode(), t) for t in kept if n[t] and p[source][t] > q[t]]
        for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
            out += [(lang, source, part, item, -v, r) for r, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, "x", 1, "y") for i, (t, la, s) in enumerate(rows)], SCHEMA)


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "été", "Ünï", "ÀB", "x", "日本", "naïve", "zz", "it", "s"] + [
        f"{a}{b}" for a in "qwertyuiop" for b in "asdfgh"]
    rows = []
    for i in range(500):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = "hot" if i % 3 == 0 else rng.choice(["s1", "S1", "é", None, "", "s9"])
        some = rng.choices(words, k=rng.randint(0, 40)) + (["hotword"] * 9 if source == "hot" else [])
        rows.append((rng.choice([" ", "-", "1", "\n", "'"]).join(some), lang, source))
    rows += [(None, "en", "void"), ("", "fr", "a"), ("12 34", "fr", "b"), ("einmal", "it", "alone")]
    return rows + rows[:20]


def test_equals_brute_force(spark, corpus):
    assert result(divergence.audit(frame(spark, corpus).repartition(5))) == brute(corpus)


def test_terms_of_one_digest_are_told_apart(spark, corpus):
    """Four bits of digest: nearly every digest has several terms."""
    assert result(divergence.audit(frame(spark, corpus).repartition(3), bits=4)) == brute(corpus)


def test_tiles_buckets_and_flushes(spark, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "TERMS", 7)
    assert result(divergence.audit(frame(spark, corpus).repartition(3), hold=50)) == brute(corpus)


def test_ties_rank_by_utf8_and_stop_at_the_limit(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)] + ["é", "zz", "日"]
    rows = [(" ".join(words), "en", "a")] * 30 + [("other", "en", "b")] * 30
    got = result(divergence.audit(frame(spark, rows)))
    assert got == brute(rows)
    assert sum(r[2] == "term" and r[1] == "a" for r in got) == 50


def test_no_kept_terms_and_empty_table(spark):
    rows = [("one two", "en", s) for s in "abc"]
    assert result(divergence.audit(frame(spark, rows))) == brute(rows)
    assert {r[4] for r in brute(rows)} == {0}
    assert result(divergence.audit(frame(spark, []))) == []


def test_very_long_text(spark):
    rows = [("Word " * 400_000, "en", "a")] * 2 + [("word " + "q" * 300_000, "en", "b")] * 30
    assert result(divergence.audit(frame(spark, rows))) == brute(rows)


def test_shares_are_exact_beyond_doubles(spark):
    from pyspark.sql import functions as F
    cases = [(5, 7), (10**15 - 1, 10**15), (3 * 10**14 + 5, 9 * 10**15), (5, 9 * 10**15)]
    df = spark.createDataFrame(cases, "n long, t long")
    got = df.select("n", "t", divergence._share(F.col("n"), F.col("t")).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * r["n"] // r["t"] for r in got)
