"""Operator 6: edited texts by brute force, likeness against the truth."""

import hashlib
import re
from collections import Counter
from statistics import mean

from pagemill.llm import fingerprint as fp


def brute(texts):
    order = sorted(texts, reverse=True)
    out = {}
    for k, i in enumerate(order):
        t, nxt = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        cut = len(t) // 3
        out[i] = (t[:len(t) - cut] + nxt[:cut], nxt)
    return out


def jaccard(a, b):
    x, y = (Counter(w for w in re.split(r"[\x20\x09-\x0D]+", t) if w) for t in (a, b))
    hi = sum((x | y).values())
    return sum((x & y).values()) / hi if hi else 1.0


def test_whole_table(docs01, texts01):
    got = {r["doc_id"]: r for r in fp.edited_fingerprints(docs01).collect()}
    want = brute(texts01)
    assert got.keys() == want.keys()
    errors, seen = [], {}
    for i, r in got.items():
        edited, nxt = want[i]
        assert r["n_chars"] == len(texts01[i])
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(texts01[i], r["fingerprint"]) == r["fingerprint"]
        assert seen.setdefault(edited, r["edited_fingerprint"]) == r["edited_fingerprint"]
        errors += [r["near_edited"] - jaccard(texts01[i], edited), r["near_next"] - jaccard(texts01[i], nxt)]
    assert abs(mean(errors)) < 0.01                          # unbiased
    assert mean(e * e for e in errors) < 0.3 / fp.SAMPLES    # binomial variance


def test_edges(make):
    t = {5: "", 7: None, 70_000: "a b c", 2: "😀é x", 3_000_000: "w " * 50_000, -4: "tail of it"}
    got = {r["doc_id"]: r for r in fp.edited_fingerprints(make(list(t.items()))).collect()}
    want = brute(t)
    for i in t:
        assert got[i]["edited_sha256"] == hashlib.sha256(want[i][0].encode()).hexdigest()
    assert (got[7]["fingerprint"], got[7]["near_edited"], got[7]["near_next"]) == ("", 1.0, 1.0)
    assert got[5]["near_next"] == 0.0
    one = fp.edited_fingerprints(make([(3, "abc def")])).collect()
    assert one[0]["near_next"] == 1.0
    assert fp.edited_fingerprints(make([])).count() == 0


def test_every_row_has_its_result(make):
    rows = [(None, "n one two"), (1, "b c d e f g"), (1, "x y z u v w"), (None, None), (1, "b c d e f g"),
            (9, "top of the order"), (None, "n one two")]
    got = fp.edited_fingerprints(make(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    # every edited text ends as some other row's text begins, and the row of the
    # largest id follows the last null id
    texts = [t or "" for _, t in rows]
    for r in got:
        own = [t or "" for i, t in rows if i == r["doc_id"] and len(t or "") == r["n_chars"]]
        edits = {hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest()
                 for t in own for n in texts}
        assert r["edited_sha256"] in edits
    again = fp.edited_fingerprints(make(rows[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_ids_far_apart_are_ordered_by_ranges(spark, make):
    ids = [k << 40 for k in range(-50, 950)]
    light = make([(i, "") for i in ids]).selectExpr("doc_id as key", "doc_id", "0L as tie")
    got = {r["key"]: r["next"] for r in fp.following(light).collect()}
    want = sorted(ids, reverse=True)
    assert got == dict(zip(want, want[1:] + want[:1]))
    ties = make([(None, "")] * 700 + [(3, "")] * 300).selectExpr(
        "monotonically_increasing_id() as key", "doc_id", "0L as tie").persist()
    nxt = {r["key"]: r["next"] for r in fp.following(ties).collect()}
    at, seen = 0, set()
    while at not in seen:
        seen.add(at)
        at = nxt[at]
    assert len(seen) == 1000                                 # one ring of all rows
