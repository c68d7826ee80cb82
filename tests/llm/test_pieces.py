"""Operators 1 and 9 against the sentencepiece library."""

import random
import time
import zlib

import numpy as np
import sentencepiece

from pagemill.llm import sentencepiece_fst as fst
from pagemill.llm import token_count as tc
from pagemill.llm.queries import PIECES, QUERIES

from ..conftest import SF01

PROTO = open(PIECES, "rb").read()


def as_unigram(proto):
    """The same vocabulary with the model type switched to unigram."""
    i = proto.index(b"\x12", 0)
    at = 0
    while True:                    # the trainer's field among the top-level ones
        key, n, at0 = proto[at], 0, at
        shift, at = 0, at + 1
        while True:
            b = proto[at]
            n |= (b & 127) << shift
            shift, at = shift + 7, at + 1
            if b < 128:
                break
        if key >> 3 == 2:
            body = bytearray(proto[at:at + n])
            i = body.index(b"\x18\x02")
            body[i + 1] = 1
            return proto[:at] + bytes(body) + proto[at + n:]
        at += n
        assert at > at0


UNI = as_unigram(PROTO)
EDGES = ["", " ", "  ", "a", " a", "a ", "a  b", "a\n b\t", "日本語 x", "é ﬁ é", "\x00\x1f", "▁a ▁▁b", "😀😀 x",
         "x" * 3000, "    four", "aaaa aaaaa bbbbbbb", "http://a.b/c?d=e#f", "of the and", "​", "a" + " " * 9 + "b"]


def fuzz(n):
    rng = random.Random(4)
    bits = ["the", "ing", "a", "e", "er", " ", "  ", "\n", "é", "日", "tion", "s", "x", "q", "Z", "1", "00", ".", "▁"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(3000)]


def test_merge_model_equals_library(texts01):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t = fst.Transducer(PROTO)
    for text in [*EDGES, *fuzz(3000), *list(texts01.values())[:150]]:
        got = np.frombuffer(t.encode(text), np.uint32).tolist()
        assert got == sp.encode(text), text[:200]
        assert t.decode(t.encode(text)) == sp.decode(got)


def test_unigram_model_by_library_scores(texts01):
    """The library's best path (its lattice search) has the same score."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=UNI)
    t, c = fst.Transducer(UNI), tc.Counter(UNI)
    assert not t.merges
    short = [x[:80] for x in list(texts01.values())[:150]]
    for text in [*EDGES, *fuzz(3000)[:800], *short]:
        if len(text) > 120:
            continue
        ids = np.frombuffer(t.encode(text), np.uint32).tolist()
        n, score = c.count(text)
        assert (t.decode(t.encode(text)), len(ids)) == (sp.decode(ids), n)
        # the library adds up in single precision
        if text and score > -1e6 and all(ch in c.vocab.ids for ch in c.vocab.normalise(text)):
            best = sp.nbest_encode(text, nbest_size=2)[0]
            total = lambda x: sum(c.vocab.score[i] for i in x)
            assert total(ids) == score == total(best), text


def test_count_ignores_the_model_type():
    a, b = tc.Counter(PROTO), tc.Counter(UNI)
    assert [a.count(x) for x in EDGES] == [b.count(x) for x in EDGES]


def test_viterbi_by_brute_force():
    c = tc.Counter(UNI)
    ids, score = c.vocab.ids, c.vocab.score

    def best(text):
        table = [(0.0, 0)] + [None] * len(text)
        for e in range(1, len(text) + 1):
            for s in range(e):
                p = text[s:e]
                if p in ids:
                    cand = (table[s][0] + score[ids[p]], table[s][1] + 1)
                elif e - s == 1:
                    cand = (table[s][0] + c.unk, table[s][1] + len(p.encode()))
                else:
                    continue
                if table[e] is None or cand[0] > table[e][0]:
                    table[e] = cand
        return table[-1][1], table[-1][0]
    for text in fuzz(500)[:500]:
        norm = c.vocab.normalise(text)
        assert c.best(norm) == best(norm)
        assert c.count(text) == best(norm)


def test_queries(make, docs01, texts01):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t = dict(enumerate([None, *EDGES, "word " * 40_000]))
    for df, texts in ((make(list(t.items())), t), (docs01, texts01)):
        rows = fst.encode(df, PIECES)
        got = {r["doc_id"]: r for r in rows.collect()}
        counts = {r["doc_id"]: r for r in tc.count_tokens(df, PIECES).collect()}
        assert got.keys() == texts.keys() == counts.keys()
        for i, x in texts.items():
            want = sp.encode(x or "")
            assert got[i]["n_pieces"] == len(want) and got[i]["ids"] == want
            assert got[i]["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
            assert got[i]["decodes"] == (sp.decode(want) == (x or ""))
        back = {r["doc_id"]: r["text"] for r in fst.decode(rows, PIECES).collect()}
        assert back == {i: sp.decode(got[i]["ids"]) for i in texts}
    assert fst.encode(make([]), PIECES).count() == tc.count_tokens(make([]), PIECES).count() == 0


def test_the_query_returns_pieces_and_decoded_texts(spark, texts01):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r["doc_id"]: r for r in QUERIES["op1_sentencepiece"](spark, SF01).collect()}
    assert got.keys() == texts01.keys()
    for i, x in texts01.items():
        want = sp.encode(x or "")
        assert got[i]["ids"] == want and got[i]["decoded"] == sp.decode(want)
        assert got[i]["n_pieces"] == len(want) and got[i]["decodes"] == (sp.decode(want) == (x or ""))


def test_long_runs_of_blanks_are_merged_from_a_heap():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t = fst.Transducer(PROTO)
    rng = random.Random(5)
    for _ in range(2000):
        word = "".join(rng.choice("▁▁▁▁ateinx\t\n日") for _ in range(rng.randrange(1, 40)))
        *_, (_, parts) = t.merge_steps(word)
        assert t.merged(word) == parts
    for text in (" " * 5000, "a" + " " * 3333 + "b" + " " * 77, "x  " * 2000):
        assert np.frombuffer(t.encode(text), np.uint32).tolist() == sp.encode(text)
    start = time.process_time()
    assert t.decode(t.encode("a" + " " * 200_000 + "b")) == "a" + " " * 200_000 + "b"
    assert time.process_time() - start < 5
