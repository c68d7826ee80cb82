"""Operator 5: ids as the library gives them, and packings by brute force."""

import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from pagemill.llm import packing as pk
from pagemill.llm.queries import WORD_BPE


def ids_of(texts):
    tok = Tokenizer.from_file(WORD_BPE)
    return [e.ids + [0] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def verify(rows, ids, capacity=pk.CAPACITY):
    want = {}
    for d, x in ids.items():
        for k in range(0, len(x), capacity):
            part = x[k:k + capacity]
            want[d, k // capacity] = (k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in seqs.values():
        at = 0
        for off, n in sorted(spans):
            assert off == at
            at += n
        assert at <= capacity
    total = sum(n for _, n, _ in want.values())
    return len(seqs), -(-total // capacity)


def test_whole_table(docs01, texts01):
    rows = pk.pack(docs01, WORD_BPE).collect()
    used, least = verify(rows, dict(zip(texts01, ids_of(texts01.values()))))
    assert used <= least + 1


def test_edges(make):
    t = ["", None, " \n", "don't STOP. naïve Ⅷ² x́ <|endoftext|> <|ENDOFTEXT|>.", "a\x1cb\x1fc", "İİ ΟΔΥΣΣΕΥΣ.",
         "word, " * 9000, "é ≮ ;̸ a̸.", "#hash... 12.5! (x)", "日本。語", "\x1c"]
    rows = pk.pack(make(t), WORD_BPE).collect()
    verify(rows, dict(enumerate(ids_of(t))))
    assert pk.pack(make([]), WORD_BPE).count() == 0


def test_words_equal_whole_texts():
    rng = random.Random(1)
    bits = ["Ab", "don't", "é", "é", ".", ",", "!?", "'s", "’", "12", "Ⅷ", "̸", " ", "\n", " ", " ",
            "<|endoftext|>", "<|", "|>", "ß", "Σ", "日", "\x85", "​", "_", "\x1d"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(4000)]
    tok = pk.Tokens(WORD_BPE)
    got = [np.frombuffer(b, "<u4").tolist() for b in tok.encode(texts)]
    for t, g, w in zip(texts, got, ids_of(texts)):
        assert g == w[:-1], t


def test_small_packings_are_optimal():
    rng = random.Random(2)

    def fewest(items, cap):
        items = tuple(sorted(items, reverse=True))

        @lru_cache(None)
        def go(left):
            if not left:
                return 0
            best = [99]

            def fill(i, room, rest):
                if i == len(rest):
                    best[0] = min(best[0], 1 + go(rest))
                    return
                fill(i + 1, room, rest)
                if rest[i] <= room:
                    fill(i, room - rest[i], rest[:i] + rest[i + 1:])
            fill(0, cap - left[0], left[1:])
            return best[0]
        return go(items)

    for _ in range(60):
        items = [rng.randrange(3, 14) for _ in range(rng.randrange(1, 9))]
        hist = {x: items.count(x) for x in items}
        plan = pk.bin_completion(hist, 20)
        used = defaultdict(int)
        for bins, filling in plan:
            assert sum(x * q for x, q in filling) <= 20
            for x, q in filling:
                used[x] += bins * q
        assert used == hist
        assert sum(b for b, _ in plan) == fewest(items, 20) >= pk.lower_bound(hist, 20)
