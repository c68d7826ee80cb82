"""Texts cut by several tasks give the chunks of the splitter."""

import random

import pytest
from pyspark.sql import functions as F

from pagemill.functions import splitter as sp
from pagemill.operators import long_text as lt

from .test_chunks import fuzz_texts


def test_spans_equal_the_merge():
    rng = random.Random(9)
    for _ in range(600):
        size, overlap = rng.choice([(20, 6), (10, 0), (15, 14), (7, 3)])
        pieces = [rng.choice([1, 2, 3, 5, size - 1]) for _ in range(rng.randrange(1, 40))]
        begins = [0]
        for p in pieces:
            begins.append(begins[-1] + p)
        text = "".join(chr(97 + i % 26) * p for i, p in enumerate(pieces))
        want: list[str] = []
        sp._merge([text[a:b] for a, b in zip(begins, begins[1:])], size, overlap, want)
        assert [text[a:b] for a, b in lt.merge_spans(begins, 0, len(pieces), size, overlap)] == want
    assert lt.plan_spans(range(0, 1001), 100, 10) == lt.plan_spans(list(range(1001)), 100, 10)


def by_pos(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["pos"], {})[r["chunk_index"]] = r["chunk_text"]
    assert all(sorted(c) == list(range(len(c))) for c in got.values())
    return {p: [c[i] for i in range(len(c))] for p, c in got.items()}


@pytest.mark.parametrize("long,segment", [(20, 25), (40, 60), (10**6, 10**6)])
def test_any_text_in_segments(spark, long, segment):
    """Fuzzed separators, runs of line feeds across segments, pieces that are
    long themselves at every level."""
    rng = random.Random(1)
    texts = [t * 6 for _, t in fuzz_texts(60)]
    texts += ["".join(rng.choice(["x" * rng.randrange(1, 90), "\n", "\n\n", " ", "\n\n\n\n\n", "é", "日本 "])
                      for _ in range(60)) for _ in range(40)]
    texts += [None, "", " \n ", "y" * 500, "\n" * 300, "a" * 100 + "\n\n" + "b c " * 60 + "\n" + "d" * 200, " " * 99]
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, text string").repartition(3)
    got = by_pos(lt.chunk_documents(df, 20, 6, long, segment))
    for i, t in enumerate(texts):
        assert got.get(i, []) == sp.split_text(t, 20, 6), repr(t)


def test_one_long_text_uses_many_tasks(spark):
    """Several megabytes in one row, paragraphs, one long line among them."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefg", k=rng.randrange(2, 12))) for _ in range(999)]
    line = " ".join(rng.choices(words, k=120_000))
    text = "\n\n".join([" ".join(rng.choices(words, k=rng.randrange(5, 400))) for _ in range(3000)] + [line, line])
    df = spark.createDataFrame([(5, text)], "pos long, text string")
    segments = lt._segments(df.withColumn("at", F.expr(
        f"array(named_struct('begin', 0L, 'end', {len(text)}L, 'level', 0))")), 1 << 18, 1 << 16)
    assert segments.count() > 15
    assert by_pos(lt.chunk_long(df, long=1 << 16, segment=1 << 18)) == {5: sp.split_text(text)}
