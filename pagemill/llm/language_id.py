"""Operator 2: language identification by multinomial naive Bayes over
hashed character n-grams.

Features are the hashed 1- to 3-grams of the lower-cased text whose letters
are kept and whose other characters all count as one separator.  Training sums
n-gram counts per language over the labelled rows (each task sums its own rows
into one matrix first).  The model is a matrix of ``BUCKETS`` rows and one
column per language (at most ``MAX_LANGS``, so its size is bounded); it goes
to the executors as a broadcast variable, and each Arrow batch is scored with
one gather and one segmented sum.

The score is the posterior of the predicted language with the evidence
tempered to ``EVIDENCE`` n-grams at most, so that it stays informative on long
texts.

Defined cases: a text that is null or without a letter is ``und`` with score
0; with no training rows every text is ``und``; ties go to the
alphabetically first language; repeated rows are scored each; an empty table
gives an empty result; the label, source and id are never inputs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_batches, stage

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
#: More distinct labels than this are refused (the model would not be bounded).
MAX_LANGS = 512
ALPHA = 0.5
EVIDENCE = 40
UND = "und"

_OTHER = re.compile(r"[\W\d_]+")
_MULT = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def plain(text: str | None) -> str:
    """Letters in lower case, one space for anything between."""
    return _OTHER.sub(" ", f" {text or ''} ".lower())


def grams(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per order: the bucket of the n-gram at every position of the joined
    texts, and whether it stays within one text; and the texts' lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(c))
    buckets, inside = [], []
    h = np.zeros(len(c), np.uint32)
    for k in ORDERS:
        n = max(0, len(c) - k + 1)
        h = h[:n] * _MULT[1] + c[k - 1:] * _MULT[0] + np.uint32(k)
        h ^= h >> np.uint32(15)
        buckets.append((h * _MULT[2]) >> np.uint32(32 - BUCKETS.bit_length() + 1))
        inside.append(left[:n] >= k)
    return buckets, inside, size


def _count(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, np.ndarray] = {}
    for df in rows:
        for lang, part in df.groupby("lang"):
            texts = [plain(t) for t in part["text"]]
            acc = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for at in range(0, len(texts), 256):
                hs, oks, _ = grams(texts[at:at + 256])
                for h, ok in zip(hs, oks):
                    acc += np.bincount(h[ok], minlength=BUCKETS)
    for lang, acc in total.items():
        some = np.flatnonzero(acc)
        yield pd.DataFrame({"lang": lang, "bucket": some, "n": acc[some]})


class Model:
    """Languages in alphabetical order and log probabilities."""

    def __init__(self, langs: list[str], logp: np.ndarray, prior: np.ndarray):
        self.langs, self.logp, self.prior = langs, logp, prior


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on every row of ``docs`` that has a text and a label."""
    ship_package(docs.sparkSession)
    rows = (docs.select(F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
            .filter("text is not null and lang is not null"))
    counts = stage(rows.mapInPandas(_count, "lang string, bucket long, n long")
                   .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "lang-counts")
    langs = [r[0] for r in counts.select("lang").distinct().sort("lang").limit(MAX_LANGS + 1).collect()]
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} distinct labels")
    m = np.zeros((BUCKETS, len(langs)))
    at = {lang: i for i, lang in enumerate(langs)}
    for r in counts.toLocalIterator():        # at most BUCKETS x MAX_LANGS rows
        m[r["bucket"], at[r["lang"]]] = r["n"]
    # equal priors: the mix of a training set says nothing about a new text
    p = (m + ALPHA) / (m.sum(axis=0) + ALPHA * BUCKETS)
    return Model(langs, np.log(p).astype(np.float32), np.zeros(len(langs)))


def score_texts(model: Model, raw: list[str | None]) -> tuple[list[str], np.ndarray]:
    texts = [plain(t) for t in raw]
    known = np.fromiter((any(map(str.isalpha, t)) for t in texts), bool, len(texts))
    if not model.langs or not len(texts):
        return [UND] * len(texts), np.zeros(len(texts))
    sums = np.zeros((len(texts), len(model.langs)))
    n = np.zeros(len(texts))
    for at in range(0, len(texts), 256):
        part = texts[at:at + 256]
        hs, oks, size = grams(part)
        starts = np.cumsum(size) - size
        for k, h, ok in zip(ORDERS, hs, oks):
            has = size >= k
            if not has.any():
                continue
            # n-grams over a border are masked, so each text is one segment
            for j in range(len(model.langs)):
                v = model.logp[:, j][h]
                v[~ok] = 0
                sums[at:at + len(part), j][has] += np.add.reduceat(v, starts[has], dtype=np.float64)
            n[at:at + len(part)] += np.maximum(size - k + 1, 0)
    best = sums.argmax(axis=1)
    tempered = (sums - sums.max(axis=1, keepdims=True)) * np.minimum(1, EVIDENCE / np.maximum(n, 1))[:, None]
    post = 1 / np.exp(tempered).sum(axis=1)
    return ([model.langs[b] if k else UND for b, k in zip(best, known)],
            np.where(known, post, 0.0))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``lang_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(batch.num_columns - 1).to_pylist()
        lang, s = score_texts(shared.value, raw)
        cols = [batch.column(i) for i in range(batch.num_columns - 1)]
        return pa.RecordBatch.from_arrays(
            [*cols, pa.array(lang, pa.string()), pa.array(s, pa.float64())],
            names=[*batch.schema.names[:-1], "lang_pred", "lang_score"])

    own = [f.name for f in docs.schema.fields]
    kept = docs.select(F.struct(*own).alias("_row"), F.col(text_col).cast("string").alias("_text"))
    row = docs.schema.simpleString()
    out = map_batches(kept, score, f"_row {row}, lang_pred string, lang_score double")
    return out.select(*[F.col("_row").getField(c).alias(c) for c in own], "lang_pred", "lang_score")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept back from training: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """The query: model from the training fold, prediction for every row."""
    model = train(docs.filter(~held_out()))
    light = docs.select("doc_id", held_out().alias("held_out"), "text")
    out = predict(light, model)
    return out.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
