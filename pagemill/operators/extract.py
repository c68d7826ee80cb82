"""Article extraction from stored pages and text statistics (EX1-EX6).

Extraction is one narrow ``select`` of column expressions.  Keywords and
summaries never leave their row: words are split natively and scored in Arrow
batches, without a shuffle.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as hx
from ..functions.text import WS_CHARS

WORD_RE = r"\p{L}+"
SENTENCE_RE = r"[^.!?]+[.!?]*"
KEYWORDS = 10
SUMMARY_SENTENCES = 5

# Stopwords left out of keywords and sentence scores.
STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "been", "but", "by", "for", "from",
    "had", "has", "have", "he", "i", "in", "is", "it", "its", "not", "of", "on",
    "or", "she", "that", "the", "their", "they", "this", "to", "was", "we", "were",
    "with", "you",
]


_STOP = frozenset(STOPWORDS)
NLP_TYPE = "keywords array<string>, summary string, nlp_error string"
#: (sentences, words of each sentence) -> (keywords, summary)
Analyse = Callable[[list[str], list[list[str]]], tuple[list[str], str]]


def extract_articles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """EX1-EX3: one article row per page, defaults for missing fields."""
    h = hx.strip_boilerplate(F.col("html"))
    return (pages.select(id_col, url_col, h.alias("_h"), F.col("html").alias("_raw"))
            .select(
                id_col,
                F.col(url_col).alias("link"),
                F.coalesce(hx.title(F.col("_h")), F.lit("")).alias("title"),
                F.coalesce(hx.authors(F.col("_raw")), F.array().cast("array<string>")).alias("authors"),
                hx.publish_date(F.col("_raw")).alias("publish_date"),
                F.coalesce(hx.body_text(F.col("_h")), F.lit("")).alias("text")))


def _sentences(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(SENTENCE_RE), 0)
    return F.filter(F.transform(found, lambda s: F.btrim(s, F.lit(WS_CHARS))), lambda s: s != "")


def _words(sentence: Column) -> Column:
    return F.regexp_extract_all(F.lower(sentence), F.lit(WORD_RE), 0)


def top_terms(sentences: list[str], words: list[list[str]]) -> tuple[list[str], str]:
    """Keywords and summary of one text, given as sentences and their words.

    Keywords: the most frequent words, ties by word.  Summary: the sentences
    with the highest mean in-text frequency of their words, in text order.
    """
    kept = [[w for w in ws if w not in _STOP] for ws in words]
    counts = Counter(w for ws in kept for w in ws)
    keywords = heapq.nsmallest(KEYWORDS, counts, key=lambda w: (-counts[w], w))
    scores = [sum(counts[w] for w in ws) / len(ws) if ws else 0.0 for ws in kept]
    best = heapq.nsmallest(SUMMARY_SENTENCES, range(len(scores)), key=lambda i: (-scores[i], i))
    return keywords, "\n".join(sentences[i] for i in sorted(best))


def nlp_column(text: Column, analyse: Analyse = top_terms) -> Column:
    """EX4-EX6: struct ``(keywords, summary, nlp_error)`` of one text.

    Sentences and words are split natively; the scores never leave the row, so
    nothing is shuffled.  A row on which ``analyse`` fails gets the defaults
    (``[]`` and ``""``) and the error's text; other rows are not affected.
    """
    @F.arrow_udf(NLP_TYPE)
    def _nlp(sentences: pa.Array, words: pa.Array) -> pa.Array:
        out = []
        for s, w in zip(sentences, words):
            try:
                k, text = analyse(s.as_py() or [], w.as_py() or [])
                out.append({"keywords": k, "summary": text, "nlp_error": None})
            except Exception as e:  # noqa: BLE001  (recorded with the row)
                out.append({"keywords": [], "summary": "", "nlp_error": f"{type(e).__name__}: {e}"})
        return pa.array(out, type=pa.struct([("keywords", pa.list_(pa.string())),
                                             ("summary", pa.string()), ("nlp_error", pa.string())]))

    sentences = _sentences(text)
    return _nlp(sentences, F.transform(sentences, _words))


def keywords(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """EX4: top words by count (ties by word) per row, ``[]`` when a text has
    none (EX6 default)."""
    return df.select(id_col, nlp_column(F.col(text_col))["keywords"].alias("keywords"))


def summary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """EX5: the sentences with the highest mean in-document frequency of their
    (non-stopword) words, in text order, joined by newlines; ``""`` for texts
    without sentences (EX6 default)."""
    return df.select(id_col, nlp_column(F.col(text_col))["summary"].alias("summary"))


def with_nlp(articles: DataFrame, analyse: Analyse = top_terms) -> DataFrame:
    """EX4-EX6 attached to every article row: ``keywords``, ``summary``,
    ``nlp_error``.  Rows with equal links keep their own values."""
    return (articles.withColumn("_nlp", nlp_column(F.col("text"), analyse))
            .select(*articles.columns, "_nlp.keywords", "_nlp.summary", "_nlp.nlp_error"))
