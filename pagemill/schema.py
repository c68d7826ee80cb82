"""Table schemas shared by the operators.

Articles are one row per fetched record.  The JSON form uses the crawler's
keys (``Title``, ``Publish Date``, ``_error`` ...); inside Spark the columns
are snake_case and ``pos`` carries the record's position, because list order
is data in this pipeline and rows have no order of their own.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Record keys of the article JSON and their column names here.
JSON_KEYS = {
    "link": "link",
    "Title": "title",
    "Authors": "authors",
    "Publish Date": "publish_date",
    "Text": "text",
    "Summary": "summary",
    "Keywords": "keywords",
    "_nlp_error": "nlp_error",
    "_error": "error",
}

ARTICLE_JSON = T.StructType([
    T.StructField("link", T.StringType()),
    T.StructField("Title", T.StringType()),
    T.StructField("Authors", T.ArrayType(T.StringType())),
    T.StructField("Publish Date", T.StringType()),
    T.StructField("Text", T.StringType()),
    T.StructField("Summary", T.StringType()),
    T.StructField("Keywords", T.ArrayType(T.StringType())),
    T.StructField("_nlp_error", T.StringType()),
    T.StructField("_error", T.StringType()),
])

ARTICLE = T.StructType([T.StructField("pos", T.LongType())] + [
    T.StructField(JSON_KEYS[f.name], f.dataType) for f in ARTICLE_JSON.fields])

ARTICLE_COLUMNS = [f.name for f in ARTICLE.fields]

LINKS = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("link", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("link", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
])

CHUNKS = T.StructType([
    T.StructField("chunk_id", T.StringType()),
    T.StructField("chunk_no", T.LongType()),
    T.StructField("link", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("publish_date", T.StringType()),
    T.StructField("chunk_text", T.StringType()),
])

EMBEDDED_CHUNKS = T.StructType(CHUNKS.fields + [
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])
