"""Embedding attach (CK5).

The default embedding is a hashed bag of words computed inside the row with
higher-order functions: no shuffle, no Python.  Each lower-case word token
goes to bucket ``md5(word)[0:8] mod dim``; the count vector is L2-normalised.
A user's model plugs in through :func:`embed_with`, which runs a pandas
function over Arrow batches next to the data.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType, StructField, StructType

DIM = 64
TOKEN_RE = r"[\p{L}\p{N}]+"


# Bucket ids are written as one ASCII character each, starting at '0'.
_CODE_BASE = 48


def _bucket_codes(text: Column, dim: int) -> Column:
    """One character per token: ``chr(48 + bucket)``."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RE), 0)
    return F.array_join(F.transform(tokens, lambda w: F.char(F.pmod(
        F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"), F.lit(dim)) + _CODE_BASE)), "")


def _bucket_counts(codes: Column, dim: int) -> Column:
    """Count of bucket ``i`` = characters removed by deleting ``chr(48+i)``:
    native string scans, no per-token lambda over the vector."""
    n = F.length(codes)
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: (
        n - F.length(F.replace(codes, F.char(i + _CODE_BASE), F.lit("")))).cast("double"))


def _normalise(counts: Column, norm: Column) -> Column:
    return F.transform(counts, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0))
                       .cast("float"))


def hashed_embedding(text: Column, dim: int = DIM) -> Column:
    """The embedding as one column expression (a fold over the tokens).
    Tables use :func:`embed_chunks`, which is faster."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_RE), 0)
    buckets = F.transform(tokens, lambda w: F.pmod(
        F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int"))

    def add(acc, b):
        return F.transform(acc, lambda x, i: x + F.when(i == b, 1.0).otherwise(0.0))

    def finish(acc):
        return _normalise(acc, F.sqrt(F.aggregate(acc, F.lit(0.0), lambda s, y: s + y * y)))

    return F.aggregate(buckets, F.array_repeat(F.lit(0.0), dim), add, finish)


def embed_chunks(chunks: DataFrame, dim: int = DIM, text_col: str = "chunk_text") -> DataFrame:
    """Attach ``embedding``.  Each intermediate array is its own projection,
    so no array is recomputed inside another's lambda."""
    if dim > 200:
        raise ValueError("embed_chunks encodes bucket ids as ASCII characters; dim <= 200")
    return (chunks
            .withColumn("_eb", _bucket_codes(F.col(text_col), dim))
            .withColumn("_ec", _bucket_counts(F.col("_eb"), dim))
            .withColumn("_en", F.sqrt(F.aggregate("_ec", F.lit(0.0), lambda s, y: s + y * y)))
            .withColumn("embedding", _normalise(F.col("_ec"), F.col("_en")))
            .drop("_eb", "_ec", "_en"))


def embed_with(chunks: DataFrame, model: Callable[[pd.Series], list],
               text_col: str = "chunk_text") -> DataFrame:
    """Attach ``embedding`` computed by ``model`` (texts -> list of vectors)
    over Arrow batches with ``mapInPandas``, and ``embed_error``.

    IX8: a batch on which the model fails is repeated row by row; a row that
    fails has a NULL embedding and the error's text, its neighbours are kept."""
    schema = StructType(chunks.schema.fields + [
        StructField("embedding", ArrayType(FloatType())), StructField("embed_error", StringType())])

    def vectors(texts: pd.Series) -> list[list[float]]:
        got = [list(map(float, v)) for v in model(texts)]
        if len(got) != len(texts):
            raise ValueError(f"{len(got)} vectors for {len(texts)} texts")
        return got

    def one(text: str) -> tuple[list[float] | None, str | None]:
        try:
            return vectors(pd.Series([text]))[0], None
        except Exception as e:  # noqa: BLE001  (recorded with the row)
            return None, f"{type(e).__name__}: {e}"

    def run(batches):
        for pdf in batches:
            try:
                got = [(v, None) for v in vectors(pdf[text_col])]
            except Exception:  # noqa: BLE001  (row by row instead)
                got = [one(t) for t in pdf[text_col]]
            yield pdf.assign(embedding=[v for v, _ in got], embed_error=[e for _, e in got])

    return chunks.mapInPandas(run, schema)
