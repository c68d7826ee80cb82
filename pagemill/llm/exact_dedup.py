"""Operator 8: exact de-duplication behind a Bloom filter, DataFrame
functions only.

Texts are equal when they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  Of equal texts the row with the most code points in
the original text stays, then the smallest id.

Pass 1 sets two bits per row in a filter of ``m`` bits (a table of 64-bit
words) and keeps the bits that two or more rows set.  Pass 2 probes the
filter: a row whose two bits are both kept is possibly repeated.  Only those
rows shuffle on their SHA-256; the rest pass straight through.  The filter
cannot miss a repeat; a false alarm costs only the shuffle of one light row.

``m`` follows the row count up to ``MAX_BITS``.  The filter has at most
``MAX_BITS / 64`` words, so its broadcast is bounded by a constant (32 MB of
raw words); beyond that many rows it fills up and lets more rows shuffle,
with the same results.

Defined cases: null text counts as empty; empty and white-space-only texts
equal each other; a null id sorts after all others; rows that repeat an id
are decided alike (both are the row that stays, if that id stays); an empty
table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

#: The characters that do not count.
BLANKS = " \t\n\x0b\x0c\r"
#: Bits of the filter per row, and the most bits at all.
BITS_PER_ROW = 16
MAX_BITS = 1 << 27


def digest(text: Column) -> Column:
    return F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256)


def _bits(sha: Column, m: int) -> list[Column]:
    """Two bit positions below ``m`` from the first 64 bits of the digest."""
    return [F.conv(F.substring(sha, 1 + 8 * i, 8), 16, 10).cast("long").bitwiseAND(m - 1)
            for i in range(2)]


def repeat_filter(shas: DataFrame) -> tuple[DataFrame, int]:
    """``(word, bits)`` of the positions that two or more rows set, and m."""
    n = shas.count()
    m = min(MAX_BITS, 1 << max(10, math.ceil(math.log2(BITS_PER_ROW * max(n, 1)))))
    pos = shas.select(F.explode(F.array(*_bits(F.col("sha"), m))).alias("pos"))
    twice = pos.groupBy("pos").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    bit = F.expr("shiftleft(1L, cast(pos & 63 as int))")
    words = twice.groupBy(F.shiftright("pos", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    return stage(words, "bloom"), m


def flag_repeats(rows: DataFrame, words: DataFrame, m: int) -> DataFrame:
    """``rows`` (with ``sha``) plus ``maybe``: both bits are in the filter."""
    out = rows
    for i, pos in enumerate(_bits(F.col("sha"), m)):
        w = words.select(F.col("word").alias(f"_w{i}"), F.col("bits").alias(f"_b{i}"))
        out = (out.withColumn(f"_p{i}", pos)
               .join(F.broadcast(w), F.shiftright(f"_p{i}", 6) == F.col(f"_w{i}"), "left"))
    hit = [F.expr(f"coalesce(getbit(_b{i}, cast(_p{i} & 63 as int)), 0) = 1") for i in range(2)]
    return (out.withColumn("maybe", hit[0] & hit[1])
            .drop(*[f"_{c}{i}" for c in "wbp" for i in range(2)]))


def _groups(maybe: DataFrame) -> DataFrame:
    """Per digest with two or more rows: the row that stays, the size."""
    return (maybe.groupBy("sha", "n")
            .agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("first"))
            .groupBy("sha").agg(F.sum("c").alias("group_size"),
                                F.max_by("first", "n").alias("keep_id"))
            .filter("group_size >= 2"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row."""
    text = text_or_empty(text_col)
    light = stage(docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("n"),
                              digest(text).alias("sha")), "exact-light")
    words, m = repeat_filter(light)
    flagged = flag_repeats(light, words, m)
    alone = (flagged.filter(~F.col("maybe"))
             .select("doc_id", F.col("doc_id").alias("keep_id"),
                     F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
                     F.col("sha").alias("text_sha256")))
    maybe = flagged.filter("maybe").select("doc_id", "n", "sha")
    groups = stage(_groups(maybe), "exact-groups")
    rest = maybe.join(groups, "sha", "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return alone.unionByName(rest.select(
        "doc_id", keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`decide` does not keep.  Texts of
    rows that cannot be repeated are not shuffled."""
    text = text_or_empty(text_col)
    cols = docs.columns
    marked = docs.select(F.struct(*cols).alias("_row"), F.col(id_col).alias("doc_id"),
                         F.length(text).alias("n"), digest(text).alias("sha"))
    light = stage(marked.drop("_row"), "exact-light")
    words, m = repeat_filter(light.select("sha"))
    maybe = flag_repeats(light, words, m).filter("maybe").select("doc_id", "n", "sha")
    groups = stage(_groups(maybe), "exact-groups")
    flagged = flag_repeats(marked, words, m)
    alone = flagged.filter(~F.col("maybe"))
    rest = (flagged.filter("maybe").join(groups, "sha", "left")
            .filter(F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))))
    return (alone.select("_row").unionByName(rest.select("_row"))
            .select(*[F.col("_row").getField(c).alias(c) for c in cols]))


#: DuckDB statement of the query op8_exact_dedup.
ORACLE = r"""
with t as (select doc_id, length(coalesce(text, '')) as n,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as sha
           from documents),
g as (select sha, count(*) as group_size,
        first(doc_id order by n desc, doc_id) as keep_id from t group by sha)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, t.sha as text_sha256
from t join g using (sha)
"""
