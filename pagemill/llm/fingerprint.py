"""Operator 6: document fingerprints by consistent weighted sampling,
DataFrame functions only.

Terms are the words of the text (``[^\\x20\\x09-\\x0D]+``), weights their
counts.  For every sample and term, hashes give ``r`` and ``c`` from
Gamma(2, 1) and ``beta`` uniform on (0, 1) (Ioffe's scheme):

    t = floor(ln(w) / r + beta),   ln a = ln c - r * (t - beta + 1)

and the sample is the term and ``t`` with the smallest ``a``.  Two documents
agree in a sample with probability equal to their generalised Jaccard
similarity, sum(min(w)) / sum(max(w)).  Since ``a`` is a function of the
sample, the term and ``t``, the smallest value itself identifies the pair, so
a sample is a plain ``min``: partial aggregation without sorting.

The query also fingerprints an edited text (its end replaced by the start of
the next document); both versions share one pass: the variates of a term are
computed once and used with both weights.

Defined cases: null text is empty; a text without words has the empty
fingerprint, which is like itself (1) and unlike any other (0); rows that
repeat an id are documents of their own, which follow one another by the hash
of their texts; rows with a null id come after all others, in the same way; a
text of any length is hashed whole, as one row; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_or_empty

#: Samples = LANES x PER: lanes are rows, so generated code stays small.
LANES, PER = 5, 8
SAMPLES = LANES * PER
BLANK = r"[\x20\x09-\x0D]+"


def _unit(h: Column, high: bool) -> Column:
    """32 bits of a hash as a number in (0, 1)."""
    part = F.shiftrightunsigned(h, 32) if high else h.bitwiseAND(0xFFFFFFFF)
    return (part.cast("double") + 0.5) / float(1 << 32)


def _samples(terms: DataFrame, weights: list[str]) -> DataFrame:
    """``terms``: ``doc_id, term`` and weight columns.  One row per document
    and lane with the PER smallest values of each weight column."""
    x = terms.withColumn("lane", F.explode(F.array(*[F.lit(i) for i in range(LANES)])))
    x = x.withColumns({f"h{j}": F.xxhash64("term", F.col("lane") * PER + j) for j in range(PER)})
    x = x.withColumns({f"g{j}": F.xxhash64(F.col(f"h{j}")) for j in range(PER)})
    x = x.withColumns(
        {f"r{j}": -F.ln(_unit(F.col(f"h{j}"), True) * _unit(F.col(f"h{j}"), False))
         for j in range(PER)}
        | {f"c{j}": F.ln(-F.ln(_unit(F.col(f"g{j}"), True) * _unit(F.col(f"g{j}"), False)))
           for j in range(PER)}
        | {f"b{j}": _unit(F.xxhash64(F.col(f"g{j}")), True) for j in range(PER)})
    mins = []
    for w in weights:
        for j in range(PER):
            r, c, b = F.col(f"r{j}"), F.col(f"c{j}"), F.col(f"b{j}")
            t = F.floor(F.col(f"ln_{w}") / r + b)
            mins.append(F.min(c - r * (t - b + 1)).alias(f"{w}_{j}"))
    return x.groupBy("doc_id", "lane").agg(*mins)


def signatures(docs: DataFrame, texts: dict[str, str], id_col: str = "doc_id") -> DataFrame:
    """``doc_id`` and, per entry name -> text column, an array of SAMPLES
    longs (null for texts without words).  ``docs`` has one row per id."""
    names = list(texts)
    words = docs.select(F.col(id_col).alias("doc_id"),
                        *[F.split(text_or_empty(c), BLANK).alias(f"w_{n}") for n, c in texts.items()])
    side = F.lit(0)
    bound = F.lit(0)
    for i, n in enumerate(names[:-1]):
        bound = bound + F.size(f"w_{n}")
        side = F.when(F.col("pos") >= F.col(f"end{i}"), i + 1).otherwise(side)
        words = words.withColumn(f"end{i}", bound)
    rows = words.select("doc_id", *[f"end{i}" for i in range(len(names) - 1)],
                        F.posexplode(F.concat(*[F.col(f"w_{n}") for n in names])))
    rows = rows.filter("col != ''").select("doc_id", F.xxhash64("col").alias("term"),
                                           side.alias("side"))
    terms = rows.groupBy("doc_id", "term").agg(
        *[F.ln(F.sum(F.when(F.col("side") == i, 1).otherwise(0)).cast("double")).alias(f"ln_{n}")
          for i, n in enumerate(names)])
    mins = _samples(terms, names)
    key = lambda n: F.struct("lane", *[F.xxhash64(F.col(f"{n}_{j}")).alias(f"v{j}")
                                       for j in range(PER)])
    full = mins.groupBy("doc_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col(f"{n}_0").isNotNull(), key(n)))).alias(n)
          for n in names])
    flat = lambda n: F.flatten(F.transform(n, lambda s: F.array(
        *[s[f"v{j}"] for j in range(PER)])))
    return full.select("doc_id", *[F.when(F.size(n) > 0, flat(n)).alias(n) for n in names])


def likeness(a: str, b: str) -> Column:
    """Share of equal samples; empty texts are like each other only."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)),
                       F.lit(0), lambda s, v: s + v) / float(SAMPLES)
    return F.when(both, same).otherwise(
        F.when(F.col(a).isNull() & F.col(b).isNull(), 1.0).otherwise(0.0))


def as_text(sig: str) -> Column:
    part = lambda v: F.lpad(F.lower(F.hex(v.bitwiseAND(0xFFFFFFFF))), 8, "0")
    return F.coalesce(F.array_join(F.transform(sig, part), ""), F.lit(""))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(key, text)`` and ``(key, doc_id, n_any, tie)`` of every row.
    The id is the key where it is unique; else the rows are written once with
    a number each."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    facts = [F.col("doc_id"), F.length("text").cast("long").alias("n_any"),
             F.xxhash64("text").alias("tie")]
    light = stage(base.select(F.col("doc_id").alias("key"), *facts), "fp-light")
    if light.groupBy("key").count().filter("key is null or count > 1").isEmpty():
        return base.select(F.col("doc_id").alias("key"), "text"), light
    base = stage(base.withColumn("key", F.monotonically_increasing_id()), "fp-rows")
    return base.select("key", "text"), stage(base.select("key", *facts), "fp-light")


def following(rows: DataFrame) -> DataFrame:
    """``(key, doc_id, next)`` for rows ``(key, doc_id, tie)``: the row after this one by
    descending id, null ids last, rows of one id by their texts' hashes; the
    first one after the last.  The rows are dealt to ranges of that order; the
    last row of a range is followed by the first one of the next, and the
    driver holds one key per range."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie").asc(), F.col("key").asc()]
    ranges = stage(rows.select("key", "doc_id", "tie").repartitionByRange(*order)
                   .withColumn("part", F.spark_partition_id()), "fp-ranges")
    own = ranges.select("key", "doc_id", "part",
                        F.lead("key").over(Window.partitionBy("part").orderBy(*order)).alias("next"),
                        F.lag("key").over(Window.partitionBy("part").orderBy(*order)).alias("before"))
    own = stage(own, "fp-next")
    firsts = [(r["part"], r["key"]) for r in own.filter("before is null").orderBy("part").collect()]
    after = [(part, firsts[(k + 1) % len(firsts)][1]) for k, (part, _) in enumerate(firsts)]
    ends = rows.sparkSession.createDataFrame(after, "part int, start long")
    return (own.join(F.broadcast(ends), "part")
            .select("key", "doc_id", F.coalesce("next", "start").alias("next")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The query's rows; see the module text."""
    base, light = _keyed(docs, id_col, text_col)
    order = stage(following(light), "fp-order")
    # ids join last: what the texts pass through has one set of columns, so the
    # two readers of `both` share its exchanges
    prev = order.select("key", "next").join(light.select("key", "n_any"), "key") \
        .select(F.col("next").alias("key"), F.col("key").alias("prev_key"),
                F.floor(F.col("n_any") / 3).cast("int").alias("need"))
    heads = (base.join(prev, "key")
             .select(F.col("prev_key").alias("key"), F.left(F.col("text"), F.col("need")).alias("head")))
    n = F.length("text")
    both = base.join(heads, "key").select(
        "key", "text", n.cast("long").alias("n_chars"),
        F.concat(F.left(F.col("text"), n - F.floor(n / 3).cast("int")), F.col("head")).alias("edited"))
    sums = both.select("key", "n_chars",
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    sig = signatures(both, {"o": "text", "e": "edited"}, "key").withColumnRenamed("doc_id", "key")
    got = stage(sums.join(sig, "key", "left"), "fp-signed")
    nxt = order.join(got.select(F.col("key").alias("next"), F.col("o").alias("nx")), "next") \
        .select("key", "doc_id", "nx")
    return got.join(nxt, "key").select(
        "doc_id", "n_chars", "edited_sha256", as_text("o").alias("fingerprint"),
        as_text("e").alias("edited_fingerprint"), likeness("o", "e").alias("near_edited"),
        likeness("o", "nx").alias("near_next"))
