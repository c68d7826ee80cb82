"""Operator 12: how far the sources of a language diverge in their terms.

Late string materialisation.  Each task counts the terms of its documents and
writes one row per (language, source, term) to the shared folder: a 64-bit
digest, the occurrences, the documents, and the term itself.  Every count is
then shuffled by digest alone; the column with the terms is not even read.
Terms are looked at twice only:

* for the digests that reach the document threshold, the smallest and the
  largest term are compared.  Where they differ, two terms share the digest,
  and its rows are counted again by digest and term number;
* the terms of the rows that are reported are joined back by digest.

A digest below the threshold cannot hide a term above it, so unkept digests
need no comparison.

A share is ``1 + floor(UNIT * (n + SMOOTH) / (N + SMOOTH * V))``, taken in
three exact long divisions.  For the pairs, the sources of a language are dealt
to tiles of about ``TILE`` and the kept terms to buckets of about ``TERMS``; a
task holds two tiles in one bucket as a matrix of shares, so memory is bounded
by these two numbers, and only sums per pair leave it.  The pairs of sources
themselves are the result.

Defined cases: null text, language or source is the empty string; a text
without a term adds its group only; a language without kept terms has pairs of
value 0 and no terms; repeated rows count each; equal values rank by the item's
UTF-8 bytes; an empty table gives an empty result; a text of any length is
counted whole, with memory in proportion to it; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_tasks, stage

MIN_DOCS = 30
TOP = 50
UNIT = 1000          # three times: 10^9
SMOOTH = 5
TILE = 256
TERMS = 2048
#: Digests that are broadcast at most (eight bytes each, some 50 MB as a table).
BROADCAST = 1 << 21
#: Entries that a task counts before it writes them out.
HELD = 300_000

#: Letters A-Z in lower case, all other ASCII but a-z to a space.  Bytes of
#: longer code points stay, so this works on UTF-8.
_TABLE = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b > 0x7F else 0x20
               for b in range(256))


def digest(term: bytes, bits: int = 64) -> int:
    """A signed digest of ``bits`` bits."""
    return (xxhash.xxh64_intdigest(term) >> (64 - bits)) - (1 << (bits - 1))


def term_counts(docs: DataFrame, bits: int = 64, hold: int = HELD) -> DataFrame:
    """Rows ``lang, source, digest, n, docs, term``, one per task, group and
    term, and one per task and group with a null digest."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("digest", pa.int64()),
                        ("n", pa.int64()), ("docs", pa.int64()), ("term", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, seen) in groups.items():
                terms = list(n)
                rows = [[digest(t, bits) for t in terms], list(n.values()), [seen[t] for t in terms],
                        [t.decode("utf-8", "replace") for t in terms]]
                for col, extra in zip(rows, (None, 0, 0, None)):
                    col.append(extra)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v] * len(rows[0]), pa.string()) for v in (lang, source)]
                    + [pa.array(c, f.type) for c, f in zip(rows, list(schema)[2:])], schema=schema)
            groups.clear()

        held = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(langs, sources, texts):
                n, seen = groups.setdefault((lang, source), (Counter(), Counter()))
                found = text.as_py().translate(_TABLE).split()
                held -= len(n)
                n.update(found)
                seen.update(set(found))
                held += len(n)
                if held > hold:
                    yield from flush()
                    held = 0
        yield from flush()

    light = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("lang", "source", "text")])
    return map_tasks(light, run, "lang string, source string, digest long, n long, docs long, term string")


def _cells(counts: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The kept terms as ``lang, source, digest, part, n, lang_n``, as
    ``lang, digest, part, lang_n`` and as ``digest, part, term``; ``part`` tells
    terms of one digest apart."""
    rows = counts.filter("digest is not null")
    light = stage(rows.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
                  .withColumn("part", F.lit(0)), "term-cells")

    def frequent(cells: DataFrame) -> DataFrame:
        return (cells.groupBy("lang", "digest", "part")
                .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                .filter(F.col("docs") >= min_docs).select("lang", "digest", "part", "lang_n"))

    kept = stage(frequent(light), "kept-terms")
    known = stage(kept.select("digest").distinct(), "kept-digests")
    # a small set goes to the terms; a large one meets them by digest
    small = known.count() <= BROADCAST
    words = stage(rows.select("digest", "term").join(F.broadcast(known) if small else known, "digest", "left_semi")
                  .groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last"))
                  .withColumn("part", F.lit(0)), "kept-words")
    mixed = words.filter("term != last").select("digest")
    if not mixed.isEmpty():
        split = rows.join(mixed, "digest", "left_semi")
        # the terms of one digest: a handful
        number = stage(split.select("digest", "term").distinct().withColumn(
            "part", F.row_number().over(Window.partitionBy("digest").orderBy("term"))), "split-words")
        parts = (split.join(number, ["digest", "term"]).groupBy("lang", "source", "digest", "part")
                 .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
        light = stage(light.join(mixed, "digest", "left_anti").unionByName(parts), "term-cells")
        kept = stage(frequent(light), "kept-terms")
        words = words.filter("term = last").select("digest", "part", "term").unionByName(number)
    cells = stage(light.select("lang", "source", "digest", "part", "n").join(kept, ["lang", "digest", "part"]),
                  "kept-cells")
    return cells, kept, words.select("digest", "part", "term")


def _share(n: Column, total: Column) -> Column:
    """``1 + floor(UNIT^3 * n / total)`` in longs; ``n <= total < 2^53``."""
    out, left = F.lit(0).cast("long"), n.cast("long")
    for _ in range(3):
        scaled = left * UNIT
        out = out * UNIT + F.call_function("div", scaled, total)
        left = scaled % total
    return out + 1


def _groups(counts: DataFrame, cells: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, gid, total, lang_total, v, zero``: every group with the
    smoothed totals of its language and itself; ``zero`` is the share of a term
    that it lacks (null without kept terms)."""
    names = counts.select("lang", "source").distinct()
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    sources = names.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    v = F.coalesce("v", F.lit(0))
    total = F.coalesce("total", F.lit(0)) + SMOOTH * v
    return stage(names.join(own, ["lang", "source"], "left").join(whole, "lang", "left").join(sources, "lang")
                 .select("lang", "source", "sources", v.alias("v"), total.alias("total"),
                         (F.coalesce("lang_total", F.lit(0)) + SMOOTH * v).alias("lang_total"))
                 .withColumn("zero", F.when(F.col("v") > 0, _share(F.lit(SMOOTH), F.col("total"))))
                 .withColumn("gid", F.monotonically_increasing_id()), "term-groups")


def _pair_sums(rows: DataFrame) -> DataFrame:
    """``a, b, terms, value``: sums of share differences over the ``terms`` of a
    matrix, each pair once per bucket.  A row has ``lang, t, u`` (tiles of sources), ``bucket``, ``gid``,
    ``tile``, ``digest``, ``part``, ``share``; digest is null for the share of
    a lacking term, of which each group has one in every matrix."""

    def run(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("gid", "tile", "share", "t", "u")}
        base = table.column("digest").is_null().to_numpy()
        gid, first = np.unique(col["gid"][base], return_index=True)
        zero, tile = col["share"][base][first], col["tile"][base][first]
        cell = ~base
        key = np.stack([table.column(c).fill_null(0).to_numpy()[cell] for c in ("digest", "part")])
        _, at = np.unique(key, axis=1, return_inverse=True)
        at = at.reshape(-1)
        p = np.repeat(zero[:, None], int(at.max(initial=-1)) + 1, axis=1)
        p[np.searchsorted(gid, col["gid"][cell]), at] = col["share"][cell]
        t, u = col["t"][0], col["u"][0]
        out: list[list[np.ndarray]] = [[], [], [], []]
        for i in np.flatnonzero(tile == t):
            # pairs within a tile once, pairs of two tiles from the first one
            others = np.flatnonzero(tile == u)
            others = others[others > i] if t == u else others
            out[0].append(np.full(len(others), gid[i]))
            out[1].append(gid[others])
            out[2].append(np.full(len(others), p.shape[1]))
            out[3].append(np.abs(p[others] - p[i]).sum(axis=1))
        return pa.table([pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64)) for c in out],
                        names=["a", "b", "terms", "value"])

    return rows.groupBy("lang", "t", "u", "bucket").applyInArrow(run, "a long, b long, terms long, value long")


def pairs(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each other source of the language."""
    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    g = (groups.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("source"), "tiles").cast("int"))
         .withColumn("buckets", F.greatest(F.lit(1), F.ceil(F.col("v") / TERMS)).cast("int")))
    base = (g.withColumn("bucket", F.explode(F.expr("sequence(0, buckets - 1)")))
            .select("lang", "tiles", "tile", "bucket", "gid", F.lit(None).cast("long").alias("digest"),
                    F.lit(0).alias("part"), F.coalesce("zero", F.lit(0)).alias("share")))
    have = (cells.join(g, ["lang", "source"])
            .select("lang", "tiles", "tile", F.pmod(F.xxhash64("digest", "part"), "buckets").cast("int").alias("bucket"),
                    "gid", "digest", "part", _share(F.col("n") + SMOOTH, F.col("total")).alias("share")))
    rows = (base.unionByName(have).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
            .withColumn("t", F.least("tile", "other")).withColumn("u", F.greatest("tile", "other"))
            .drop("other", "tiles"))
    half = stage(_pair_sums(rows).groupBy("a", "b")
                 .agg(F.sum("terms").alias("terms"), F.sum("value").alias("value")), "pair-sums")
    both = half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "terms", "value"))
    # terms that neither source has, and no other of their tiles, are in no matrix
    lacking = (F.col("v") - F.col("terms")) * F.coalesce(F.abs(F.col("zero") - F.col("other")), F.lit(0))
    return (both.join(groups.select(F.col("gid").alias("a"), "lang", "source", "v", "zero"), "a")
            .join(groups.select(F.col("gid").alias("b"), F.col("source").alias("item"),
                                F.col("zero").alias("other")), "b")
            .select("lang", "source", "item", (F.col("value") + lacking).alias("value")))


def top_terms(groups: DataFrame, cells: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value`` of the terms over-used by a group that can
    rank to ``top``; terms are joined to these only."""
    value = (_share(F.col("n") + SMOOTH, F.col("total"))
             - _share(F.col("lang_n") + SMOOTH, F.col("lang_total")))
    over = (cells.join(groups, ["lang", "source"])
            .select("lang", "source", "digest", "part", value.alias("value")).filter("value > 0"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = stage(over.withColumn("r", F.rank().over(w)).filter(F.col("r") <= top).drop("r"), "top-terms")
    return best.join(words, ["digest", "part"]).select("lang", "source", F.col("term").alias("item"), "value")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bits: int = 64,
          hold: int = HELD) -> DataFrame:
    """``lang, source, part, item, value, rank``."""
    counts = stage(term_counts(docs, bits, hold), "term-counts")
    cells, kept, words = _cells(counts, min_docs)
    groups = _groups(counts, cells, kept)
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                           F.row_number().over(w).alias("rank"))

    return (ranked(pairs(groups, cells), "pair")
            .unionByName(ranked(top_terms(groups, cells, words, top), "term").filter(F.col("rank") <= top)))


#: DuckDB SQL of ``audit``.
ORACLE = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
u AS MATERIALIZED (SELECT i, lang, source, term, count(*) AS n
    FROM (SELECT i, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n)::HUGEINT AS n FROM u GROUP BY ALL HAVING count(DISTINCT i) >= 30),
l AS (SELECT lang, sum(n)::HUGEINT AS t, count(*) AS v FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT u.lang, u.source, term, sum(u.n)::HUGEINT AS n
    FROM u JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(l.t, 0) AS lt, coalesce(l.v, 0) AS v,
             (SELECT coalesce(sum(n), 0) FROM c WHERE c.lang = x.lang AND c.source = x.source)::HUGEINT AS t
      FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN l USING (lang)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.t + 5 * g.v) AS p,
           1 + (1000000000 * (k.n + 5)) // (g.lt + 5 * g.v) AS q
    FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
               FROM p x JOIN p y USING (lang, term) GROUP BY ALL) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pair
UNION ALL
SELECT lang, source, 'term', item, value,
       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM term
QUALIFY rank <= 50
"""
