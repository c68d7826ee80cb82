"""Operator 7: bytes covered by repeated 400-byte strings.

The construction is column-wise over many strings: one symbol of every string
is inserted per round, which updates the collection's (positional)
Burrows-Wheeler order and the common-prefix lengths of neighbours in it.  The
strings are not whole documents, which would need as many rounds as the
longest one has bytes and a sweep over everything in each.  They are contexts:

1. every 400-byte window has a minimizer, the leftmost 64-byte gram with the
   smallest hash in it, so equal windows hold equal anchors at equal offsets.
   Anchors are about one per 169 bytes; those whose hash occurs once go.
2. the context of an anchor is the 336 bytes before and the 400 bytes from it
   (cut at the document's ends): all windows it can be the minimizer of.
   Contexts are aligned at the anchor, so after the round of column j the
   order sorts contexts by the string that ends at j, and two neighbours with
   400 or more equal symbols show a repeated window.  Contexts live in an
   external table in the shared folder, sorted by anchor, and stream through
   a task a bounded batch at a time, whole anchor groups together.
3. anchor groups beyond ``LIMIT`` contexts never meet in one task: their
   windows, each at its own minimizer, are counted by 128-bit hash in a
   shuffle.  A context knows whether its anchor is crowded, so no join stands
   between the table of contexts and the exchange that groups it: behind a
   join on the anchor Spark drops that exchange and may split its groups.
4. exact copies are recognised by digest first: a text of 400 or more bytes
   that occurs twice is covered whole, and one copy stands for it.

Defined cases: null text is empty; a text under 400 bytes keeps all; matches
never cross documents; rows that repeat an id, or have none, are documents of
their own (one result row per row; inside, a 64-bit hash of id and text names
them); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_batches, map_tasks, stage, text_or_empty

LENGTH = 400
GRAM = 64
SIDE = LENGTH - GRAM
WIDE = LENGTH + SIDE
#: Contexts in a batch; contexts of one anchor that may meet in one task;
#: contexts whose windows are in memory at once.
BATCH, LIMIT, FEW = 8192, 8192, 256
#: A document is searched for anchors in overlapping parts of this size.
PART = 1 << 20
_LOW = np.uint64((1 << 24) - 1)
_R1, _R2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _powers(base: int, n: int, cache: dict = {}) -> np.ndarray:  # noqa: B006
    """base**i mod 2**64; grown by doubling and kept."""
    p = cache.get(base, np.ones(1, np.uint64))
    while len(p) < n:
        step = np.uint64(pow(base, len(p), 1 << 64))
        p = np.concatenate([p, p * step])
    cache[base] = p
    return p[:n]


def _rolling(b: np.ndarray, k: int, base: int) -> np.ndarray:
    """A 64-bit hash of every k bytes."""
    n = len(b)
    with np.errstate(over="ignore"):
        pre = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers(base, n), out=pre[1:])
        h = (pre[k:] - pre[:n - k + 1]) * _powers(pow(base, -1, 1 << 64), n - k + 1)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _minimizers(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The minimizer's position in every window of ``b``, and hashes of the grams."""
    h = _rolling(b, GRAM, _R1)
    w = LENGTH - GRAM + 1
    # high bits of the hash, then the position: the least is the leftmost
    key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    pad = -len(key) % w
    blocks = np.concatenate([key, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(key) - w + 1
    least = np.minimum(after[:n], before[w - 1:w - 1 + n])
    return (least & _LOW).astype(np.int64), h


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the minimizers of all windows."""
    found = []
    for at in range(0, max(1, len(text) - LENGTH + 1), PART):
        b = np.frombuffer(text, np.uint8)[at:at + PART + LENGTH - 1]
        if len(b) < LENGTH:
            break
        least, h = _minimizers(b)
        pos = np.unique(least)
        found.append((pos + at, h[pos]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pos = np.concatenate([p for p, _ in found])
    h = np.concatenate([x for _, x in found])
    pos, first = np.unique(pos, return_index=True)
    return pos, h[first].view(np.int64)


def _anchors(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, pos, hs = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for doc, t in zip(batch.column(0), batch.column(1)):
        p, h = anchors(t.as_py())
        ids.append(np.full(len(p), doc.as_py(), np.int64))
        pos.append(p)
        hs.append(h)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (hs, ids, pos)],
                                      names=["h", "doc_id", "pos"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of the anchors, some four times their text, in small batches."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
    cols: list[list] = [[], [], [], [], []]

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                           names=["h", "doc_id", "pos", "ctx", "crowded"])
        for c in cols:
            c.clear()
        return batch

    for batch in batches:
        for doc, t, at in zip(batch.column(0), batch.column(1), batch.column(2)):
            text, doc_id = t.as_py(), doc.as_py()
            for x in at.as_py():
                p = x["pos"]
                for c, v in zip(cols, (x["h"], doc_id, p, text[max(0, p - SIDE):p + LENGTH], x["crowded"])):
                    c.append(v)
                if len(cols[0]) >= BATCH:
                    yield out()
    if cols[0]:
        yield out()


def matrix(pos: list[int], ctx: list[bytes]) -> np.ndarray:
    """(WIDE, contexts) symbols, aligned at the anchors; 256 lies outside."""
    x = np.full((len(ctx), WIDE), 256, np.int16)
    for row, p, c in zip(x, pos, ctx):
        left = max(0, SIDE - p)
        row[left:left + len(c)] = np.frombuffer(c, np.uint8)
    return np.ascontiguousarray(x.T)


def repeated_ends(cols: np.ndarray) -> np.ndarray:
    """(contexts, WIDE) marks: the 400 symbols that end here occur in another
    context at the same columns.

    ``order`` lists the contexts by the string read backwards from the last
    column inserted; ``common[i]`` is the number of last symbols that entry i
    shares with entry i - 1.  Inserting a column is a stable sort by its
    symbols; two entries that become neighbours share one more symbol than the
    least ``common`` between their old places, or none."""
    wide, n = cols.shape
    marks = np.zeros((wide, n), bool)
    if n < 2:
        return marks.T
    order = np.arange(n)
    common = np.zeros(n, np.int32)
    for j in range(wide):
        sym = cols[j][order]
        new = np.argsort(sym, kind="stable")
        # least common over (new[i-1], new[i]]: a table of powers of two
        levels = [common]
        step = 1
        while 2 * step <= n:
            last = levels[-1]
            levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2
        lo, hi = new[:-1] + 1, new[1:]
        s = sym[new]
        same = (s[1:] == s[:-1]) & (s[1:] < 256)
        nxt = np.zeros(n, np.int32)
        at = np.flatnonzero(same)
        if len(at):
            a, b = lo[at], hi[at]
            lev = np.log2(b - a + 1).astype(np.int64)
            least = np.empty(len(at), np.int32)
            for k in np.unique(lev):
                pick = lev == k
                least[pick] = np.minimum(levels[k][a[pick]], levels[k][b[pick] - (1 << k) + 1])
            nxt[at + 1] = least + 1
        order, common = order[new], nxt
        if j >= LENGTH - 1:
            hit = np.flatnonzero(common >= LENGTH)
            marks[j, order[hit]] = True
            marks[j, order[hit - 1]] = True
    return marks.T


def _ranges(doc: np.ndarray, pos: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    """Byte ranges covered by runs of marked windows."""
    edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, past = np.nonzero(edge == -1)
    base = pos[row] - SIDE
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[row]), pa.array(base + first - LENGTH + 1), pa.array(base + past)],
        names=["doc_id", "s", "e"])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor -> covered ranges; whole groups at a time."""
    held: list[tuple] = []

    def done(rows: list[tuple]) -> pa.RecordBatch:
        marks = repeated_ends(matrix([r[2] for r in rows], [r[3] for r in rows]))
        return _ranges(np.array([r[1] for r in rows], np.int64),
                       np.array([r[2] for r in rows], np.int64), marks)

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if len(held) >= BATCH and held[-1][0] != row[0]:
                yield done(held)
                held = []
            held.append(row)
    if held:
        yield done(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows whose minimizer is the anchor of a context, by 128-bit hash:
    every window of a document leaves once."""
    for batch in batches:
        for at in range(0, batch.num_rows, FEW):
            out: list[list] = [[], [], [], []]
            for doc, p, ctx in zip(*[batch.column(i).slice(at, FEW).to_pylist() for i in (1, 2, 3)]):
                b = np.frombuffer(ctx, np.uint8)
                first = max(0, p - SIDE)
                own = np.flatnonzero(_minimizers(b)[0] == p - first)
                for c, v in zip(out, (np.full(len(own), doc), first + own,
                                      _rolling(b, LENGTH, _R1).view(np.int64)[own],
                                      _rolling(b, LENGTH, _R2).view(np.int64)[own])):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out],
                                             names=["doc_id", "s", "h1", "h2"])


def _word_ranges(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Byte ranges covered by the windows whose starts are bits of words."""
    docs, words = (batch.column(i).to_numpy() for i in (0, 1))
    bits = batch.column(2).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
    edge = np.diff(np.pad(np.unpackbits(bits, axis=1, bitorder="little"), ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, past = np.nonzero(edge == -1)
    base = words[row] * 64
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[row]), pa.array(base + first), pa.array(base + past - 1 + LENGTH)],
        names=["doc_id", "s", "e"])


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    cols: list[list] = [[], [], [], [], []]
    for row, t, spans in zip(batch.column(0), batch.column(1), batch.column(2)):
        text, kept, at, n, removed = t.as_py(), [], 0, 0, 0
        end = -1
        for s, e in sorted((x["s"], x["e"]) for x in spans.as_py()):
            if s > end:
                n += 1
                kept.append(text[at:s])
            removed += max(0, e - max(s, end, 0))
            end = max(end, e)
            at = max(at, end)
        kept.append(text[at:])
        rest = b"".join(kept)
        for c, v in zip(cols, (row.as_py(), len(text), removed, n, rest)):
            c.append(v)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
        names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def _marked(texts: DataFrame, ids: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """``texts`` with ``near``: whether the row may be in ``ids``, by a bitmap
    over hashed ids: at most ``bits / 64`` words are broadcast, whatever the
    number of ids.  An equi-join follows; this only keeps other texts out of
    its shuffle."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    words = stage(ids.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
                  .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")),
                  "repeat-ids")
    near = F.expr("coalesce(getbit(bits, cast(p & 63 as int)) = 1, false)")
    return (texts.withColumn("p", place).withColumn("word", F.shiftright("p", 6))
            .join(F.broadcast(words), "word", "left").select(*texts.columns, near.alias("near")))


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` that may be in ``ids``."""
    return _marked(texts, ids).filter("near").drop("near")


def covered(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """``(doc_id, s, e)`` byte ranges of the documents ``reps`` that repeat."""
    found = map_batches(docs, _anchors, "h long, doc_id long, pos long")
    found = stage(found, "repeat-anchors").join(reps, "doc_id", "left_semi")
    often = stage(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2"),
                  "repeat-often")
    # identical rows have the same anchors, which are listed once
    per_doc = stage(found.join(often, "h").groupBy("doc_id").agg(
        F.collect_set(F.struct("h", "pos", (F.col("n") > LIMIT).alias("crowded"))).alias("at")), "repeat-at")
    some = _only(docs, per_doc.select("doc_id"))
    ctx = map_tasks(some.join(per_doc, "doc_id").select("doc_id", "text", "at"), _contexts,
                    "h long, doc_id long, pos long, ctx binary, crowded boolean")
    ctx = stage(ctx, "repeat-contexts")
    ship_package(docs.sparkSession)
    res = (ctx.filter(~F.col("crowded")).repartition("h").sortWithinPartitions("h")
           .mapInArrow(_sweep, "doc_id long, s long, e long"))
    if often.filter(F.col("n") > LIMIT).isEmpty():
        return res
    win = stage(map_tasks(ctx.filter("crowded"), _windows, "doc_id long, s long, h1 long, h2 long"),
                "repeat-windows")
    twice = stage(win.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
                  .filter("n >= 2").select("h1", "h2"), "repeat-twice")
    words = (win.join(twice, ["h1", "h2"]).groupBy("doc_id", F.shiftright("s", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits")))
    return res.unionByName(map_batches(words, _word_ranges, "doc_id long, s long, e long"))


def kept_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: what is left of every text,
    as bytes, since a cut may fall inside a character."""
    text = text_or_empty(text_col).cast("binary")
    src = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")) \
        .select("id", F.xxhash64("id", "text").alias("doc_id"), "text")   # one per id and text
    light = stage(src.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                             F.sha2("text", 256).alias("sha")).filter(F.col("n_bytes") >= LENGTH),
                  "repeat-light")
    same = stage(light.groupBy("sha").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                 "repeat-same")
    spans = stage(covered(src.drop("id").filter(F.octet_length("text") >= LENGTH),
                          same.select(F.col("rep").alias("doc_id"))), "repeat-spans")
    # only documents without copies need their ranges; copies are covered whole
    single = same.filter("copies = 1").select(F.col("rep").alias("doc_id"))
    copies = same.filter("copies > 1").select("sha")
    span = F.struct("s", "e")
    own = spans.join(single, "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_set(span).alias("spans"))
    whole = (light.join(copies, "sha", "left_semi")
             .select("doc_id", F.lit(0).cast("long").alias("s"), F.col("n_bytes").alias("e")).distinct()
             .select("doc_id", F.array(span).alias("spans")))
    gone = stage(own.unionByName(whole), "repeat-own")
    marked = _marked(src, gone.select("doc_id"))
    cut = map_batches(marked.filter("near").join(gone, "doc_id", "left")
                      .select("id", "text", F.coalesce("spans", F.array().cast("array<struct<s:bigint,e:bigint>>"))),
                      _cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    zero = F.lit(0).cast("long")
    rest = marked.filter(~F.col("near")).select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.col("text").alias("kept"))
    return cut.unionByName(rest).withColumnRenamed("id", "doc_id")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return digest(kept_bytes(docs, id_col, text_col)).drop("kept")


def digest(kept: DataFrame) -> DataFrame:
    """The rows of ``kept_bytes`` with the digest of the bytes before them."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "kept")
