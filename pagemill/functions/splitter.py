"""Recursive character splitter (CK1) and its Spark column form.

Contract (public behaviour of the recursive character splitter with default
separators, lengths in code points):

1. Use the first separator that occurs in the text (the empty one always).
2. Split on it; pieces after the first keep the separator as a prefix; empty
   pieces vanish; the empty separator gives single characters.
3. Pieces shorter than ``size`` are collected.  A longer piece flushes the
   collected run through the merge, is split again with the remaining
   separators, and its chunks are emitted in place.
4. Merge greedily; when the next piece would overflow, emit the run, then drop
   pieces from its left until what is kept is at most ``overlap`` long and the
   next piece fits (or nothing is kept).
5. Every emitted chunk is stripped of whitespace; empty chunks vanish.

The per-row work is a short loop over one document; Spark runs it in Arrow
batches next to the data, so documents never leave their task.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..batches import map_parts
from .text import WS_CHARS

# Chunk size and overlap of the index, and separator order.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 100
SEPARATORS = ("\n\n", "\n", " ", "")


def _pieces(text: str, sep: str) -> list[str]:
    if sep == "":
        return list(text)
    parts = text.split(sep)
    out = [parts[0]] + [sep + p for p in parts[1:]]
    return [p for p in out if p]


def _merge(pieces: list[str], size: int, overlap: int, out: list[str]) -> None:
    first = total = 0                 # the run is pieces[first:i]
    for i, piece in enumerate(pieces):
        n = len(piece)
        if total + n > size and first < i:
            _emit(pieces[first:i], out)
            while total > overlap or (total + n > size and total > 0):
                total -= len(pieces[first])
                first += 1
        total += n
    _emit(pieces[first:], out)


def _emit(run: list[str], out: list[str]) -> None:
    chunk = "".join(run).strip(WS_CHARS)
    if chunk:
        out.append(chunk)


def split_piece(text: str, seps: tuple[str, ...], size: int, overlap: int, out: list[str]) -> None:
    """Append the chunks of a text of ``size`` or more code points."""
    level = len(seps) - 1
    for i, s in enumerate(seps):
        if s == "" or s in text:
            level = i
            break
    sep, rest = seps[level], seps[level + 1:]
    small: list[str] = []
    for piece in _pieces(text, sep):
        if len(piece) < size:
            small.append(piece)
            continue
        if small:
            _merge(small, size, overlap, out)
            small = []
        if rest:
            split_piece(piece, rest, size, overlap, out)
        else:
            out.append(piece)
    if small:
        _merge(small, size, overlap, out)


def split_text(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks of one text; ``[]`` for null or blank text."""
    if not text:
        return []
    if len(text) < size:
        chunk = text.strip(WS_CHARS)
        return [chunk] if chunk else []
    out: list[str] = []
    split_piece(text, tuple(separators), size, overlap, out)
    return out


def safe_splitter(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                  separators: tuple[str, ...] = SEPARATORS,
                  split: Callable[[str | None, int, int], list[str]] | None = None,
                  ) -> Callable[[str | None], list[str] | None]:
    """The splitter as a function of one text that gives None where it fails."""
    seps = tuple(separators)
    fn = split if split is not None else lambda t, n, o: split_text(t, n, o, seps)

    def one(text: str | None) -> list[str] | None:
        try:
            return fn(text, size, overlap)
        except Exception:  # noqa: BLE001  (the row is reported as an error)
            return None

    return one


def chunk_column(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                 separators: tuple[str, ...] = SEPARATORS,
                 split: Callable[[str | None, int, int], list[str]] | None = None) -> Column:
    """``ARRAY<STRING>`` of chunks, computed in Arrow batches.  ``split`` puts
    another splitter in place.  A row on which it fails gives NULL; other rows
    are not affected."""
    one = safe_splitter(size, overlap, separators, split)

    @F.arrow_udf(ArrayType(StringType()))
    def _chunks(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        return map_parts(texts, lambda part: pa.array([one(t) for t in part.to_pylist()], type=kind), kind)

    return _chunks(text)


def chunk_column_native(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                        separators: tuple[str, ...] = SEPARATORS) -> Column:
    """The same contract with higher-order functions only (no Python worker).

    Pieces are kept as ``(run, t, done)``.  One stage per separator splits
    every element that is not done and holds the separator; a small piece is
    done and tagged with its parent's run plus the level, a large piece gets
    its own run (parent run, level, index) and waits for the next separator.
    Neighbours with the same run form one merge group.  A fold then merges
    each group greedily with the overlap rule.  Slower than the Arrow form;
    kept as a cross-check and for clusters without Python workers.
    """
    ws = F.lit(WS_CHARS)

    def elem(run, t, done):
        return F.struct(run.alias("run"), t.alias("t"), done.alias("done"))

    arr = F.array(elem(F.lit("r"), text, F.lit(False)))
    def stage(level: int, sep: str):
        # a closure: a second lambda parameter would receive the element index
        def expand(e):
            if sep == "":
                pieces = F.regexp_extract_all(e["t"], F.lit("(?s)."), 0)
                skip = e["done"]
            else:
                raw = F.split(e["t"], sep.replace("\n", "\\n"), -1)
                prefixed = F.transform(raw, lambda p, i: F.when(i == 0, p)
                                       .otherwise(F.concat(F.lit(sep), p)))
                pieces = F.filter(prefixed, lambda p: p != "")
                skip = e["done"] | ~F.contains(e["t"], F.lit(sep))
            tagged = F.transform(pieces, lambda p, j: F.when(
                F.length(p) < size,
                elem(F.concat(e["run"], F.lit(f".{level}")), p, F.lit(True))).otherwise(
                elem(F.concat(e["run"], F.lit(f".{level}."), j.cast("string")), p, F.lit(False))))
            return F.when(skip, F.array(e)).otherwise(tagged)
        return expand

    for level, sep in enumerate(separators):
        arr = F.flatten(F.transform(arr, stage(level, sep)))

    def emit(out, cur):
        joined = F.btrim(F.array_join(cur, ""), ws)
        return F.when((F.size(cur) > 0) & (joined != ""), F.array_append(out, joined)).otherwise(out)

    def keep_after_drop(cur, tot, n):
        # drop pieces from the left until what is kept is <= overlap and the
        # next piece fits (or nothing is kept); returns (kept pieces, length)
        def ok(t):
            return (t <= overlap) & ((t + n <= size) | (t == 0))
        start = F.struct(F.lit(0).alias("k"), tot.alias("t"), ok(tot).alias("f"))
        def step(s, p):
            t2 = s["t"] - F.length(p)
            return F.when(s["f"], s).otherwise(F.struct(
                (s["k"] + 1).alias("k"), t2.alias("t"), ok(t2).alias("f")))
        return F.aggregate(cur, start, step, lambda s: F.struct(
            F.slice(cur, s["k"] + 1, F.greatest(F.size(cur) - s["k"], F.lit(0))).alias("cur"),
            s["t"].alias("tot")))

    empty = F.array().cast("array<string>")
    init = F.struct(F.lit("").alias("prun"), empty.alias("cur"),
                    F.lit(0).alias("tot"), empty.alias("out"))

    def merge(acc, e):
        d, n = e["t"], F.length(e["t"])
        new_group = acc["prun"] != e["run"]
        out0 = F.when(new_group, emit(acc["out"], acc["cur"])).otherwise(acc["out"])
        cur0 = F.when(new_group, empty).otherwise(acc["cur"])
        tot0 = F.when(new_group, F.lit(0)).otherwise(acc["tot"])
        over = tot0 + n > size
        kept = keep_after_drop(cur0, tot0, n)
        cur1 = F.when(over, kept["cur"]).otherwise(cur0)
        tot1 = F.when(over, kept["tot"]).otherwise(tot0)
        out1 = F.when(over, emit(out0, cur0)).otherwise(out0)
        return F.struct(e["run"].alias("prun"), F.array_append(cur1, d).alias("cur"),
                        (tot1 + n).alias("tot"), out1.alias("out"))

    folded = F.aggregate(arr, init, merge, lambda acc: emit(acc["out"], acc["cur"]))
    short = F.btrim(text, ws)
    return (F.when(text.isNull(), empty)
            .when(F.length(text) < size, F.when(short != "", F.array(short)).otherwise(empty))
            .otherwise(folded))
