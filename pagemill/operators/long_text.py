"""CK1 for documents of any length: one text cut by many tasks.

The recursive splitter reads a text from left to right, but what it decides
depends on piece lengths only.  So a long text is cut into segments, and

1. every segment reports where pieces begin (the separators in it): eight bytes
   a piece;
2. the begins of a text meet in one task, which merges the runs of small pieces
   to spans by binary search over them; no text is there;
3. the segments, which reach far enough beyond their end to hold any span that
   begins in them, cut the spans from the text, and split a large piece on with
   the separators that are left.

Pieces that are long themselves are texts of the next separator: at most one
round for each.  Segments begin after a character that is no line feed, so no
separator lies across two of them.  Chunks are ordered by where they begin.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..batches import all_parts
from ..functions import splitter as sp
from ..functions.text import WS_CHARS
from ..session import ship_package, stage
from .sequence import row_number

#: Code points from which a text is cut by many tasks, and of one segment.
LONG, SEGMENT = 1 << 20, 1 << 22

SEGMENTS = "pos long, of long, upto long, start long, stop long, level int, body string"
SPANS = "pos long, of long, start long, begin long, end long, large boolean, level int"
CHUNKS = "pos long, begin long, k int, chunk_text string"


def merge_spans(begins: Sequence[int], lo: int, hi: int, size: int, overlap: int) -> list[tuple[int, int]]:
    """Spans of the greedy merge of the pieces ``lo .. hi - 1``, each shorter
    than ``size``; piece i lies from ``begins[i]`` to ``begins[i + 1]``."""
    out, first = [], lo
    while True:
        i = bisect_right(begins, begins[first] + size, first + 1, hi + 1) - 1
        out.append((begins[first], begins[i]))
        if i == hi:
            return out
        # piece i overflows: keep at most the overlap, and room for the piece
        first = max(bisect_left(begins, begins[i] - overlap, first, i),
                    bisect_left(begins, begins[i + 1] - size, first, i))


def plan_spans(begins: Sequence[int], size: int, overlap: int) -> list[tuple[int, int, bool]]:
    """Spans of a text whose pieces begin at ``begins`` (its end comes last):
    merged runs, and pieces of ``size`` or more alone (true)."""
    if isinstance(begins, range):
        large: list[int] = [] if size > 1 else list(range(len(begins) - 1))
    else:
        large = np.flatnonzero(np.diff(np.asarray(begins)) >= size).tolist()
    out: list[tuple[int, int, bool]] = []
    at = 0
    for i in [*large, len(begins) - 1]:
        if at < i:
            out += [(a, b, False) for a, b in merge_spans(begins, at, i, size, overlap)]
        if i < len(begins) - 1:
            out.append((begins[i], begins[i + 1], True))
        at = i + 1
    return out


def _level(text: str, level: int) -> int:
    """The first separator from ``level`` on that occurs."""
    return next(i for i in range(level, len(sp.SEPARATORS)) if not sp.SEPARATORS[i] or sp.SEPARATORS[i] in text)


def _segments(texts: DataFrame, segment: int, reach: int) -> DataFrame:
    """Segments of the ranges ``at`` (begin, end, level) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_parts(batches):
            for pos, text, ranges in zip(*(c.to_pylist() for c in batch.columns)):
                for r in ranges:
                    end = r["end"]
                    level = _level(text[r["begin"]:end], r["level"])
                    start = r["begin"]
                    while start < end:
                        stop = min(start + segment, end)
                        while stop < end and text[stop - 1] == "\n":
                            stop += 1
                        row = (pos, r["begin"], end, start, stop, level, text[start:min(end, stop + reach)])
                        yield pa.RecordBatch.from_pydict(
                            {f.split(" ")[0]: [v] for f, v in zip(SEGMENTS.split(", "), row)},
                            schema=_schema(SEGMENTS))
                        start = stop

    return texts.select("pos", "text", "at").mapInArrow(run, SEGMENTS)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
             "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in ddl.split(", "))])


def _begins(segments: DataFrame) -> DataFrame:
    """Where the separators of a segment are, from the segments' texts."""
    ddl = "pos long, of long, upto long, start long, level int, seps binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_parts(batches):
            seps = []
            for start, stop, level, body in zip(*(c.to_pylist() for c in batch.columns[3:])):
                sep, found = sp.SEPARATORS[level], []
                at = body.find(sep, 0, stop - start) if sep else -1
                while at >= 0:
                    found.append(start + at)
                    at = body.find(sep, at + len(sep), stop - start)
                seps.append(np.array(found, "<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in (0, 1, 2, 3, 5)], pa.array(seps, pa.binary())], schema=_schema(ddl))

    return segments.select("pos", "of", "upto", "start", "stop", "level", "body").mapInArrow(run, ddl)


def _spans(begins: DataFrame, size: int, overlap: int) -> DataFrame:
    """Spans of every text with the segment that each begins in."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        first, end, level = rows[0]["of"], rows[0]["upto"], rows[0]["level"]
        if sp.SEPARATORS[level]:
            seps = np.concatenate([np.frombuffer(r["seps"], "<i8") for r in rows])
            at = np.unique(np.concatenate([[first], seps, [end]])).tolist()
        else:
            at = range(first, end + 1)
        spans = plan_spans(at, size, overlap)
        starts = [r["start"] for r in rows]
        cols = list(zip(*[(rows[0]["pos"], first, starts[bisect_right(starts, a) - 1], a, b, large, level)
                          for a, b, large in spans]))
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, _schema(SPANS))], schema=_schema(SPANS))

    return begins.groupBy("pos", "of").applyInArrow(run, SPANS)


def _cut(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """Chunks of the ``spans`` of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_parts(batches):
            for pos, start, level, body, spans in zip(*(c.to_pylist() for c in batch.columns)):
                out: list[tuple] = []
                rest = tuple(sp.SEPARATORS[level + 1:])
                for s in spans:
                    piece = body[s["begin"] - start:s["end"] - start]
                    chunks: list[str] = []
                    if not s["large"]:
                        piece = piece.strip(WS_CHARS)
                        chunks = [piece] if piece else []
                    elif rest:
                        sp.split_piece(piece, rest, size, overlap, chunks)
                    else:
                        chunks = [piece]
                    out += [(pos, s["begin"], k, c) for k, c in enumerate(chunks)]
                for at in range(0, len(out), 4096):
                    cols = zip(*out[at:at + 4096])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(cols, _schema(CHUNKS))], schema=_schema(CHUNKS))

    return rows.select("pos", "start", "level", "body", "spans").mapInArrow(run, CHUNKS)


def chunk_long(texts: DataFrame, size: int = sp.CHUNK_SIZE, overlap: int = sp.CHUNK_OVERLAP,
               long: int = LONG, segment: int = SEGMENT) -> DataFrame:
    """``pos, chunk_index, chunk_text`` of texts ``(pos, text)`` of ``size`` code
    points or more, by many tasks each.  ``pos`` is unique."""
    if long < size:
        raise ValueError("a long piece must be one that is split")
    ship_package(texts.sparkSession)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.length("text").cast("long").alias("end"),
                             F.lit(0).alias("level")))
    todo = texts.select("pos", "text", whole.alias("at"))
    done = []
    while True:
        # one row a segment, spread over the tasks
        segments = stage(_segments(todo, segment, long).repartition("pos", "of", "start"), "text-segments")
        spans = stage(_spans(_begins(segments), size, overlap), "text-spans")
        next_round = F.col("large") & (F.col("end") - F.col("begin") >= long)
        mine = (spans.filter(~next_round).groupBy("pos", "of", "start")
                .agg(F.collect_list(F.struct("begin", "end", "large")).alias("spans")))
        done.append(stage(_cut(segments.join(mine, ["pos", "of", "start"]), size, overlap), "text-chunks"))
        more = (spans.filter(next_round).groupBy("pos").agg(F.collect_list(F.struct(
            "begin", "end", (F.col("level") + 1).alias("level"))).alias("at")))
        if more.isEmpty():
            break
        todo = texts.join(more, "pos").select("pos", "text", "at")
    rows = done[0]
    for d in done[1:]:
        rows = rows.unionByName(d)
    # a bucket has the chunks that begin within 2^20 code points
    numbered = row_number(rows, ["pos"], ["begin", "k"], F.shiftright("begin", 20), name="n")
    return numbered.select("pos", (F.col("n") - 1).cast("int").alias("chunk_index"), "chunk_text")


def chunk_documents(texts: DataFrame, size: int = sp.CHUNK_SIZE, overlap: int = sp.CHUNK_OVERLAP,
                    long: int = LONG, segment: int = SEGMENT) -> DataFrame:
    """Chunks of all texts ``(pos, text)``: in their row, or by many tasks from
    ``long`` code points on."""
    light = texts.select("pos", "text")
    lengthy = F.coalesce(F.length("text"), F.lit(0)) >= long
    short = (light.filter(~lengthy)
             .select("pos", F.posexplode(sp.chunk_column(F.col("text"), size, overlap)).alias("chunk_index", "chunk_text")))
    return short.unionByName(chunk_long(light.filter(lengthy), size, overlap, long, segment))
