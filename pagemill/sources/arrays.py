"""JSON array files, read in splits and written back (IO1, IO2, IO7).

A raw line break cannot stand inside a JSON string, so a line can be read on
its own: outside its strings, brackets change the nesting depth and commas
separate.  Only the depth at the start of a split is unknown.  Two passes over
the lines of Spark's text reader settle it:

1. every split reports how its lines change the depth, and how many commas and
   array openings it has at each depth relative to its start: one small row a
   split.  Running sums over the splits of a file, on the driver, which planned
   those same splits, give the absolute depth and the elements before;
2. every split cuts its lines at the commas of depth one.  Elements that lie
   within a split leave as they are; the first and last piece of a split are
   joined by position, at most two rows a split.

So a large file in the crawler's indented form is read by as many tasks as it
has splits.  A file without line breaks is one line, hence one task.

Positions rise in file order, then element order, and are dense but for one
number left out by each empty array.  Text that is not exactly one array, an
unclosed string or bracket, an empty element and a malformed element raise.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections import Counter
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..batches import all_parts
from ..session import ship_package, stage
from .files import FILES, Sink, base_of, plain, relative

_TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"|[\[\]{},"]')
_PIECES = "name string, pos long, at long, partial boolean, alone boolean, json string"
#: Entries, and bytes of them, per written file; what is longer becomes several
#: arrays.  Bytes are summed over grains of entries.
FILE_BITS, FILE_BYTES, GRAIN_BITS = 20, 1 << 27, 8


class MalformedArray(ValueError):
    """Text that is not exactly one JSON array."""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", True).text(path)
            .select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("at")))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    for batch in all_parts(batches):
        yield from zip(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()),
                       batch.column(0).to_pylist())


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, depth, commas, opens = None, 0, Counter(), Counter()

    def report() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in (
                (now[0], pa.string()), (now[1], pa.int64()), (depth, pa.int64()),
                (list(commas.items()), pa.map_(pa.int64(), pa.int64())),
                (list(opens.items()), pa.map_(pa.int64(), pa.int64())))],
            names=["file", "at", "change", "commas", "opens"])

    for split, line in _by_split(batches):
        if split != now:
            if now is not None:
                yield report()
            now, depth, commas, opens = split, 0, Counter(), Counter()
        for m in _TOKEN.finditer(line):
            c = m.group()
            if c == b",":
                commas[depth] += 1
            elif c == b"[":
                opens[depth] += 1
                depth += 1
            elif c == b"{":
                depth += 1
            elif c == b"]" or c == b"}":
                depth -= 1
    if now is not None:
        yield report()


class _Start:
    """Where a split begins: depth, position of its first element, and whether
    its file has no comma of depth one."""

    __slots__ = ("depth", "pos", "alone")

    def __init__(self, depth: int, pos: int):
        self.depth, self.pos, self.alone = depth, pos, False


def _starts(spark: SparkSession, lines: DataFrame) -> dict[tuple[str, int], _Start]:
    """The start of every split; raises where the brackets of a file are not
    one array."""
    rows = lines.mapInArrow(_survey, "file string, at long, change long, "
                            "commas map<long,long>, opens map<long,long>").collect()
    files: dict[str, list] = {plain(f): [] for f in lines.inputFiles()}
    for r in rows:
        files.setdefault(plain(r["file"]), []).append(r)
    out: dict[tuple[str, int], _Start] = {}
    base = 0
    for file, splits in sorted(files.items()):
        depth = elements = arrays = 0
        mine = []
        for r in sorted(splits, key=lambda r: r["at"]):
            mine.append(_Start(depth, base + elements))
            out[r["file"], r["at"]] = mine[-1]
            elements += r["commas"].get(1 - depth, 0)
            arrays += r["opens"].get(-depth, 0)
            depth += r["change"]
        if depth or arrays != 1:
            raise MalformedArray(f"not one JSON array: {file}")
        for s in mine:
            s.alone = elements == 0
        base += elements + 1
    return out


def _cut(starts: dict[tuple[str, int], _Start], base: str):
    """Pieces of elements from the lines of a task."""
    schema = pa.schema([("name", pa.string()), ("pos", pa.int64()), ("at", pa.int64()),
                        ("partial", pa.bool_()), ("alone", pa.bool_()), ("json", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        now, name, start, depth, pos = None, "", None, 0, 0
        held: list[bytes] = []
        first = False           # the piece began in an earlier split

        def leave(partial: bool) -> None:
            rows.append((name, pos, now[1], partial, start.alone, b"".join(held).strip()))
            held.clear()

        def blank(text: bytes) -> None:
            if text.strip():
                raise MalformedArray(f"text outside the array: {now[0]}")

        def batch_of() -> pa.RecordBatch:
            cols = zip(*rows)
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary()).cast(pa.string()) if f.name == "json" else pa.array(c, f.type)
                 for c, f in zip(cols, schema)], schema=schema)
            rows.clear()
            return out

        size = 0
        for split, line in _by_split(batches):
            if split != now:
                if now is not None and depth:
                    leave(True)
                now = split
                if split not in starts:
                    raise MalformedArray(f"{split[0]} changed while it was read")
                start = starts[split]
                depth, pos, first = start.depth, start.pos, start.depth > 0
                name = relative(unquote(split[0]), base)
            at = 0
            for m in _TOKEN.finditer(line):
                c = m.group()
                if c == b",":
                    if depth == 1:
                        held.append(line[at:m.start()])
                        leave(first)
                        pos, first, at = pos + 1, False, m.end()
                elif c == b"[" or c == b"{":
                    if depth == 0:
                        blank(line[at:m.start()])
                        if c != b"[":
                            raise MalformedArray(f"not an array: {now[0]}")
                        at = m.end()
                    depth += 1
                elif c == b"]" or c == b"}":
                    depth -= 1
                    if depth < 0 or (depth == 0 and c != b"]"):
                        raise MalformedArray(f"unbalanced brackets: {now[0]}")
                    if depth == 0:
                        held.append(line[at:m.start()])
                        leave(first)
                        first, at = False, m.end()
                elif c == b'"':
                    raise MalformedArray(f"a string is not closed: {now[0]}")
            if depth:
                held.append(line[at:] + b"\n")
            else:
                blank(line[at:])
            size += len(line)
            if rows and (size > 1 << 20 or len(rows) >= 4096):
                yield batch_of()
                size = 0
        if now is not None and depth:
            leave(True)
        if rows:
            yield batch_of()

    return run


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """``name, pos, json`` for every element of the arrays below ``path``:
    file name relative to it, position, JSON text as it stands in the file."""
    ship_package(spark)
    lines = _lines(spark, path)
    starts = _starts(spark, lines)
    pieces = lines.mapInArrow(_cut(starts, base_of(spark, path)), _PIECES)
    whole = pieces
    if any(s.depth for s in starts.values()):
        # read twice below, cut once
        pieces = stage(pieces, "array-pieces")
        parts = F.sort_array(F.collect_list(F.struct("at", "json")))      # two rows a split
        joined = (pieces.filter("partial").groupBy("name", "pos", "alone")
                  .agg(F.array_join(F.filter(F.transform(parts, lambda p: p["json"]), lambda j: j != ""), "\n")
                       .alias("json")))
        whole = pieces.filter("not partial").select("name", "pos", "alone", "json").unionByName(joined)
    nothing = F.raise_error(F.concat(F.lit("empty element in "), "name"))
    return (whole.filter("not (alone and json = '')")
            .select("name", "pos", F.when(F.col("json") == "", nothing).otherwise(F.col("json")).alias("json")))


def parsed(text: Column) -> Column:
    """The VARIANT of an element.  It is parsed within brackets, where a second
    value after the first raises."""
    return F.variant_get(F.parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$[0]", "variant")


def _write_plan(entries: DataFrame, bits: int, most: int) -> DataFrame:
    """``name, _from, block, grain, part, several, parted``: the file that each
    grain of entries goes to."""
    span = stage(entries.groupBy("name").agg(F.min("pos").alias("_from"), F.max("pos").alias("_to")), "array-spans")
    at = F.col("pos") - F.col("_from")
    sizes = stage(entries.join(span, "name")
                  .groupBy("name", "_from", F.shiftright(at, bits).alias("block"),
                           F.shiftright(at, min(bits, GRAIN_BITS)).alias("grain"),
                           (F.shiftright(F.col("_to") - F.col("_from"), bits) > 0).alias("several"))
                  .agg(F.sum(F.coalesce(F.octet_length("json"), F.lit(0)).cast("long")).alias("bytes")), "array-sizes")
    # a block has 2^bits / 2^GRAIN_BITS grains at most
    before = F.sum("bytes").over(Window.partitionBy("name", "block").orderBy("grain")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    parts = stage(sizes.withColumn("part", F.floor(F.coalesce(before, F.lit(0)) / most).cast("long")).drop("bytes"),
                  "array-parts")
    parted = parts.filter("part > 0").select("name").distinct().withColumn("parted", F.lit(True))
    return stage(parts.join(parted, "name", "left").fillna(False, ["parted"]), "array-plan")


def write_arrays(entries: DataFrame, path: str, bits: int = FILE_BITS, most: int = FILE_BYTES) -> DataFrame:
    """Write ``name, pos, json`` as one JSON array file per name below the new
    folder ``path``, elements in ``pos`` order and indented as they are; a null
    ``json`` is no element, so a name with nothing else becomes ``[]``.  A name
    of more than ``2^bits`` positions or about ``most`` bytes becomes several
    arrays, numbered in order, so no task writes more than that.  Returns the
    manifest ``name, length, sha256``."""
    ship_package(entries.sparkSession)
    entries = stage(entries.select("name", "pos", "json"), "array-entries")    # read again below
    plan = _write_plan(entries, bits, most)
    starts = stage(plan.groupBy("name").agg(F.first("_from").alias("_from")), "array-starts")
    rows = (entries.join(starts, "name")
            .withColumn("grain", F.shiftright(F.col("pos") - F.col("_from"), min(bits, GRAIN_BITS)))
            .join(plan.drop("_from"), ["name", "grain"])
            .select("name", "several", "block", "parted", "part", "pos", "json"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, now, some = None, None, False

        def file_of(name: str, several: bool, block: int, parted: bool, part: int) -> str:
            stem, end = posixpath.splitext(name)
            return stem + (f"-{block:06d}" if several else "") + (f"-{part:06d}" if parted else "") + end

        def close() -> pa.RecordBatch:
            sink.write(b"\n]" if some else b"]")
            length, sha = sink.close()
            return pa.RecordBatch.from_pydict({"name": [file_of(*now)], "length": [length], "sha256": [sha]})

        for batch in all_parts(batches):
            keys = zip(*(batch.column(i).to_pylist() for i in range(5)))
            for key, text in zip(keys, batch.column(6).to_pylist()):
                if key != now:
                    if sink is not None:
                        yield close()
                    now, sink, some = key, Sink(path, file_of(*key)), False
                    sink.write(b"[")
                if text is not None:
                    sink.write((b",\n    " if some else b"\n    ") + text.encode())
                    some = True
        if sink is not None:
            yield close()

    files = (rows.repartition("name", "block", "part").sortWithinPartitions("name", "block", "part", "pos")
             .mapInArrow(run, FILES))
    return stage(files, "array-files")


def indented(value) -> str:
    """An element in the crawler's form: indented, other scripts as they are."""
    return json.dumps(value, indent=4, ensure_ascii=False).replace("\n", "\n    ")


def update_elements(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """``name, pos, json`` with members of the objects replaced: ``fields`` maps
    a member to the column with its new value, null for no change.  Other
    members, their order, and elements that are not objects stay."""
    ship_package(rows.sparkSession)
    members = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_parts(batches):
            out = []
            for text, *new in zip(*(batch.column(i).to_pylist() for i in range(2, 3 + len(members)))):
                value = json.loads(text)
                if isinstance(value, dict):
                    value.update({k: v for k, v in zip(members, new) if v is not None})
                out.append(indented(value))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())],
                                             names=["name", "pos", "json"])

    return (rows.select("name", "pos", "json", *[F.col(c).cast("string") for c in fields.values()])
            .mapInArrow(run, "name string, pos long, json string"))
