"""Operator 13: exact top-k inner products by columnar branch and bound.

Vectors are quantised to integers and kept in vertical blocks: up to
``BLOCK`` rows, one matrix of ``STEP`` dimensions by rows after the other.  A
query adds up its products dimension block by dimension block.  After every
block the products still to come are at most the remaining mass of the query
times that of the candidate (Cauchy-Schwarz); candidates that cannot reach the
query's k-th best score any more are dropped and the others compacted, so
later blocks touch few columns.

The k-th best score starts with an incumbent: while the blocks are built, each
query is scored against the block that it lies in.  After that every task holds
the candidates of one range (at most ``RANGE`` rows, more only by the last
block) and the query blocks stream through it, so memory does not grow with
either side.  Each query is sent to every range, which is what a block
nested loop of a stated query set against all rows costs; a range returns at
most k rows a query, and a window over (query) keeps the best k of all.

Sums are exact: in double precision while they stay below 2^53, else in 64-bit
integers.

Defined cases: vectors that are null or hold a null or non-finite component
take no part, neither as query nor as candidate; missing components of a
shorter vector count as 0, so an empty vector scores 0 with everything; a null
id never asks, and as a candidate it comes after all ids at equal scores;
repeated rows are candidates each, of a query with a repeated id every row
asks, and only the very row that asks is left out; equal scores go to the
smaller id; an empty table gives an empty result; other columns are not read.
A component beyond 2^31 in size after scaling, or sums that could pass 2^62,
raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_tasks, stage
from .plane_clustering import quantised

STEP = 16
BLOCK = 8192
RANGE = 1 << 19
#: Query rows scored together; bounds the matrix of partial scores.
GROUP = 64
#: Candidates are compacted once less than this share of them survives.
SPARSE = 0.25
NO_ID = np.iinfo(np.int64).max
NONE = np.iinfo(np.int64).min

BLOCKS = "uid long, n int, dims int, width int, keys binary, ids binary, named binary, columns array<binary>"
FOUND = "asker long, query_id long, vec_id long, score long"


class Block:
    """Rows in vertical layout: ``x[d]`` is dimension ``d`` of all rows, in the
    narrowest integer type that holds it."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, named: np.ndarray, x: np.ndarray):
        self.keys, self.ids, self.named, self.x = keys, ids, named, x
        self.top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        self._rest: np.ndarray | None = None

    @classmethod
    def of(cls, row: dict) -> Block:
        n = row["n"]
        parts = [np.frombuffer(c, f"<i{row['width']}").reshape(-1, n) for c in row["columns"]]
        x = np.concatenate(parts) if parts else np.zeros((0, n), np.int16)
        return cls(np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["ids"], "<i8"),
                   np.frombuffer(row["named"], np.bool_), x)

    @classmethod
    def joined(cls, blocks: list[Block]) -> Block:
        dims = max(len(b.x) for b in blocks)
        x = np.concatenate([np.pad(b.x, ((0, dims - len(b.x)), (0, 0))) for b in blocks], axis=1)
        return cls(*(np.concatenate([getattr(b, f) for b in blocks]) for f in ("keys", "ids", "named")), x)

    def columns(self) -> tuple[int, list[bytes]]:
        width = 2 if self.top < 1 << 15 else 4 if self.top < 1 << 31 else 8
        x = self.x.astype(f"<i{width}")
        return width, [np.ascontiguousarray(x[d:d + STEP]).tobytes() for d in range(0, len(x), STEP)]

    def take(self, which: np.ndarray) -> Block:
        return Block(self.keys[which], self.ids[which], self.named[which], self.x[:, which])

    def rest(self) -> np.ndarray:
        """Per step and row: the mass of the dimensions after the step."""
        if self._rest is None:
            each = [(self.x[d:d + STEP].astype(np.float64) ** 2).sum(axis=0)
                    for d in range(0, len(self.x), STEP)]
            after = np.zeros((len(each), len(self.keys)))
            for s in range(len(each) - 2, -1, -1):
                after[s] = after[s + 1] + each[s + 1]
            self._rest = np.sqrt(after)
        return self._rest


class Best:
    """The best ``k`` candidates so far of every query of a block."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]     # query, -score, unnamed, id

    def add(self, q: np.ndarray, score: np.ndarray, named: np.ndarray, ids: np.ndarray) -> None:
        if not len(q):
            return
        cols = [np.concatenate(c) for c in zip(self.rows, (q, -score, (~named).astype(np.int64), ids))]
        order = np.lexsort(cols[::-1])
        cols = [c[order] for c in cols]
        first = np.searchsorted(cols[0], cols[0])
        self.rows = [c[np.arange(len(order)) - first < self.k] for c in cols]
        full = np.flatnonzero(np.bincount(self.rows[0], minlength=len(self.floor)) == self.k)
        last = np.searchsorted(self.rows[0], full, "right") - 1
        self.floor[full] = np.maximum(self.floor[full], -self.rows[1][last])


def search(queries: Block, floor: np.ndarray, cands: Block, k: int, tile: int = BLOCK) -> Best:
    """Best ``k`` of ``cands`` for every query, among those that reach ``floor``."""
    best = Best(k, floor)
    dims = min(len(queries.x), len(cands.x))
    most = dims * queries.top * cands.top
    if most >= 1 << 62:
        raise ValueError("scores could pass 2^62")
    kind = np.dtype(np.float64 if most < 1 << 53 else np.int64)
    qx, cx, q_rest, c_rest = queries.x, cands.x, queries.rest(), cands.rest()
    steps = range(0, dims, STEP)
    for g in range(0, len(queries.keys), GROUP):
        mine = np.arange(g, min(g + GROUP, len(queries.keys)))
        for at in range(0, len(cands.keys), tile):
            cols = np.arange(at, min(at + tile, len(cands.keys)))
            rows = mine
            part = np.zeros((len(rows), len(cols)), kind)
            pairs: tuple[np.ndarray, np.ndarray] | None = None
            for s, d in enumerate(steps):
                end = min(d + STEP, dims)
                if pairs is None:
                    part += qx[d:end, rows].T.astype(kind) @ cx[d:end, at:at + len(cols)].astype(kind)
                    reach = part + (q_rest[s, rows][:, None] * c_rest[s, cols][None, :] * (1 + 1e-9) + 1)
                    alive = reach >= best.floor[rows][:, None]
                    if np.count_nonzero(alive) < SPARSE * alive.size:
                        r, c = np.nonzero(alive)
                        pairs, part = (rows[r], cols[c]), part[r, c]
                else:
                    r, c = pairs
                    part = part + np.einsum("ij,ij->j", qx[d:end, r].astype(kind), cx[d:end, c].astype(kind))
                    reach = part + (q_rest[s, r] * c_rest[s, c] * (1 + 1e-9) + 1)
                    alive = reach >= best.floor[r]
                    pairs, part = (r[alive], c[alive]), part[alive]
            if pairs is None:
                r, c = np.nonzero(part >= best.floor[rows][:, None])
                pairs, part = (rows[r], cols[c]), part[r, c]
            r, c = pairs
            other = queries.keys[r] != cands.keys[c]
            score = part.astype(np.int64)
            ok = other & (score >= best.floor[r])
            best.add(r[ok], score[ok], cands.named[c[ok]], cands.ids[c[ok]])
    return best


def _row(uid: int, b: Block) -> list:
    width, columns = b.columns()
    return [uid, len(b.keys), len(b.x), width, b.keys.astype("<i8").tobytes(), b.ids.astype("<i8").tobytes(),
            b.named.tobytes(), columns]


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_BLOCK = [("uid", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("width", pa.int32()),
          ("keys", pa.binary()), ("ids", pa.binary()), ("named", pa.binary()), ("columns", pa.list_(pa.binary()))]


def blocks(vectors: DataFrame, scale: float, every: int, k: int, id_col: str, vector_col: str) -> DataFrame:
    """Vertical blocks of all whole vectors (``asks`` false), and per block the
    queries in it (``asks`` true) with the k-th best score among its rows."""
    schema = pa.schema([("asks", pa.bool_()), *_BLOCK, ("floor", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 34        # rows of a task, numbered below it
        at = 0
        for batch in batches:
            good, found = quantised(batch.column(1), scale)
            ids = batch.column(0).filter(pa.array(good))
            for lo in range(0, len(found), BLOCK):
                part = found[lo:lo + BLOCK]
                x = np.zeros((max(map(len, part)), len(part)))
                for j, v in enumerate(part):
                    x[:len(v), j] = v
                if np.abs(x).max(initial=0) > 1 << 31:
                    raise ValueError(f"a component is beyond {1 << 31} after scaling")
                own = ids.slice(lo, len(part))
                b = Block(base + at + np.arange(len(part)),
                          own.fill_null(NO_ID).to_numpy(), ~own.is_null().to_numpy(zero_copy_only=False),
                          x.astype(np.int64))
                rows = [[False, *_row(base + at, b), None]]
                asks = np.flatnonzero(b.named & (b.ids % every == 0))
                if len(asks):
                    q = b.take(asks)
                    low = search(q, np.full(len(asks), NONE), b, k).floor
                    rows.append([True, *_row(base + at, q), low.astype("<i8").tobytes()])
                at += len(part)
                yield _batch(rows, schema)

    light = vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vector_col).cast("array<double>").alias("v"))
    return map_tasks(light, run, f"asks boolean, {BLOCKS}, floor binary")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: float = 1024,
          id_col: str = "vec_id", vector_col: str = "embedding", range_rows: int = RANGE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of every
    row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    built = stage(blocks(vectors, scale, every, k, id_col, vector_col), "vertical")
    n = built.filter("not asks").agg(F.sum("n")).first()[0] or 0
    # at least one range a core, and none above the rows that a task may hold
    ranges = max(1, spark.sparkContext.defaultParallelism, -(-n // range_rows))
    dealt = (built.filter("not asks").withColumn("range", F.pmod(F.xxhash64("uid"), F.lit(ranges)).cast("int"))
             .unionByName(built.filter("asks").withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Block] = []
        rows_held, now = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["range"] != now:
                    held, rows_held, now = [], 0, row["range"]
                if not row["asks"]:
                    held.append(Block.of(row))
                    continue
                if not held:
                    continue
                if len(held) > 1:
                    held = [Block.joined(held)]
                q = Block.of(row)
                best = search(q, np.frombuffer(row["floor"], "<i8"), held[0], k)
                at, score, unnamed, ids = best.rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.keys[at]), pa.array(q.ids[at]), pa.array(ids, mask=unnamed == 1), pa.array(-score)],
                    names=["asker", "query_id", "vec_id", "score"])

    near = map_tasks(dealt.repartition(ranges, "range").sortWithinPartitions("range", "asks"), run, FOUND)
    w = Window.partitionBy("asker").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


#: DuckDB SQL of ``top_k``.
ORACLE = """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS i, vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v
    FROM embeddings WHERE embedding IS NOT NULL
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
    SELECT q.i, q.vec_id AS query_id, c.vec_id,
           list_sum([q.v[j] * c.v[j] for j in range(1, least(len(q.v), len(c.v)) + 1)])::BIGINT AS score
    FROM kept q JOIN kept c ON c.i <> q.i WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id)::INT AS rank, vec_id,
       coalesce(score, 0) AS score
FROM scored QUALIFY rank <= 10
"""
