"""Operator 11: centroid clustering over bit planes.

A vector of 64 integer components is stored as its bit planes: plane ``i`` is
one 64-bit word with bit ``i`` of every component (two's complement, the last
plane is the sign).  A dot product is then a weighted sum of popcounts,

    x . c = sum over i, j of  w(i) w(j) popcount(x[i] AND c[j]),

with ``w(i) = 2^i`` and minus that for the sign plane, and a squared distance
is ``x.x - 2 x.c + c.c``: exact integers throughout.

The planes are written once to the shared folder; every round reads them,
assigns each vector to its nearest centroid and adds up the set bits of every
plane per cluster inside the task.  One row per task and cluster is shuffled,
and ``k`` rows of sums reach the driver.

Defined cases: vectors that are null, have another number of components than
64, or hold a null or non-finite one take no part; a null id is clustered like
any other but is the last choice as a first centroid; repeated rows count each,
and repeated ids have equal hashes, where the smaller planes come first; with
fewer vectors than ``k`` every vector is a first centroid; an empty table gives
an empty result; other columns are not read.  A component beyond 2^27 in size
after scaling raises ``ValueError``: its distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_tasks, stage

DIM = 64
LIMIT = 1 << 27


def quantised(values: pa.Array, scale: float, dim: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows of a list array are whole vectors (of ``dim`` components),
    and their components as ``floor(scale * x)``."""
    size = values.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(np.maximum(size, 0))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    starts = ends - np.maximum(size, 0)
    good = (size >= 0) & (bad[ends] == bad[starts])
    if dim is not None:
        good &= size == dim
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(flat * scale)
    return good, [scaled[a:b] for a, b in zip(starts[good], ends[good])]


def planes_of(v: np.ndarray) -> np.ndarray:
    """``(n, 64)`` integers as ``(n, planes)`` words, as many planes as needed."""
    top = max(int(v.max(initial=0)), -int(v.min(initial=0)) - 1, 0)
    out = np.empty((len(v), top.bit_length() + 1), np.uint64)
    for i in range(out.shape[1]):
        bit = np.ascontiguousarray(((v >> i) & 1).astype(np.uint8))
        out[:, i] = np.packbits(bit, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def weights(planes: int) -> np.ndarray:
    w = np.left_shift(np.int64(1), np.arange(planes, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Dot products of all rows of ``x`` with all rows of ``c``, both planes."""
    out = np.zeros((len(x), len(c)), np.int64)
    wx, wc = weights(x.shape[1]), weights(c.shape[1])
    for i in range(x.shape[1]):
        col = x[:, i, None]
        for j in range(c.shape[1]):
            out += np.bitwise_count(col & c[None, :, j]) * (wx[i] * wc[j])
    return out


def norms(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    w = weights(x.shape[1])
    for i in range(x.shape[1]):
        for j in range(x.shape[1]):
            out += np.bitwise_count(x[:, i] & x[:, j]) * (w[i] * w[j])
    return out


def words_of(raw: list[bytes]) -> np.ndarray:
    """Stored planes as a matrix; rows with fewer planes repeat their sign."""
    size = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
    most = int(size.max(initial=1))
    out = np.empty((len(raw), most), np.uint64)
    for n in np.unique(size):
        mine = np.flatnonzero(size == n)
        part = np.frombuffer(b"".join(raw[i] for i in mine), "<u8").reshape(len(mine), n)
        out[mine, :n] = part
        out[mine, n:] = part[:, -1:]
    return out


def pack(vectors: DataFrame, scale: float = 64, id_col: str = "vec_id",
         vector_col: str = "embedding") -> DataFrame:
    """``id, planes, norm`` of every whole vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = quantised(batch.column(1), scale, DIM)
            if not rows:
                continue
            v = np.stack(rows)
            if np.abs(v).max() >= LIMIT:
                raise ValueError(f"a component is beyond {LIMIT} after scaling")
            x = planes_of(v.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good)),
                 pa.array([r.tobytes() for r in x], pa.binary()), pa.array(norms(x))],
                names=["id", "planes", "norm"])

    light = vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vector_col).cast("array<double>").alias("v"))
    return map_tasks(light, run, "id long, planes binary, norm long")


def first_centroids(packed: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id, as integers."""
    rows = (packed.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
                          .alias("h"), "planes")
            .orderBy(F.col("h").asc_nulls_last(), "planes").limit(k).collect())
    x = words_of([bytes(r["planes"]) for r in rows])
    return bits(x) @ weights(x.shape[1]) if len(rows) else np.zeros((0, DIM), np.int64)


def bits(x: np.ndarray) -> np.ndarray:
    """``(n, 64, planes)`` bits of ``(n, planes)`` words."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.shape[1], 8)
    return np.unpackbits(raw, axis=2, bitorder="little").transpose(0, 2, 1).astype(np.int64)


def nearest(x: np.ndarray, norm: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (smallest of equals) and its distance."""
    c = planes_of(centroids)
    d = norm[:, None] - 2 * dots(x, c) + norms(c)[None, :]
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best]


def cluster_sums(packed: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """Per non-empty cluster: number, vectors, componentwise sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), DIM), np.int64)
        for batch in batches:
            x = words_of(batch.column(0).to_pylist())
            best, _ = nearest(x, batch.column(1).to_numpy(), centroids)
            count += np.bincount(best, minlength=len(centroids))
            raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.shape[1], 8)
            for c in np.unique(best):
                set_bits = np.unpackbits(raw[best == c], axis=2, bitorder="little").sum(axis=0, dtype=np.int64)
                total[c] += weights(x.shape[1]) @ set_bits
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(count[some]),
             pa.array(list(total[some]), pa.list_(pa.int64()))], names=["c", "n", "s"])

    each = map_tasks(packed.select("planes", "norm"), run, "c int, n long, s array<long>")
    rows = each.groupBy("c").agg(F.sum("n"), *[F.sum(F.col("s")[i]) for i in range(DIM)]).collect()
    return [(r[0], r[1], list(r[2:])) for r in rows]


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: float = 64, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Assigned vectors ``(id, cluster, distance)``, staged, and the final centroids."""
    packed = stage(pack(vectors, scale, id_col, vector_col), "planes")
    centroids = first_centroids(packed, k, seed)
    if len(centroids):
        for _ in range(rounds):
            centroids = centroids.copy()
            for c, n, sums in cluster_sums(packed, centroids):
                centroids[c] = [s // n for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = words_of(batch.column(1).to_pylist())
            best, d = nearest(x, batch.column(2).to_numpy(), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best.astype(np.int32)), pa.array(d)],
                names=["id", "cluster", "distance"])

    assigned = map_tasks(packed, run, "id long, cluster int, distance long")
    return stage(assigned, "plane-clusters"), centroids


def report(vectors: DataFrame, k: int = 16, rounds: int = 3) -> DataFrame:
    """The query: every vector with its cluster, distance and inertias."""
    spark = vectors.sparkSession
    assigned, centroids = cluster(vectors, k, rounds)
    sums = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.sum("distance")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # at most k rows
    return (assigned.join(F.broadcast(facts), "cluster")
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                    "centroid_sha256"))


def oracle(k: int = 16, rounds: int = 3) -> str:
    """DuckDB SQL of :func:`report`."""
    near = """a{r} AS MATERIALIZED (
    SELECT i, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT k.i, c{r}.c, list_sum([(k.v[j] - c{r}.v[j]) * (k.v[j] - c{r}.v[j]) for j in range(1, 65)])::BIGINT AS d
        FROM kept k, c{r}) GROUP BY i)"""
    move = """c{n} AS MATERIALIZED (
    SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN (
        SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM (
            SELECT a.c, j, sum(k.v[j])::BIGINT AS s, count(*) AS n
            FROM kept k JOIN a{r} a USING (i), range(1, 65) t(j) GROUP BY a.c, j) GROUP BY c) m ON m.c = o.c)"""
    parts = [f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS i, vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v
    FROM embeddings WHERE len(embedding) = 64
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64)""",
             f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept
    QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), v) <= {k})"""]
    for r in range(rounds):
        parts += [near.format(r=r), move.format(r=r, n=r + 1)]
    parts.append(near.format(r=rounds))
    return "WITH " + ",\n".join(parts) + f"""
SELECT k.vec_id, a.c::INT AS cluster, a.d AS distance,
       sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM kept k JOIN a{rounds} a USING (i) JOIN c{rounds} m ON m.c = a.c"""
