"""Shared helpers of the training-data operators.

Intermediate tables go to the shared folder named by ``spark.checkpoint.dir``
(``session.scratch_path``).  Writing one cuts the lineage, so a lost executor
costs at most the tasks of one step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
                schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch.  Ships the package to the
    Python workers first."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def map_tasks(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with a function of all non-empty batches of a task."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(b for b in batches if b.num_rows)

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(id, comp)`` for every end of the undirected edges ``(a, b)``:
    smallest reachable id.

    Min-label propagation with pointer jumping; labels are written out each
    round, and every join has two plain scans below its exchanges, so AQE can
    split a hub that has most of the edges.  The loop ends when no label
    changes; the number of rounds is logarithmic for long chains.
    """
    sym = stage(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
                .distinct(), f"{name}-edges")
    labels = stage(sym.groupBy(F.col("u").alias("id"))
                   .agg(F.min("v").alias("m")).select("id", F.least("id", "m").alias("comp")),
                   f"{name}-l")
    while True:
        near = (sym.join(labels.withColumnRenamed("id", "v"), "v")
                .groupBy(F.col("u").alias("id")).agg(F.min("comp").alias("m")))
        hop = stage(labels.join(near, "id")
                    .select("id", F.least("comp", "m").alias("comp"), F.col("comp").alias("old")),
                    f"{name}-h")
        # the label of my label: halves the distance left
        target = hop.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        nxt = stage(hop.join(target, "comp", "left")
                    .select("id", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "old"),
                    f"{name}-l")
        changed = nxt.filter(F.col("comp") != F.col("old")).limit(1).count()
        labels = nxt.select("id", "comp")
        if not changed:
            return labels
