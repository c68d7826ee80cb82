"""The fetch folds as a Structured Streaming query (FB2-FB4 with FB3).

Attempts arrive in files, in any order and possibly twice.  The fold of a link
is a grouped aggregate in the state store: the first success, else the last
error, both by (round, attempt).  Aggregates of a batch are combined before the
shuffle, so a link with a third of the attempts is one row a task.  Every epoch
writes the folds that changed below its own number, and writes it anew when it
is delivered again; the newest row of a link counts.  :func:`folds` has the
columns of ``round_fold``, so :func:`pagemill.operators.attempts.upsert` brings
a dataset up to date at any time.

State grows with the number of links.  Beyond executor memory, name the
session's RocksDB state store provider
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.attempts import ATTEMPTS_PER_ROUND, MAX_ROUNDS, within_budget


def link_folds(attempts: DataFrame, max_rounds: int = MAX_ROUNDS,
               attempts_per_round: int = ATTEMPTS_PER_ROUND) -> DataFrame:
    """FB4 as one aggregate, for streams: ``link, ok, rounds, payload, error``.
    Attempts without a link are left out; of a slot that was recorded twice the
    smaller payload or the larger error counts."""
    at = F.shiftleft(F.col("round").cast("long"), 32) + F.col("attempt")
    ok = F.col("error").isNull()
    best = F.min(F.when(ok, F.struct(at.alias("at"), "round", "payload")))
    last = F.max(F.when(~ok, F.struct(at.alias("at"), "round", "error")))
    rows = (within_budget(attempts, max_rounds, attempts_per_round).filter("link is not null")
            .groupBy("link").agg(best.alias("best"), last.alias("last")))
    won = F.col("best").isNotNull()
    return rows.select("link", won.alias("ok"), F.coalesce("best.round", "last.round").alias("rounds"),
                       F.col("best.payload").alias("payload"), F.when(~won, F.col("last.error")).alias("error"))


def start_fold_stream(spark: SparkSession, source_dir: str, schema: StructType, out: str, checkpoint: str,
                      available_now: bool = True, max_files_per_trigger: int | None = None,
                      max_rounds: int = MAX_ROUNDS,
                      attempts_per_round: int = ATTEMPTS_PER_ROUND) -> StreamingQuery:
    """Fold the attempt files of ``source_dir`` into the table ``out``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    changed = link_folds(reader.parquet(source_dir), max_rounds, attempts_per_round)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"epoch={epoch}"))

    writer = (changed.writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_fold_stream(spark: SparkSession, source_dir: str, schema: StructType, out: str, checkpoint: str,
                    **kw) -> None:
    """Run to completion (``availableNow``)."""
    q = start_fold_stream(spark, source_dir, schema, out, checkpoint, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def folds(spark: SparkSession, out: str) -> DataFrame:
    """The newest fold of every link; raises where nothing was ever written."""
    rows = spark.read.parquet(out)
    newest = rows.groupBy("link").agg(F.max("epoch").alias("epoch"))
    return rows.join(newest, ["link", "epoch"]).drop("epoch")


def compact(spark: SparkSession, out: str, into: str) -> None:
    """The newest folds as the one epoch of a fresh table ``into``."""
    try:
        now = folds(spark, out)
    except AnalysisException:
        return
    top = spark.read.parquet(out).agg(F.max("epoch")).first()[0]
    now.write.mode("error").parquet(os.path.join(into, f"epoch={top}"))
