"""Chunk store: a chunk table, a ledger table and a commit log under one
root (IO11, IO12, IX2-IX7).

Every run writes its chunks and ledger marks below a fresh ``attempt`` name,
then appends one row to the commit log that names the attempt.  Only attempts
in the log are visible, so a run that dies leaves nothing behind that a later
run could show, and nothing is ever overwritten.  Batch ids come from the log
alone.  A stream names its epochs by ``run_key``; a key that is in the log is
not built again, and the keys of different streams and of batch runs cannot
meet.  A forced rebuild is one log row as well: it hides all earlier batches
and shows the new one in the same append.  The next batch id and the id base
come from the log, which has one row per batch.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import embed as em
from ..operators import index as ix
from ..schema import EMBEDDED_CHUNKS, LEDGER
from ..session import ensure_checkpoint_dir, scratch_path, stage

# Default collection name.
COLLECTION = "article_chunks"

COMMITS = ("batch_id long, run_key string, attempt string, resets boolean, "
           "max_chunk_no long, chunks long, committed_at timestamp")
ERRORS = "link string, reason string"
#: Error conditions that mean "not written yet".
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


class ChunkStore:
    def __init__(self, spark: SparkSession, root: str, name: str = COLLECTION,
                 embed: bool = True, model: Callable[[pd.Series], list] | None = None):
        """``model`` (texts -> vectors) replaces the built-in embedding."""
        self.spark = spark
        self.root = root
        self.name = name
        self.embed = embed
        self.model = model
        self.chunks_path = os.path.join(root, "chunks")
        self.ledger_path = os.path.join(root, "ledger")
        self.errors_path = os.path.join(root, "errors")
        self.commits_path = os.path.join(root, "commits")
        ensure_checkpoint_dir(spark)

    # -- reading (IO9, IO12) ------------------------------------------------
    def _read(self, path: str, schema) -> DataFrame:
        """The table, or an empty one if it was never written; any other
        failure is raised."""
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ABSENT:
                raise
            return self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        """Log rows since the last rebuild (that row included)."""
        log = self._read(self.commits_path, COMMITS)
        last = log.filter("resets").agg(F.max("batch_id")).first()[0]
        return log if last is None else log.filter(F.col("batch_id") >= last)

    def committed_batches(self) -> DataFrame:
        return self.commits().select("batch_id")

    def _visible(self, path: str, schema, before: int | None) -> DataFrame:
        log = self.commits().select("attempt", "batch_id")
        if before is not None:
            log = log.filter(F.col("batch_id") < before)
        try:
            raw = self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ABSENT:
                raise
            raw = self.spark.createDataFrame([], schema).withColumn(
                "attempt", F.lit(None).cast("string"))
        return raw.join(log, "attempt").drop("attempt")

    def ledger(self, before: int | None = None) -> DataFrame:
        """Ledger rows of committed batches (optionally of batches < before)."""
        return self._visible(self.ledger_path, LEDGER, before).select("link", "processed_at")

    def chunks(self, before: int | None = None) -> DataFrame:
        """Chunks of committed batches (optionally of batches < before)."""
        return self._visible(self.chunks_path, EMBEDDED_CHUNKS, before)

    def errors(self) -> DataFrame:
        """IX8: links of committed batches that could not be indexed, and why;
        they are not in the ledger, so a later build tries them again."""
        return self._visible(self.errors_path, ERRORS, None)

    def next_batch(self) -> int:
        last = self._read(self.commits_path, COMMITS).agg(F.max("batch_id")).first()[0]
        return 0 if last is None else int(last) + 1

    def is_committed(self, batch: int) -> bool:
        return self.commits().filter(F.col("batch_id") == batch).limit(1).count() > 0

    def batch_of(self, run_key: str) -> int | None:
        """The batch that a run key was committed as."""
        row = (self._read(self.commits_path, COMMITS).filter(F.col("run_key") == run_key)
               .agg(F.max("batch_id")).first())
        return row[0]

    def id_base(self, batch: int) -> int:
        """Largest chunk number of the batches before ``batch`` (0 if none)."""
        top = (self.commits().filter(F.col("batch_id") < batch)
               .agg(F.max("max_chunk_no")).first()[0])
        return int(top or 0)

    # -- writing (IX3, IX4) -------------------------------------------------
    def _write(self, df: DataFrame, path: str, attempt: str) -> None:
        df.write.mode("error").parquet(os.path.join(path, f"attempt={attempt}"))

    def _commit(self, batch: int, base: int, attempt: str, run_key: str | None = None,
                resets: bool = False) -> None:
        written = self._read(os.path.join(self.chunks_path, f"attempt={attempt}"), EMBEDDED_CHUNKS)
        top, n = written.agg(F.max("chunk_no"), F.count(F.lit(1))).first()
        row = [(batch, run_key, attempt, resets, int(top if top is not None else base), int(n))]
        (self.spark.createDataFrame(row, COMMITS.rsplit(",", 1)[0])
         .withColumn("committed_at", F.current_timestamp())
         .write.mode("append").parquet(self.commits_path))

    def import_ledger(self, links: DataFrame) -> int:
        """Commit existing ledger rows ``(link, processed_at)`` (for example a
        ledger kept by an earlier tool) as a batch with no chunks."""
        batch, attempt = self.next_batch(), f"a{os.urandom(8).hex()}"
        self._write(self.spark.createDataFrame([], EMBEDDED_CHUNKS), self.chunks_path, attempt)
        self._write(links.select("link", "processed_at"), self.ledger_path, attempt)
        self._commit(batch, self.id_base(batch), attempt)
        return batch

    def clear(self) -> None:
        """IX4: hide everything, by one log row."""
        self._commit(self.next_batch(), 0, f"none{os.urandom(8).hex()}", resets=True)

    def build(self, articles: DataFrame, rebuild: bool = False, batch_id: int | None = None,
              run_key: str | None = None) -> DataFrame:
        """IX3: index only articles not yet in the ledger; returns the run's
        statistics (IX5) as a one-row DataFrame.

        The input is evaluated once, into a staging table.  A committed
        ``batch_id`` or ``run_key`` is not built again; its statistics are
        returned.
        """
        staged = scratch_path(self.spark, "store-input")
        articles.write.parquet(staged)
        articles = self.spark.read.schema(articles.schema).parquet(staged)
        known = self.batch_of(run_key) if run_key is not None else batch_id
        batch = self.next_batch() if known is None else known
        before = -1 if rebuild else batch
        validated = ix.validate_articles(articles, self.ledger(before=before))
        if not self.is_committed(batch):
            base = 0 if rebuild else self.id_base(batch)
            attempt = f"a{os.urandom(8).hex()}"
            new = ix.assign_chunks(ix.to_process(validated, articles), base_id=base)
            rows = new.select(*[f.name for f in EMBEDDED_CHUNKS.fields if f.name != "embedding"])
            failed = self.spark.createDataFrame([], ERRORS)
            if self.model is not None:
                done = stage(em.embed_with(rows, self.model), "store-embedded")
                failed = (done.filter("embed_error is not null").groupBy("link")
                          .agg(F.min("embed_error").alias("reason")))
                rows = done.drop("embed_error").join(failed.select("link"), "link", "left_anti")
                rows = rows.select(*[f.name for f in EMBEDDED_CHUNKS.fields])
            else:
                rows = (em.embed_chunks(rows) if self.embed
                        else rows.withColumn("embedding", F.lit(None).cast("array<float>")))
            self._write(rows, self.chunks_path, attempt)
            written = self._read(os.path.join(self.chunks_path, f"attempt={attempt}"), EMBEDDED_CHUNKS)
            self._write(ix.ledger_marks(validated, chunks=written), self.ledger_path, attempt)
            tried = validated.filter("skip_reason is null").select(F.col("link_key").alias("link"))
            self._write(tried.join(written.select("link"), "link", "left_anti")
                        .join(failed, "link", "left")
                        .select("link", F.coalesce("reason", F.lit("splitter failed")).alias("reason")),
                        self.errors_path, attempt)
            self._commit(batch, base, attempt, run_key, resets=rebuild)
        written = self.chunks().filter(F.col("batch_id") == batch)
        stats = ix.build_stats(validated, written).withColumn("batch_id", F.lit(batch))
        return self.spark.createDataFrame(stats.collect(), stats.schema)

    # -- summaries (IX6, IX7) -----------------------------------------------
    def status(self, articles: DataFrame) -> DataFrame:
        return ix.status_summary(articles, self.ledger(), self.chunks())

    def stats(self) -> DataFrame:
        return ix.store_stats(self.chunks(), self.ledger(), self.name, self.root)
