"""Incremental index build as a Structured Streaming query (IX3 as a stream).

New article files arriving in a directory are picked up by the file source;
each micro-batch runs the batch build against the store under the key
``<stream>:<epoch>``, so a re-delivered epoch adds nothing and epochs cannot
collide with batch runs or with other streams.  ``availableNow`` processes
what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.store import ChunkStore


def start_build_stream(spark: SparkSession, source_dir: str, schema: StructType,
                       store: ChunkStore, checkpoint: str,
                       prepare: Callable[[DataFrame], DataFrame] | None = None,
                       glob: str | None = None, available_now: bool = True,
                       max_files_per_trigger: int | None = None,
                       stream: str | None = None) -> StreamingQuery:
    """Start the stream.  ``prepare`` maps raw rows to articles (for example
    the cleaner); it must be a per-row transformation.  ``stream`` names the
    stream in the store's log; a checkpoint belongs to one stream, so its path
    is the default."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_dir)
    articles = prepare(src) if prepare else src

    def run(batch: DataFrame, epoch_id: int) -> None:
        store.build(batch, run_key=f"{stream or checkpoint}:{epoch_id}")

    writer = (articles.writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def run_build_stream(spark: SparkSession, source_dir: str, schema: StructType,
                     store: ChunkStore, checkpoint: str, **kw) -> ChunkStore:
    """Run to completion (``availableNow``) and return the store."""
    q = start_build_stream(spark, source_dir, schema, store, checkpoint, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return store
