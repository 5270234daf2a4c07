"""Structured Streaming form of the scheduled incremental load.

The landing directory of snapshot files is read as a file stream; each
micro-batch (the snapshot files that arrived since the last trigger) becomes
one incremental load run through ``foreachBatch``, with the news pages landed
so far (or without them: ``news_stream`` reads each page file once).  ``trigger(availableNow=True)`` processes what is there and stops, so
a scheduler can start it like the batch job; the stream checkpoint (in the
shared checkpoint folder, one for each source and store) remembers which files were loaded, and the run log
remembers the batch, so a batch replayed after a lost commit is not loaded twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas
from tidemark.jobs import LoadParams, load_frames
from tidemark.sources import landing
from tidemark.sources.store import Store
from tidemark.streaming.news_stream import stream_location


def run_available_now(spark: SparkSession, snapshot_dir: str, store_root: str,
                      pages_dir: str | None = None, params: LoadParams = LoadParams(),
                      stream_checkpoint: str | None = None) -> list[int]:
    """Load every newly landed snapshot batch; returns the run ids created."""
    runs: list[int] = []
    location = stream_checkpoint or stream_location(spark, "snapshots", snapshot_dir, store_root)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        key = f"{location}#{batch_id}"
        if batch.isEmpty() or Store(spark, store_root).loaded(key):   # loaded before the stream's commit was lost
            return
        pages = landing.read_news_pages(spark, pages_dir) if pages_dir else None
        res = load_frames(spark, store_root, batch, pages, "incremental", params, load_key=key)
        runs.append(res.etl_run_id)

    stream = spark.readStream.schema(schemas.SNAPSHOT_LINE).json(snapshot_dir)
    query = (stream.writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", location)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return runs
