"""Landed news pages as a stream: every page file is read once.

``readStream`` over the landing folder; items are exploded and typed in the stream, copies that
landed before are dropped by the state store, and each micro-batch becomes one load run of
news through ``foreachBatch`` (``jobs.load_items``).  ``trigger(availableNow=True)`` processes what is
there and stops.

Copies.  A key of the state is (app, gid, hash of the item), with ``dropDuplicatesWithinWatermark`` over the time at
which a batch first saw it: the batch's own clock, so no landed item is ever too late, and a key leaves the state
after ``retention``.  An exact copy within that time costs a look-up; later ones, and different items
under one gid, meet the store's insert-only rule, where the first stays.  Within a batch the first by
(fetch, page, position) stays, as in a batch load.

Replays.  The stream's checkpoint, its own for each store and landing folder, remembers files and state; the run log
keeps the batch's name, so a batch replayed after a lost commit is not loaded twice.

Defined cases: items without a gid are never copies of each other and are rejected when typed, each once;
lines that do not parse and pages of apps that the store does not know go to ``quarantine_pages``; there is no
cut-off by date, since no file is read twice: items older than their app's newest are loaded.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.jobs import load_items
from tidemark.operators import pages
from tidemark.session import checkpoint_dir
from tidemark.sources.store import Store


def stream_location(spark: SparkSession, kind: str, *names: str) -> str:
    """The default checkpoint of a stream: one for each kind, source and store."""
    key = hashlib.sha256("\n".join(n.rstrip("/") for n in names).encode()).hexdigest()[:24]
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{kind}-{key}"


def news_items(pages_stream: DataFrame, retention: str = "30 days") -> DataFrame:
    """Items of landed pages without the copies that the state remembers; bad pages pass as rows with ``bad`` set.

    Works on a stream; on a batch frame it drops exact copies.
    """
    item = T.StructType([f for f in schemas.NEWS_PAGE["appnews"].dataType["newsitems"].dataType.elementType.fields])
    ok = (F.col("http_status") == 200) & F.col("app_id").isNotNull() & F.col(schemas.CORRUPT).isNull()
    bad = F.when(F.col(schemas.CORRUPT).isNotNull(), "malformed_line").when(F.col("app_id").isNull(), "app_id")
    none = F.array(F.lit(None).cast(item))
    listed = F.when(ok, F.col("appnews.newsitems")).when(bad.isNotNull(), none)
    rows = pages_stream.select(
        "app_id", "page", pages._fetch_id(pages_stream), F.posexplode(listed).alias("pos", "it"),
        bad.alias("bad"), F.when(bad.isNotNull(), F.col(schemas.CORRUPT)).alias("line"))
    named = F.coalesce(F.col("it.gid"), F.lit("")) != ""
    # what makes a row a copy: the item itself; without a gid the place where it landed as well
    place = F.when(~named | F.col("bad").isNotNull(), F.concat_ws("/", "fetch_id", "page", "pos", "line"))
    keyed = rows.withColumns({"gid_": F.col("it.gid"), "copy_": F.xxhash64(F.to_json("it"), place), "seen_at": F.current_timestamp()})
    key = ["app_id", "gid_", "copy_"]
    once = keyed.withWatermark("seen_at", retention).dropDuplicatesWithinWatermark(key) if keyed.isStreaming else keyed.dropDuplicates(key)
    return once.select("app_id", "page", "fetch_id", "pos", "it.*", "bad", "line")


def load_news_available_now(spark: SparkSession, pages_dir: str, store_root: str, retention: str = "30 days",
                            stream_checkpoint: str | None = None) -> list[int]:
    """Load every page file that landed since the last call; returns the run ids created."""
    runs: list[int] = []
    location = stream_checkpoint or stream_location(spark, "news", pages_dir, store_root)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        key = f"{location}#{batch_id}"
        if batch.isEmpty() or Store(spark, store_root).loaded(key):   # loaded before the stream's commit was lost
            return
        batch = batch.persist()
        try:
            bad = batch.filter(F.col("bad").isNotNull()).select("app_id", "page", F.col("bad").alias("reason"), "line")
            items = batch.filter(F.col("bad").isNull()).drop("bad", "line")
            runs.append(load_items(spark, store_root, items, bad, load_key=key).etl_run_id)
        finally:
            batch.unpersist()

    schema = T.StructType([*schemas.NEWS_PAGE.fields, T.StructField(schemas.CORRUPT, T.StringType(), True)])
    landed = spark.readStream.schema(schema).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", schemas.CORRUPT).json(pages_dir)
    query = (news_items(landed, retention).writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", location).trigger(availableNow=True).start())
    query.awaitTermination()
    return runs
