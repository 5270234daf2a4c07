"""Keys of an insert-only table, bucketed and sorted: a batch meets its history without a shuffle of it.

Beside each insert-only table lies a narrow Parquet table of its keys with their load
run, partitioned by run and bucketed on the key.  It is an ordinary Spark table over a folder
of the store: any session declares it again, and each run adds its own partition.

A batch of up to ``broadcast_keys`` keys is broadcast, and of the history only the files
of the batch's buckets are opened.  A larger one is shuffled once into the buckets and
merged with them; the history has no exchange either way.

Rows of runs that did not succeed do not count.  A run whose keys are missing, because it was
adopted or came before this table, is caught up from the table itself; keys written twice change nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources.store import Store


class KeyHistory:
    def __init__(self, store: Store, table: str, key: tuple[str, ...] = ("app_id", "update_id"), buckets: int = 64,
                 broadcast_keys: int = 200_000):
        self.spark, self.store, self.table, self.key = store.spark, store, table, list(key)
        self.buckets, self.broadcast_keys = buckets, broadcast_keys
        self.kinds = {c: schemas.TABLES[table][c].dataType.simpleString() for c in self.key}
        # another number of buckets is another folder, filled from the table
        self.kind = f"keys_{table}_{buckets}"
        self.path = store.path(self.kind)
        self.done = f"{self.kind}_done"
        self.name = f"{self.kind}_{hashlib.md5(self.path.encode()).hexdigest()[:12]}"

    def declared(self) -> str:
        """Name of the bucketed table over the folder, with the partitions that are there now."""
        columns = ", ".join(f"{c} {t}" for c, t in self.kinds.items())
        key = ", ".join(self.key)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, etl_run_id BIGINT) USING parquet "
                       f"PARTITIONED BY (etl_run_id) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}'")
        if self.store.has(self.kind):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        return self.name

    def add(self, rows: DataFrame, runs: list[int]) -> None:
        """Append the keys of ``rows`` (with ``etl_run_id``) and note that ``runs`` are held in full."""
        keys = rows.select(*[F.col(c).cast(t).alias(c) for c, t in self.kinds.items()], F.col("etl_run_id").cast("long"))
        keys.repartition(self.buckets, *self.key).write.insertInto(self.declared())
        covered = self.spark.createDataFrame([(r,) for r in runs], "covers long").coalesce(1)
        self.store.write_side(self.done, covered, max(runs), append=True)

    def catch_up(self) -> list[int]:
        """Add the successful runs that are not held yet; returns all successful runs."""
        runs = self.store.committed_runs()
        held = {r["covers"] for r in self.store.side(self.done, "covers long, etl_run_id long").select("covers").distinct().collect()}
        missing = [r for r in runs if r not in held]
        if missing:
            kinds = ", ".join(f"{c} {t}" for c, t in self.kinds.items())
            self.add(self.store.side(f"append/{self.table}", f"{kinds}, etl_run_id long").where(F.col("etl_run_id").isin(missing)),
                     missing)
        return runs

    def keys(self, runs: list[int], touched: list[int] | None = None) -> DataFrame:
        """Keys of ``runs``: the bucketed table, or only the files of the buckets ``touched``."""
        if touched is None:
            rows = self.spark.table(self.declared())
        else:
            some = ",".join(f"{b:05d}" for b in touched)
            rows = self.spark.read.schema(self.spark.table(self.declared()).schema) \
                .option("pathGlobFilter", f"*_{{{some}}}.c000*").parquet(self.path)
        return rows.where(F.col("etl_run_id").isin(runs)).select(*self.key)

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch``, unique on the key, that no successful run has (``ON CONFLICT DO NOTHING``)."""
        runs = self.catch_up()
        if not runs:
            return batch
        # Spark's own assignment of rows to buckets; one row for each bucket comes back
        bucket = F.pmod(F.hash(*[F.col(c).cast(t) for c, t in self.kinds.items()]), F.lit(self.buckets))
        sizes = {r["b"]: r["count"] for r in batch.groupBy(bucket.alias("b")).count().collect()}
        if not sizes:
            return batch
        if sum(sizes.values()) > self.broadcast_keys:
            return batch.hint("merge").join(self.keys(runs), self.key, "left_anti")
        hits = self.keys(runs, sorted(sizes)).join(F.broadcast(batch.select(*self.key)), self.key, "left_semi")
        return batch.join(F.broadcast(hits), self.key, "left_anti")
