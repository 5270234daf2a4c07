"""Dimension maintenance: insert-if-absent, null-preserving upsert, id allocation.

Every operator returns the *new full state* of a dimension (or the rows to
append); the store writes it as a new snapshot, because parquet has no
in-place update.  Nothing here collects to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parse import date_parts, ts_id
from tidemark.operators.ranking import split_row_number


# ------------------------------------------------------------------------ M8
def next_ids(new_rows: DataFrame, existing_ids: DataFrame | None, id_col: str,
             order_cols: list, id_type: str = "long") -> DataFrame:
    """Give ``new_rows`` ids ``max(existing) + 1, + 2, ...`` in ``order_cols`` order.

    The numbering is the range-split global row number, so no single task
    sees all new rows; the current maximum is a one-row aggregate.
    """
    numbered = split_row_number(new_rows, [], order_cols, out="_tm_seq")
    if existing_ids is None:
        base = F.lit(0).cast("long")
        out = numbered.withColumn(id_col, (base + F.col("_tm_seq")).cast(id_type))
    else:
        top = F.broadcast(existing_ids.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_tm_max")))
        out = (numbered.crossJoin(top)
               .withColumn(id_col, (F.col("_tm_max") + F.col("_tm_seq")).cast(id_type))
               .drop("_tm_max"))
    return out.drop("_tm_seq")


# ------------------------------------------------------------------------ M1
def new_timestamps(batch_ts: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Distinct timestamps of a batch not yet in ``dim_timestamp`` (rows to append).

    The id is the epoch microsecond of the timestamp, so facts compute their
    foreign key without a lookup and concurrent loads agree on ids.
    """
    parts = date_parts("ts")
    fresh = (batch_ts.select("ts").filter(F.col("ts").isNotNull()).distinct()
             .select(ts_id("ts").alias("timestamp_id"), "ts", *[c.alias(n) for n, c in parts.items()]))
    if existing is None:
        return fresh
    # known ids among the batch's (semi join built on the batch: the dimension
    # streams past, broadcast when the batch is small), then drop them
    hits = existing.select("timestamp_id").join(fresh.select("timestamp_id"), "timestamp_id", "left_semi")
    return fresh.join(hits, "timestamp_id", "left_anti")


# ------------------------------------------------------------------------ M2
APP_ATTRS = ["app_name", "developer", "publisher"]


def reduce_app_batch(batch: DataFrame, order_col: str = "pos") -> DataFrame:
    """Collapse several rows of one app in one batch: per column the last
    non-NULL value in payload order (what applying the rows one by one with
    ``COALESCE(new, old)`` leaves behind)."""
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order_col))).alias(c) for c in APP_ATTRS]
    return batch.groupBy("app_id").agg(*aggs)


def upsert_apps(existing: DataFrame, batch: DataFrame, now: Column, order_col: str = "pos") -> DataFrame:
    """New state of ``dim_app``: new non-NULL value wins per column, else the old
    one; every app of the batch gets ``updated_at = now`` (also when unchanged)."""
    new = reduce_app_batch(batch, order_col).withColumn("_tm_in_batch", F.lit(True))
    old = existing.select("app_id", *APP_ATTRS, "updated_at")
    j = old.alias("o").join(new.alias("n"), "app_id", "full_outer")
    return j.select(
        F.col("app_id").cast("int").alias("app_id"),
        *[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in APP_ATTRS],
        F.when(F.col("n._tm_in_batch"), now).otherwise(F.col("o.updated_at")).cast("timestamp_ntz").alias("updated_at"),
    )


# ------------------------------------------------------------------- M3 + M8
def assign_type_ids(batch_names: DataFrame, existing: DataFrame | None, now: Column) -> DataFrame:
    """New state of ``dim_update_typ`` for the type names seen in a batch.

    Known names keep their id and are touched (``updated_at = now``); unknown
    names get ids after the current maximum, in name order.
    """
    names = batch_names.select("type_name").filter(F.col("type_name").isNotNull()).distinct()
    if existing is None:
        fresh = next_ids(names, None, "update_type_id", ["type_name"], "int")
        return fresh.select("update_type_id", "type_name", now.cast("timestamp_ntz").alias("updated_at"))
    old = existing.select("update_type_id", "type_name", "updated_at")
    unknown = names.join(old.select("type_name"), "type_name", "left_anti")
    fresh = next_ids(unknown, old, "update_type_id", ["type_name"], "int").select(
        "update_type_id", "type_name", now.cast("timestamp_ntz").alias("updated_at"))
    seen = names.withColumn("_tm_seen", F.lit(True))
    kept = old.join(seen, "type_name", "left").select(
        "update_type_id", "type_name",
        F.when(F.col("_tm_seen"), now).otherwise(F.col("updated_at")).cast("timestamp_ntz").alias("updated_at"))
    return kept.unionByName(fresh)
