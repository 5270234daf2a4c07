"""Bucketed key history against the plain insert-only join."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import facts
from tidemark.sources.keyhistory import KeyHistory
from tidemark.sources.store import Store

KEY = ["app_id", "update_id"]


def content(spark, low, high):
    """Content rows with keys from a range; a third belong to one app."""
    n = spark.range(low, high)
    made = n.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50 + 100).cast("int").alias("app_id"),
                    F.concat(F.lit("g"), "id").alias("update_id"))
    fields = schemas.TABLES["dim_update_content"].fields
    return made.select(*[F.col(f.name) if f.name in KEY else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def finish(store, run, status="success"):
    from datetime import datetime
    at = datetime(2024, 1, run)
    store.append_run_state(run, "incremental", status, at, at, at, None)


@pytest.fixture(scope="module")
def store(spark):
    """Two successful runs, the second written after a failed one."""
    s = Store(spark, tempfile.mkdtemp(prefix="tidemark-keys-"))
    for run, (low, high), status in [(1, (0, 400), "success"), (2, (400, 500), "failed"), (3, (500, 900), "success")]:
        s.write_append("dim_update_content", content(spark, low, high), run)
        finish(s, run, status)
    return s


def pairs(df):
    return sorted(tuple(r) for r in df.select(*KEY).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [200_000, 0])
def test_new_rows_equal_the_plain_join(spark, store, limit):
    batch = content(spark, 350, 1000)
    history = KeyHistory(store, "dim_update_content", buckets=8, broadcast_keys=limit)
    got = history.new_rows(batch)
    want, _ = facts.insert_only(batch, store.load().dim_update_content, KEY)
    assert pairs(got) == pairs(want) and len(pairs(got)) == 200     # the failed run's 100 keys are new, and 100 more


def test_the_history_is_not_shuffled(spark, store):
    """Merged: one exchange, of the batch.  Broadcast: none, and files of the batch's buckets only."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = KeyHistory(store, "dim_update_content", buckets=8, broadcast_keys=0).new_rows(content(spark, 0, 1000))
        text = plan(merged)
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
        history = KeyHistory(store, "dim_update_content", buckets=8)
        one = content(spark, 42, 43)
        assert pairs(history.new_rows(one)) == [] and "Exchange hashpartitioning" not in plan(history.new_rows(one))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    runs = history.catch_up()
    b = one.select(F.pmod(F.hash(*KEY), F.lit(8))).first()[0]
    files = history.keys(runs, [b]).inputFiles()
    assert 0 < len(files) < len(history.keys(runs, list(range(8))).inputFiles())
    assert {f.rsplit("_", 1)[1][:5] for f in files} == {f"{b:05d}"}


def test_catch_up_after_new_runs_and_in_another_session(spark, store):
    history = KeyHistory(store, "dim_update_content", buckets=8)
    store.write_append("dim_update_content", content(spark, 900, 950), 4)
    finish(store, 4)
    assert pairs(history.new_rows(content(spark, 900, 960))) == pairs(content(spark, 950, 960))
    spark.sql(f"DROP TABLE {history.name}")                      # an external table: its folder stays
    again = KeyHistory(store, "dim_update_content", buckets=8)
    assert pairs(again.new_rows(content(spark, 0, 960))) == pairs(content(spark, 400, 500).union(content(spark, 950, 960)))
    again.add(content(spark, 0, 950).withColumn("etl_run_id", F.lit(4)), [4])      # keys written twice change nothing
    assert pairs(again.new_rows(content(spark, 890, 960))) == pairs(content(spark, 950, 960))


def test_empty_store_and_empty_batch(spark, store):
    new = Store(spark, tempfile.mkdtemp(prefix="tidemark-keys-"))
    assert len(pairs(KeyHistory(new, "dim_update_content").new_rows(content(spark, 0, 5)))) == 5
    assert pairs(KeyHistory(store, "dim_update_content", buckets=8).new_rows(content(spark, 0, 0))) == []
