"""End-to-end load runs over landings derived from the driver tables."""

import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.parse import ntz_lit
from tidemark.jobs import LoadParams, run_load, run_summary
from tidemark.plans import marts
from tidemark.sources import landing
from tidemark.sources.adapter import NEWS_TYPES, read_table
from tidemark.sources.store import Store

SF = "/root/testdata/sf0.001"
SPLIT = datetime(2024, 1, 20)


@pytest.fixture(scope="module")
def zone(spark):
    root = tempfile.mkdtemp(prefix="tidemark-land-")
    snap1 = landing.write_jsonl(landing.snapshot_rows_from_driver(spark, SF, 3), f"{root}/snap1")
    snap2 = landing.write_jsonl(landing.snapshot_rows_from_driver(spark, SF, 40), f"{root}/snap2")
    old = landing.write_jsonl(landing.news_pages_from_driver(spark, SF, page_size=5, until=SPLIT), f"{root}/news_old")
    full = landing.write_jsonl(landing.news_pages_from_driver(spark, SF, page_size=5), f"{root}/news_full")
    return {"root": root, "snap1": snap1, "snap2": snap2, "old": old, "full": full,
            "store": tempfile.mkdtemp(prefix="tidemark-store-")}


def test_initial_then_incremental(spark, zone):
    params = LoadParams(page_size=5)
    r1 = run_load(spark, zone["store"], zone["snap1"], zone["old"], "initial", params,
                  run_ts=datetime(2024, 1, 20, 0, 0))
    assert r1.status == "success" and r1.etl_run_id == 1
    st = Store(spark, zone["store"])
    wh = st.load()
    apps = {r.app_id for r in wh.dim_app.collect()}
    ev = read_table(spark, SF, "events").filter(F.col("event_type").isin(NEWS_TYPES))
    expected_old = ev.filter((F.col("ts") < ntz_lit(SPLIT)) & F.col("user_id").isin(list(apps))).count()
    assert wh.fact_news.count() == expected_old
    assert wh.dim_update_content.count() == expected_old
    # rejected rows: reversed owners ranges (CHECK owners_min <= owners_max)
    rej = r1.rejected.collect()
    assert all(r.reject_reason == "owners_check" for r in rej)
    assert wh.fact_steamspy_stats.count() + len(rej) == spark.read.json(zone["snap1"]).count()
    summary = run_summary(r1.report).first()
    assert summary.inserted_fact_total == expected_old

    r2 = run_load(spark, zone["store"], zone["snap2"], zone["full"], "incremental", params,
                  run_ts=datetime(2024, 1, 31, 0, 0))
    assert r2.status == "success"
    wh = st.load()
    apps2 = {r.app_id for r in wh.dim_app.collect()}
    assert apps <= apps2
    expected_all = ev.filter(F.col("user_id").isin(list(apps2))).count()
    assert wh.fact_news.count() == expected_all
    assert {r.etl_run_id for r in wh.dim_etl_run.collect()} == {1, 2}
    assert {r.status for r in wh.dim_etl_run.collect()} == {"success"}

    # replay: news stays unchanged (insert-only key), snapshot grows
    n_stats = wh.fact_steamspy_stats.count()
    r3 = run_load(spark, zone["store"], zone["snap2"], zone["full"], "incremental", params,
                  run_ts=datetime(2024, 1, 31, 12, 0))
    wh = st.load()
    assert wh.fact_news.count() == expected_all
    assert wh.fact_steamspy_stats.count() > n_stats
    rep = run_summary(r3.report).first()
    assert rep.inserted_fact_total == 0

    # the marts run on the stored warehouse
    ov = marts.overview_by_run(wh)
    assert ov.count() == wh.fact_steamspy_stats.select("etl_run_id", "app_id").distinct().count()
