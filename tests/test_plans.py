"""Plan properties the design relies on, checked on the physical plans."""

import importlib.util
import tempfile
from datetime import datetime
from pathlib import Path

import pytest

from tidemark.plans import catalog, marts
from tidemark.sources.adapter import warehouse_from_driver

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_from_driver(spark, SF)


@pytest.fixture(scope="module")
def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", Path(__file__).parents[1] / "__spark_entry__.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_top1_per_group_limits_before_the_shuffle(wh):
    p = plan_of(marts.metrics_by_run(wh))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.index("Partial") > p.index("Exchange hashpartitioning")  # partial sits below (before) the exchange


def test_rolling_counts_are_linear_in_the_news(wh):
    p = plan_of(marts.news_rolling_asof(wh, marts.MAX_RUNS))
    # the only nested loop makes the result's grid of apps and runs; news rows meet the calendar by equality
    assert p.count("BroadcastNestedLoopJoin") <= 1 and "CartesianProduct" not in p
    assert p.count("BroadcastHashJoin") >= 3 and "partial_sum" in p


def test_one_run_reads_one_partition(spark, wh):
    p = plan_of(marts.overview_latest_run(wh))
    run = marts.latest_run_id(wh)
    assert f"= {run}" in p


def test_app_choice_is_below_the_ranking(wh):
    p = plan_of(marts.latest_by_app(marts.of_app(wh, "Customer#000000007")))
    assert p.index("Window") < p.index("LeftSemi")   # printed top down: the semi join runs before the window


def test_store_scan_gets_the_window_bounds(spark):
    from tidemark.jobs import LoadParams, run_load
    from tidemark.sources import landing
    from tidemark.sources.store import Store

    z = tempfile.mkdtemp(prefix="tidemark-plan-")
    snap = landing.write_jsonl(landing.snapshot_rows_from_driver(spark, SF, None), f"{z}/snap")
    news = landing.write_jsonl(landing.news_pages_from_driver(spark, SF, 100), f"{z}/news")
    run_load(spark, f"{z}/store", snap, news, "initial", LoadParams(), run_ts=datetime(2024, 1, 31))
    p = plan_of(marts.news_rolling_asof(Store(spark, f"{z}/store").load()))
    assert "GreaterThanOrEqual(timestamp_id," in p and "LessThanOrEqual(time" in p
    assert "dynamicpruning" in p  # committed-runs filter prunes run partitions


def test_entry_contract(spark, entry_module):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "ccu_per_news_30d" in df.columns
    qs, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(qs) and set(catalog.REGISTRY) <= set(sql) and len(catalog.REGISTRY) >= 35


def test_no_python_evaluation_in_registered_queries(spark, entry_module):
    skip = {"ingest_initial_report", "snapshot_export_import"}  # these run jobs while building
    for name in sorted(set(catalog.REGISTRY) - skip):
        p = plan_of(entry_module.queries()[name](spark, SF))
        assert "EvalPython" not in p and "PythonUDF" not in p and "MapInPandas" not in p, name
