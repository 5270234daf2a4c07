"""State per app and marks of news kept per run, against the marts over all runs."""

import json
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.jobs import load_frames
from tidemark.operators import pages
from tidemark.plans import appstate, marts
from tidemark.schemas import METRICS
from tidemark.sources import landing
from tidemark.sources.store import Store

START = datetime(2024, 3, 1, 13, 30)


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def snapshot(spark, folder, name, apps):
    path = folder / f"{name}.json"
    path.write_text("\n".join(json.dumps({"pos": k, "appid": str(a), "name": f"app {a}", "ccu": str(c), "owners": "1 .. 2", "price": None if c % 2 else "5"})
                              for k, (a, c) in enumerate(apps)))
    return landing.read_snapshot(spark, str(path))


def news(spark, folder, name, items):
    path = folder / f"{name}.json"
    line = lambda app, gid, at: {"app_id": app, "page": 1, "http_status": 200, "appnews": {"count": "1", "newsitems": [
        {"gid": gid, "title": "t", "url": "u", "date": int((at - datetime(1970, 1, 1)).total_seconds()), "contents": "c"}]}}
    path.write_text("\n".join(json.dumps(line(*i)) for i in items))
    return landing.read_news_pages(spark, str(path))


def agree(store):
    wh = store.load()
    assert rows(appstate.changes(store)) == rows(marts.changes_by_run(wh))
    assert rows(appstate.latest(store)) == rows(marts.latest_by_app(wh))
    assert rows(appstate.watermark(store, wh)) == rows(pages.latest_news_ts(wh.fact_news, wh.dim_timestamp))
    return wh


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Three runs: apps that come and go, late news for runs before, one run without news."""
    folder, root, rng = tmp_path_factory.mktemp("land"), tempfile.mkdtemp(prefix="tidemark-state-"), random.Random(3)
    for run in range(3):
        at = START + timedelta(days=2 * run)
        apps = [(a, rng.randint(0, 50)) for a in range(1, 7) if run == 0 or rng.random() < 0.6]
        items = [(a, f"{run}-{a}-{k}", at - timedelta(days=rng.choice([0, 1, 5, 9, 40]))) for a in range(1, 5) for k in range(2)]
        load_frames(spark, root, snapshot(spark, folder, f"s{run}", apps), None if run == 1 else news(spark, folder, f"n{run}", items),
                    "initial", run_ts=at)
    return Store(spark, root), folder


def test_kept_state_equals_the_marts(spark, loaded):
    store, _ = loaded
    wh = agree(store)
    assert appstate._chain(store)[1].keys() == {1, 2, 3} and appstate._marks(store)[1] == {1, 2, 3}
    one = appstate.changes(store, 2)
    assert rows(one) == rows(marts.changes_by_run(wh).filter("etl_run_id = 2")) and one.count() > 0
    for df in (appstate.watermark(store, wh), appstate._tables(store, wh, *appstate._chain(store)[::2])[0]):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "fact_news" not in plan and "fact_steamspy_stats" not in plan and "Window" not in plan


def test_a_run_written_again_changes_nothing(spark, loaded):
    store, _ = loaded
    wh = store.load()
    before = rows(appstate.changes(store)), rows(appstate.latest(store)), rows(appstate.watermark(store, wh))
    start = wh.dim_etl_run.filter("etl_run_id = 3").first()["started_at"]
    appstate.maintain(store, wh.with_tables(dim_etl_run=wh.dim_etl_run.filter("etl_run_id < 3")), 3, start)
    appstate.maintain_marks(store, wh, 3, store.partition("fact_news", 3))
    assert before == (rows(appstate.changes(store)), rows(appstate.latest(store)), rows(appstate.watermark(store, wh)))


def test_import_and_a_run_dated_back_begin_new_chains(spark, loaded):
    store, folder = loaded
    second = Store(spark, tempfile.mkdtemp(prefix="tidemark-state-"))
    second.adopt(store.load())
    assert appstate._chain(second)[0] is None and appstate._marks(second)[1] == set()
    agree(second)
    chain = appstate._chain(second)[0]
    agree(second)
    assert appstate._chain(second)[0] == chain                                   # caught up once
    load_frames(spark, second.root, snapshot(spark, folder, "back", [(1, 9), (8, 1)]),
                news(spark, folder, "back-n", [(8, "x", START - timedelta(days=60))]), "incremental", run_ts=START + timedelta(days=1))
    assert appstate._chain(second)[0] != chain and appstate._chain(second)[1].keys() == {1, 2, 3, 4}
    assert appstate._marks(second)[1] == {1, 2, 3, 4}
    agree(second)


def test_step_on_empty_and_null_rows(spark):
    schema = appstate._PLAIN + ", ".join(f"{m} long" for m in METRICS)
    none = spark.createDataFrame([], schema)
    deltas, state = appstate.first_step(none)
    assert deltas.count() == state.count() == 0
    row = lambda app, run, ccu: (app, run, START + timedelta(days=run), None, ccu, *[None] * (len(METRICS) - 1))
    _, state = appstate.step(none, spark.createDataFrame([row(1, 1, 5), row(2, 1, None)], schema))
    deltas, state = appstate.step(state, spark.createDataFrame([row(2, 2, 4), row(3, 2, 1)], schema))
    assert sorted((r.app_id, r.previous_run, r.delta_ccu) for r in deltas.collect()) == [(2, 1, None), (3, None, None)]
    assert sorted((r.app_id, r.run_id, r.ccu) for r in state.collect()) == [(1, 1, 5), (2, 2, 4), (3, 2, 1)]
    assert appstate.watermark_of(spark.createDataFrame([], "app_id int, at long")).agg(F.count("*")).first()[0] == 0
