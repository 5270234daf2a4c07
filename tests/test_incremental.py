"""Kept rolling counts and the news stream against whole recounts and batch loads."""

import json
import random
import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.jobs import load_frames
from tidemark.plans import marts, rolling
from tidemark.sources import landing
from tidemark.sources.store import Store
from tidemark.streaming.news_stream import load_news_available_now

SF = "/root/testdata/sf0.001"
START = datetime(2024, 3, 1, 13, 30)


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def page(app, gids, at, seq=1, fetch="f", title="t"):
    items = [{"gid": g, "title": f"{title} {g}", "url": f"u/{g}", "date": int((at - datetime(1970, 1, 1)).total_seconds()) + k * 3601,
              "contents": "c", "tags": ["x"], "feed_type": 0} for k, g in enumerate(gids)]
    return {"app_id": app, "page": seq, "fetch_id": fetch, "http_status": 200, "appnews": {"count": str(len(items)), "newsitems": items}}


def land(folder, name, pages):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(p if isinstance(p, str) else json.dumps(p) for p in pages))
    return str(folder)


@pytest.fixture(scope="module")
def snap(spark):
    return landing.snapshot_rows_from_driver(spark, SF, 5).cache()


@pytest.fixture(scope="module")
def apps(snap):
    return sorted(int(r.appid) for r in snap.where("NOT owners LIKE '%-%'").collect())[:6]


def test_kept_counts_equal_the_recount(spark, snap, tmp_path):
    """Three loads with late and future news, then an adopted copy that is caught up."""
    root, rng = tempfile.mkdtemp(prefix="tidemark-rolling-"), random.Random(4)
    ids = [int(r.appid) for r in snap.select("appid").collect()][:8]
    for run in range(3):
        at = START + timedelta(days=5 * run)
        pages = []
        for app in ids[: 5 + run]:
            gids = [f"{run}-{app}-{k}" for k in range(rng.randint(0, 6))]
            off = timedelta(days=rng.choice([-40, -29, -8, -6, -1, 0, 3]), seconds=rng.choice([0, 1, 4000]))
            pages.append(page(app, gids, at + off))
        source = land(tmp_path / f"run{run}", "p", pages)
        load_frames(spark, root, snap, landing.read_news_pages(spark, source), "initial", run_ts=at)
        store = Store(spark, root)
        want = marts.news_rolling_asof(store.load())
        assert rows(rolling.news_rolling(store)) == rows(want)
    assert rows(rolling.news_rolling(store, 2)) == rows(marts.news_rolling_asof(store.load(), 2))
    assert rows(rolling.overview(store)) == rows(marts.overview_by_run(store.load()))
    plan = rolling.news_rolling(store)._jdf.queryExecution().executedPlan().toString()
    assert "fact_news" not in plan and "rolling_counts" in plan
    second = Store(spark, tempfile.mkdtemp(prefix="tidemark-rolling-"))
    second.adopt(store.load())
    assert rolling.stored(second)[1] == set()
    assert rows(rolling.news_rolling(second)) == rows(want)
    assert rolling.stored(second)[1] == {1, 2, 3}
    assert rows(rolling.news_rolling(second)) == rows(want)      # caught up once


def test_cut_days_are_a_filter_on_the_files(spark, snap):
    before = rolling.Parts.empty(spark)
    plan = rolling._older(before, [(1, marts._micros(START))])._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan


def news(store):
    return rows(store.load().fact_news.select("app_id", "update_id", "timestamp_id", "title")), \
        rows(store.load().dim_update_content.select("app_id", "update_id", "content_raw", "tags_raw"))


def test_stream_equals_one_batch_load(spark, snap, apps, tmp_path):
    pages_dir, a, b = tmp_path / "news", *apps[:2]
    streamed, batch = (Store(spark, tempfile.mkdtemp(prefix="tidemark-stream-")) for _ in range(2))
    load_frames(spark, streamed.root, snap, None, "initial", run_ts=START)
    first = [page(a, ["1", "2"], START), page(b, ["1"], START), page(a, ["2", "3"], START + timedelta(seconds=3601), 2),
             page(99_999_999, ["1"], START), "{not json", page(a, [""], START, 9)]
    folder = land(pages_dir, "one", first)
    assert load_news_available_now(spark, folder, streamed.root) == [2]
    assert load_news_available_now(spark, folder, streamed.root) == []                   # each file once
    # copies of items, one of them in an older news of its app, a changed item under a known gid, and one that is new
    land(pages_dir, "two", [first[0], page(a, ["3"], START, 7, title="changed"), page(b, ["0"], START - timedelta(days=90), 4)])
    assert load_news_available_now(spark, folder, streamed.root) == [3]
    assert load_news_available_now(spark, folder, streamed.root) == []
    load_frames(spark, batch.root, snap, landing.read_news_pages(spark, folder), "initial", run_ts=START)
    assert news(streamed) == news(batch)
    assert len(news(streamed)[0]) == 5
    assert rows(rolling.news_rolling(streamed)) == rows(marts.news_rolling_asof(streamed.load()))
    reasons = sorted(r.reason for r in streamed.read_side("quarantine_pages").collect())
    assert reasons == ["malformed_line", "unknown_app"]
    assert {r.reason for r in batch.read_side("quarantine_pages").collect()} == {"malformed_line", "unknown_app"}
    assert batch.read_side("totals").first()["unknown_app_pages"] == 1
    assert [r.reason for r in streamed.read_side("quarantine_items").collect()] == ["missing_fields"]


def test_stores_have_their_own_stream(spark, snap, apps, tmp_path):
    folder = land(tmp_path / "news", "one", [page(apps[0], ["1"], START)])
    for _ in range(2):
        root = tempfile.mkdtemp(prefix="tidemark-stream-")
        load_frames(spark, root, snap, None, "initial", run_ts=START)
        assert load_news_available_now(spark, folder, root) == [2]
        assert Store(spark, root).load().fact_news.count() == 1


def test_replayed_batch_is_loaded_once(spark, snap, apps, tmp_path):
    """The stream loses its checkpoint: all files come again, and nothing changes."""
    folder, root = land(tmp_path / "news", "one", [page(apps[0], ["1", "2"], START)]), tempfile.mkdtemp(prefix="tidemark-stream-")
    load_frames(spark, root, snap, None, "initial", run_ts=START)
    load_news_available_now(spark, folder, root, stream_checkpoint=str(tmp_path / "c1"))
    before = news(Store(spark, root))
    load_news_available_now(spark, folder, root, stream_checkpoint=str(tmp_path / "c2"))
    assert news(Store(spark, root)) == before
    assert schemas.CORRUPT not in Store(spark, root).load().fact_news.columns
    assert rows(rolling.news_rolling(Store(spark, root)).where(F.col("news_count_7d") > 2)) == []
