"""Bad input rejects a row, never the run; nothing landed is lost; the store stays readable or says why not."""

import json
import os
from datetime import datetime

import pytest

from tidemark.jobs import LoadParams, load_frames, run_load
from tidemark.operators import pages
from tidemark.operators.checks import assert_clean, constraint_report, orphan_count
from tidemark.sources import landing
from tidemark.sources.fixture import fixture_warehouse
from tidemark.sources.store import Store, import_snapshot


def snapshot_line(app, pos, **kw):
    line = {"appid": str(app), "name": f"app {app}", "owners": "10 .. 20", "price": "100", "ccu": "5"} | kw
    return json.dumps(line if pos is None else line | {"pos": pos})


def item(gid, date=1700000000, **kw):
    return {"gid": gid, "title": f"t{gid}", "url": f"u{gid}", "date": date, "tags": ["a"], "is_external_url": False,
            "feed_type": 1} | kw


def page(app, number, items, **kw):
    return json.dumps({"app_id": app, "page": number, "http_status": 200,
                       "appnews": {"count": len(items), "newsitems": items}} | kw)


@pytest.fixture()
def zone(tmp_path):
    def land(name, lines):
        path = tmp_path / name
        path.mkdir(exist_ok=True)
        (path / "part.json").write_text("\n".join(lines) + "\n")
        return str(path)
    land.root = str(tmp_path / "store")
    return land


def load(spark, zone, snap, news, kind="initial", day=1):
    return run_load(spark, zone.root, snap, news, kind, run_ts=datetime(2024, 3, day))


def test_short_pages_lose_nothing(spark, zone):
    snap = zone("snap", [snapshot_line(1, 0)])
    news = zone("news", [page(1, 1, [item("a"), item("b")]), page(1, 2, [item("c"), item("d")]), page(1, 3, [item("e")])])
    assert load(spark, zone, snap, news).status == "success"
    wh = Store(spark, zone.root).load()
    assert sorted(r.update_id for r in wh.fact_news.collect()) == list("abcde")
    assert_clean(constraint_report(wh))


def test_bad_dates_and_values_reject_their_item(spark, zone):
    snap = zone("snap", [snapshot_line(1, 0)])
    bad = [item("far", 100000000000000), item("ms", 1700000000000), item("text", "abc"), item("feed", feed_type="x"),
           item("none", title="")]
    news = zone("news", [page(1, 1, [item("ok"), *bad]), "{not json", json.dumps({"page": 1, "http_status": 200})])
    res = load(spark, zone, snap, news)
    st = Store(spark, zone.root)
    assert [r.update_id for r in st.load().fact_news.collect()] == ["ok"]
    reasons = {r.update_id: r.reason for r in st.read_side("quarantine_items").collect()}
    assert reasons == {"far": "date", "ms": "date", "text": "date", "feed": "feed_type", "none": "missing_fields"}
    assert sorted(r.reason for r in st.read_side("quarantine_pages").collect()) == ["app_id", "malformed_line"]
    totals = st.read_side("totals").first()
    assert (totals.failed_items, totals.skipped_missing, totals.malformed_pages, totals.snapshot_ok) == (4, 1, 2, 1)
    assert res.status == "success"
    # a millisecond date does not become the watermark: later items still load
    later = zone("later", [page(1, 1, [item("new", 1700000500)])])
    load(spark, zone, snap, later, "incremental", 2)
    assert sorted(r.update_id for r in st.load().fact_news.collect()) == ["new", "ok"]


def test_a_page_landed_twice_gives_unique_keys(spark, zone):
    snap = zone("snap", [snapshot_line(1, 0)])
    news = zone("news", [page(1, 1, [item("a"), item("b")])] * 2 + [page(1, 1, [item("b"), item("c")], fetch_id="f2")])
    load(spark, zone, snap, news)
    wh = Store(spark, zone.root).load()
    assert sorted(r.update_id for r in wh.fact_news.collect()) == ["a", "b", "c"]
    assert_clean(constraint_report(wh))


def test_held_items_are_counted_without_the_landing(spark, zone):
    """ingest_initial_report: the counters of items that are held parse the pages once, not once for each counter."""
    news = landing.read_news_pages(spark, zone("news", [page(1, 1, [item("a"), item("b"), item("")])] * 2 + [page(2, 1, [item("a")])]))
    kept, meta = pages.landed_news(news)
    held = pages.prepare_items(kept).persist()
    held.count()
    named = held.filter(held.update_id != "")
    counted = pages.fetch_counters(news, held, named)
    assert sorted(map(str, counted.collect())) == sorted(map(str, meta.collect()))
    assert {(r.app_id, r.fetched, r.duplicates) for r in counted.collect()} == {(1, 4, 2), (2, 1, 0)}
    counts = [held.groupBy("app_id").count(), named.groupBy("app_id").count()]
    inputs = [len(df._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("|").split("InMemoryRelation")) - 1 for df in counts]
    assert inputs == [1, 1] and counted._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0].count("FileScan json") == 1
    held.unpersist()


def test_rows_without_position_and_repeated_positions(spark, zone):
    snap = zone("snap", [snapshot_line(1, None), snapshot_line(2, 0), snapshot_line(3, 0), snapshot_line(4, 1)])
    load(spark, zone, snap, None)
    st = Store(spark, zone.root)
    wh = st.load()
    assert sorted(r.app_id for r in wh.fact_steamspy_stats.collect()) == [2, 3, 4]
    assert [r.reject_reason for r in st.read_side("quarantine").collect()] == ["pos"]
    assert_clean(constraint_report(wh))
    assert all(r.app_name for r in wh.dim_app.collect())


def test_truth_of_any_json_value(spark, zone):
    values = {"t": True, "f": False, "one": 1, "zero": 0, "yes": "yes", "empty": "", "null": None}
    lines = [page(1, 1, [item(k, is_external_url=v) for k, v in values.items()])]
    kept, _ = pages.landed_news(landing.read_news_pages(spark, zone("news", lines)))
    got = {r.update_id: r.is_external_url for r in pages.prepare_items(kept).collect()}
    assert got == {k: bool(v) for k, v in values.items()}


def test_a_damaged_run_log_is_an_error(spark, zone):
    load(spark, zone, zone("snap", [snapshot_line(1, 0)]), None)
    for name in os.listdir(f"{zone.root}/runs"):
        if name.endswith(".parquet"):
            with open(f"{zone.root}/runs/{name}", "wb") as f:
                f.write(b"broken")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader raises, it must not look like an empty store
        Store(spark, zone.root).next_run_id()


def test_a_replayed_batch_is_known(spark, zone):
    raw = landing.read_snapshot(spark, zone("snap", [snapshot_line(1, 0)]))
    load_frames(spark, zone.root, raw, None, "incremental", LoadParams(), datetime(2024, 3, 1), load_key="s#0")
    assert Store(spark, zone.root).loaded("s#0") and not Store(spark, zone.root).loaded("s#1")


def test_import_fills_a_store_and_reset_empties_it(spark, tmp_path):
    wh = fixture_warehouse(spark)
    first = Store(spark, str(tmp_path / "a"))
    first.adopt(wh)
    first.export(str(tmp_path / "dump"))
    second = Store(spark, str(tmp_path / "b"))
    second.adopt(import_snapshot(spark, str(tmp_path / "dump"), validate=True))
    for name, df in wh.tables().items():
        assert sorted(map(str, df.collect())) == sorted(map(str, second.load().tables()[name].collect())), name
    with pytest.raises(ValueError):
        second.adopt(wh)
    second.reset()
    assert second.load().fact_news.count() == 0 and second.next_run_id() == 1


def test_limits_are_recorded(spark, zone):
    raw = landing.read_snapshot(spark, zone("snap", [snapshot_line(k, k) for k in range(1, 5)]))
    news = landing.read_news_pages(spark, zone("news", [page(k, 1, [item(f"n{k}")]) for k in range(1, 5)]))
    load_frames(spark, zone.root, raw, news, "initial", LoadParams(snapshot_limit=3, apps_limit=2), datetime(2024, 3, 1))
    st = Store(spark, zone.root)
    assert st.load().fact_steamspy_stats.count() == 3 and st.load().fact_news.count() == 2
    assert st.read_side("totals").first().limits == "snapshot_limit=3,apps_limit=2"
    load_frames(spark, zone.root + "2", raw, news, "initial", LoadParams(skip_news=True), datetime(2024, 3, 1))
    assert Store(spark, zone.root + "2").load().fact_news.count() == 0


def test_orphans_are_counted_by_row(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,)], "k int")
    assert orphan_count(child, parent, ["k"], ["k"], "x", skip_null=True).first().violations == 2

