"""Landed items, stop rules of the page walk, item preparation and the high watermark."""

import json

import pytest

from tidemark import schemas
from tidemark.operators import pages

P = 3  # page size


def item(gid, date="missing", **kw):
    d = {"title": f"t{gid}", "url": f"u{gid}", "tags": ["patch"]}
    if gid is not None:
        d["gid"] = gid
    if date != "missing":
        d["date"] = date
    d.update(kw)
    return d


def page(app, n, items, status=200, count=None, enddate=None):
    body = {"app_id": app, "page": n, "enddate": enddate, "http_status": status}
    if status == 200:
        body["appnews"] = {"count": count, "newsitems": items}
    return json.dumps(body)


LINES = [
    # app 1: short third page ends the walk
    page(1, 1, [item("a", 900), item("b", 890), item("c", 880)], count=10),
    page(1, 2, [item("d", 870), item("e", 860), item("f", 850)], enddate=879),
    page(1, 3, [item("g", 840), item("h", 830)], enddate=849),
    # app 2: count reached after page 2 (duplicates do not count as kept)
    page(2, 1, [item("a", 900), item("b", 890), item("c", 880)], count=4),
    page(2, 2, [item("a", 900), item("b", 890), item("d", 870)], enddate=879),
    page(2, 3, [item("e", 860), item("f", 850), item("g", 840)], enddate=869),
    # app 3: rate limited once, then one page, then forbidden
    page(3, 1, [], status=429),
    page(3, 2, [item("a", 900), item("b", 890), item("c", 880)], count=99),
    page(3, 3, [], status=403, enddate=879),
    # app 4: server error after a good page -> the app yields nothing
    page(4, 1, [item("a", 900), item("b", 890), item("c", 880)], count=99),
    page(4, 2, [], status=500, enddate=879),
    # app 5: empty first page
    page(5, 1, [], count=0),
    # app 6: cutoff inside page 1 (cutoff 885): newer items kept, walk stops
    page(6, 1, [item("a", 900), item("b", 890), item("c", 880)], count=99),
    page(6, 2, [item("d", 870), item("e", 860), item("f", 850)], enddate=879),
    # app 7: no integer date among the new items -> stop after page 1
    page(7, 1, [item("a", "abc"), item("b"), item("c", None)], count=99),
    page(7, 2, [item("d", 870), item("e", 860), item("f", 850)]),
    # app 8: missing gid is walked as "None"; empty gid is ignored; both then skipped at insert
    page(8, 1, [item(None, 900), item("", 890), item("x", 880, title="")], count=99),
]


@pytest.fixture(scope="module")
def landed(spark):
    return spark.read.schema(schemas.NEWS_PAGE).json(spark.sparkContext.parallelize(LINES))


@pytest.fixture(scope="module")
def walked(spark, landed):
    cut = spark.createDataFrame([(6, 885)], "app_id int, cutoff_epoch long")
    kept, meta = pages.walk_pages(landed, cut, pages.WalkParams(page_size=P))
    return ({r.app_id: r for r in meta.collect()},
            sorted(((r.app_id, r.gid) for r in kept.collect()), key=lambda t: (t[0], t[1] or "")),
            pages.prepare_items(kept))


def test_meta(walked):
    meta, _, _ = walked
    m = meta[1]
    assert (m.pages, m.fetched, m.duplicates, m.total_expected, m.last_enddate, m.walk_status) == (3, 8, 0, 10, 849, "ok")
    m = meta[2]
    assert (m.pages, m.fetched, m.duplicates, m.total_expected) == (2, 4, 2, 4)
    m = meta[3]
    assert (m.pages, m.fetched, m.forbidden, m.rate_limited_hits, m.last_enddate) == (1, 3, True, 1, 879)
    assert meta[4].walk_status == "failed"
    m = meta[5]
    assert (m.pages, m.fetched, m.total_expected) == (0, 0, 0)
    assert (meta[6].pages, meta[6].fetched) == (1, 2)
    assert (meta[7].pages, meta[7].fetched) == (1, 3)
    assert (meta[8].pages, meta[8].fetched) == (1, 2)


def test_kept_items(walked):
    _, kept, _ = walked
    by = {}
    for app, gid in kept:
        by.setdefault(app, []).append(gid)
    assert by[1] == list("abcdefgh")
    assert by[2] == list("abcd")
    assert by[3] == list("abc")
    assert 4 not in by and 5 not in by
    assert by[6] == ["a", "b"]
    assert by[7] == ["a", "b", "c"]
    assert by[8] == [None, "x"]


def test_prepare_outcomes(walked):
    _, _, prepared = walked
    got = {(r.app_id, r.update_id): (r.outcome, r.ts) for r in prepared.collect()}
    assert got[(7, "a")][0] == "failed"          # string date
    assert got[(7, "c")][0] == "failed"          # JSON null date
    assert got[(7, "b")][0] == "ok" and got[(7, "b")][1].year == 1970  # missing date -> epoch 0
    assert got[(8, "")][0] == "skipped_missing"  # missing gid
    assert got[(8, "x")][0] == "skipped_missing"  # empty title
    assert got[(1, "a")][0] == "ok"


def test_max_pages(spark, landed):
    _, meta = pages.walk_pages(landed.filter("app_id = 1"), None, pages.WalkParams(page_size=P, max_pages=1))
    m = meta.first()
    assert (m.pages, m.fetched) == (1, 3)


def test_high_watermark(spark, fixture_wh):
    wm = {r.app_id: r.latest_ts for r in pages.latest_news_ts(fixture_wh.fact_news, fixture_wh.dim_timestamp).collect()}
    assert str(wm[100]) == "2026-01-01 12:00:00" and str(wm[200]) == "2026-01-01 18:00:00"
    cut = {r.app_id: r.cutoff_epoch for r in pages.cutoffs_from_watermark(
        pages.latest_news_ts(fixture_wh.fact_news, fixture_wh.dim_timestamp)).collect()}
    assert cut[100] == 1767268800


def test_kept_items_keep_their_wide_fields(walked):
    _, _, prepared = walked
    row = [r for r in prepared.collect() if (r.app_id, r.update_id) == (1, "a")][0]
    assert (row.title, row.url, row.type_name, row.tags_raw) == ("ta", "ua", "patch", '["patch"]')
    assert row.page == 1 and row.pos == 0
