"""Golden results of the nine marts on the minimal literal warehouse."""

from datetime import date
from decimal import Decimal

import pytest

from tidemark.plans import marts


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_metrics_by_run(fixture_wh):
    df = marts.metrics_by_run(fixture_wh)
    got = rows(df, "etl_run_id", "app_id", "snapshot_date")
    assert got == [
        (1, 100, date(2026, 1, 1)), (1, 200, date(2026, 1, 1)),
        (2, 100, date(2026, 1, 2)), (2, 200, date(2026, 1, 2)), (2, 300, date(2026, 1, 2)),
    ]


def test_news_rolling_asof(fixture_wh):
    df = marts.news_rolling_asof(fixture_wh)
    assert rows(df, "etl_run_id", "app_id", "news_count_7d", "news_count_30d") == [
        (1, 100, 1, 1), (1, 200, 0, 0), (2, 100, 2, 2), (2, 200, 1, 1),
    ]


def test_overview_by_run(fixture_wh):
    df = marts.overview_by_run(fixture_wh)
    assert df.count() == 5
    assert len(df.columns) == 21
    got = {(r.etl_run_id, r.app_id): r.ccu_per_news_30d for r in df.collect()}
    assert got[(1, 100)] == pytest.approx(100)
    assert got[(1, 200)] is None
    assert got[(2, 100)] == pytest.approx(60)
    assert got[(2, 200)] == pytest.approx(50)
    assert got[(2, 300)] is None
    r300 = [r for r in df.collect() if r.app_id == 300][0]
    assert (r300.news_count_7d, r300.news_count_30d) == (0, 0)


def test_overview_latest_run(fixture_wh):
    df = marts.overview_latest_run(fixture_wh)
    assert rows(df, "etl_run_id", "app_id") == [(2, 100), (2, 200), (2, 300)]


def test_latest_by_app(fixture_wh):
    df = marts.latest_by_app(fixture_wh)
    assert rows(df, "etl_run_id", "app_id", "rn") == [(2, 100, 1), (2, 200, 1), (2, 300, 1)]
    assert df.columns[-1] == "rn" and len(df.columns) == 22


def test_news_latest(fixture_wh):
    df = marts.news_latest(fixture_wh)
    assert rows(df, "app_id", "update_id", "rn") == [(100, "u100-1", 2), (100, "u100-2", 1), (200, "u200-1", 1)]
    assert df.filter("app_id = 100 AND rn = 1").count() == 1
    assert len(df.columns) == 14


def test_news_daily(fixture_wh):
    df = marts.news_daily(fixture_wh)
    assert rows(df, "app_id", "news_date", "news_count") == [
        (100, date(2025, 12, 31), 1), (100, date(2026, 1, 1), 1), (200, date(2026, 1, 1), 1),
    ]


def test_timeseries_by_run(fixture_wh):
    df = marts.timeseries_by_run(fixture_wh)
    assert rows(df, "etl_run_id", "app_id", "news_count_daily") == [
        (1, 100, 1), (1, 200, 1), (2, 100, 0), (2, 200, 0), (2, 300, 0),
    ]


def test_changes_by_run(fixture_wh):
    df = marts.changes_by_run(fixture_wh)
    assert len(df.columns) == 31
    by = {(r.etl_run_id, r.app_id): r for r in df.collect()}
    r = by[(2, 100)]
    assert (r.delta_ccu, r.delta_owners_min, r.delta_owners_max, r.delta_positive, r.delta_negative,
            r.delta_userscore) == (20, 100, 100, 5, 2, 1)
    assert (r.delta_price, r.delta_initialprice, r.delta_discount) == (Decimal("-2.00"), Decimal("0.00"), Decimal("5.00"))
    assert (r.delta_news_count_7d, r.delta_news_count_30d) == (1, 1)
    r = by[(2, 200)]
    assert (r.delta_ccu, r.delta_owners_min, r.delta_positive, r.delta_negative, r.delta_userscore) == (10, 50, 2, 1, 1)
    assert (r.delta_price, r.delta_discount) == (Decimal("-1.00"), Decimal("5.00"))
    for key in [(1, 100), (1, 200), (2, 300)]:
        assert all(getattr(by[key], f"delta_{c}") is None for c in marts.DELTA_COLUMNS)


def test_build_marts_registers_views(spark, fixture_wh):
    marts.register_marts(fixture_wh)
    assert spark.sql("SELECT count(*) FROM vw_app_overview_by_etl_run").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM vw_app_overview_latest_etl_run").first()[0] == 3
