"""The minimal literal warehouse used by the golden tests (2 runs, 3 apps)."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import SparkSession

from tidemark import schemas
from tidemark.functions.parse import date_parts
from tidemark.warehouse import Warehouse


def _dt(s: str) -> datetime:
    return datetime.fromisoformat(s)


def fixture_warehouse(spark: SparkSession) -> Warehouse:
    # The rows that the reference's five assertions are about.
    now = _dt("2026-01-02 00:10:00")
    runs = [
        (1, "initial", "success", _dt("2026-01-01 00:00:00"), _dt("2026-01-01 00:10:00"), now, now),
        (2, "incremental", "success", _dt("2026-01-02 00:00:00"), _dt("2026-01-02 00:08:00"), now, now),
    ]
    apps = [
        (100, "Game A", "Dev A", "Pub A", now),
        (200, "Game B", "Dev B", "Pub B", now),
        (300, "Game C", "Dev C", "Pub C", now),
    ]
    ts_rows = [
        (1, "2026-01-01 00:00:00"), (2, "2026-01-02 00:00:00"), (3, "2025-12-31 12:00:00"),
        (4, "2026-01-01 12:00:00"), (5, "2026-01-01 18:00:00"),
    ]
    base_ts = spark.createDataFrame([(i, _dt(t)) for i, t in ts_rows], "timestamp_id long, ts timestamp_ntz")
    parts = date_parts("ts")
    dim_ts = base_ts.select("timestamp_id", "ts", *[c.alias(n) for n, c in parts.items()])

    typ = [(1, "patch", now)]
    content = [
        (100, "u100-1", "content 1", "author a", "label", "feed", 0, False, '["patch"]', now),
        (100, "u100-2", "content 2", "author a", "label", "feed", 0, False, '["patch"]', now),
        (200, "u200-1", "content 3", "author b", "label", "feed", 0, False, '["patch"]', now),
    ]
    news = [
        (100, "u100-1", 3, 1, 1, "title 1", "https://example.com/1", now),
        (100, "u100-2", 4, 2, 1, "title 2", "https://example.com/2", now),
        (200, "u200-1", 5, 2, 1, "title 3", "https://example.com/3", now),
    ]
    D = Decimal
    stats = [
        (1, 1, 1, 100, 1000, 2000, 100, 90, 10, 80, 1000, 800, 100, 90, D("29.99"), D("39.99"), D("25.00"), now),
        (2, 2, 2, 100, 1100, 2100, 120, 95, 12, 81, 1010, 810, 105, 92, D("27.99"), D("39.99"), D("30.00"), now),
        (3, 1, 1, 200, 800, 1500, 40, 60, 15, 70, 900, 700, 80, 70, D("19.99"), D("29.99"), D("20.00"), now),
        (4, 2, 2, 200, 850, 1550, 50, 62, 16, 71, 910, 705, 85, 72, D("18.99"), D("29.99"), D("25.00"), now),
        (5, 2, 2, 300, 300, 900, 10, 20, 5, 55, 500, 400, 40, 35, D("9.99"), D("14.99"), D("33.00"), now),
    ]
    # fact column order: stats_id, timestamp_id, etl_run_id, app_id, owners_min, owners_max, ccu,
    # positive, negative, userscore, average_forever, median_forever, average_2weeks, median_2weeks, ...
    return Warehouse(
        dim_timestamp=dim_ts,
        dim_etl_run=spark.createDataFrame(runs, schemas.DIM_ETL_RUN),
        dim_app=spark.createDataFrame(apps, schemas.DIM_APP),
        dim_update_typ=spark.createDataFrame(typ, schemas.DIM_UPDATE_TYP),
        dim_update_content=spark.createDataFrame(content, schemas.DIM_UPDATE_CONTENT),
        fact_news=spark.createDataFrame(news, schemas.FACT_NEWS),
        fact_steamspy_stats=spark.createDataFrame(stats, schemas.FACT_STEAMSPY_STATS),
    )
