"""Rolling as-of counts against a brute-force computation on random warehouses."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark import schemas
from tidemark.functions.parse import date_parts
from tidemark.plans import marts
from tidemark.warehouse import Warehouse

T0 = datetime(2024, 3, 1)


def _micros(ts):
    return int((ts - datetime(1970, 1, 1)) / timedelta(microseconds=1))


def random_case(seed, n_runs=45, n_apps=12, n_news=400):
    rnd = random.Random(seed)
    runs = []
    for r in range(1, n_runs + 1):
        start = T0 + timedelta(hours=12 * r + rnd.choice([0, 0, 3]))
        status = "failed" if rnd.random() < 0.2 else "success"
        runs.append((r, "incremental", status, start, start + timedelta(minutes=5), start, start))
    news = []
    for i in range(n_news):
        # some timestamps exactly on an anchor or exactly 6 / 29 days before one
        if rnd.random() < 0.2:
            base = rnd.choice(runs)[3]
            ts = base - timedelta(days=rnd.choice([0, 6, 29, 30, 7]))
        else:
            ts = T0 + timedelta(seconds=rnd.randrange(0, 40 * 86400))
        news.append((rnd.randrange(1, n_apps + 1), f"u{i}", ts))
    return runs, news


def brute_force(runs, news, max_runs=30):
    ok = sorted([r for r in runs if r[2] == "success"], key=lambda r: (r[3], r[0]), reverse=True)[:max_runs]
    apps = {a for a, _, _ in news}
    out = {}
    for run_id, _, _, anchor, *_ in ok:
        for app in apps:
            ts = [t for a, _, t in news if a == app]
            n7 = sum(anchor - timedelta(days=6) <= t <= anchor for t in ts)
            n30 = sum(anchor - timedelta(days=29) <= t <= anchor for t in ts)
            out[(run_id, app)] = (n7, n30)
    return out


def build(spark, runs, news, micros_ids):
    stamps = sorted({t for _, _, t in news})
    ids = {t: (_micros(t) if micros_ids else i + 1) for i, t in enumerate(stamps)}
    base = spark.createDataFrame([(ids[t], t) for t in stamps], "timestamp_id long, ts timestamp_ntz")
    dim_ts = base.select("timestamp_id", "ts", *[c.alias(n) for n, c in date_parts("ts").items()])
    fact = spark.createDataFrame([(a, u, ids[t], 1, None, "t", "u", None) for a, u, t in news], schemas.FACT_NEWS)
    empty = Warehouse.empty(spark)
    return empty.with_tables(dim_timestamp=dim_ts, dim_etl_run=spark.createDataFrame(runs, schemas.DIM_ETL_RUN),
                             fact_news=fact, micros_ids=micros_ids)


@pytest.mark.parametrize("seed,micros_ids,max_runs", [(1, True, 30), (2, False, None), (3, True, None)])
def test_rolling_counts_match_brute_force(spark, seed, micros_ids, max_runs):
    runs, news = random_case(seed)
    wh = build(spark, runs, news, micros_ids)
    got = {(r.etl_run_id, r.app_id): (r.news_count_7d, r.news_count_30d)
           for r in marts.news_rolling_asof(wh, max_runs).collect()}
    assert got == brute_force(runs, news, max_runs)


def test_no_successful_run_gives_no_rows(spark):
    runs, news = random_case(4, n_runs=3)
    runs = [r[:2] + ("failed",) + r[3:] for r in runs]
    assert marts.news_rolling_asof(build(spark, runs, news, True)).count() == 0
