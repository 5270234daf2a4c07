"""Registry of the checked queries: a Spark callable and its DuckDB twin.

Each entry takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` (through the adapter where the warehouse shape is needed) and
returns a DataFrame.  ``sql`` is the DuckDB oracle over the same parquet
tables, or ``None`` where only a row-count check applies.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import mart_sql as S
from tidemark.plans import marts, reports
from tidemark.sources.adapter import warehouse_from_driver, with_adapter


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str  # inventory ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, ops: str):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def _wh(spark, sf_dir):
    return warehouse_from_driver(spark, sf_dir)


# ------------------------------------------------------------------- marts
@register("metrics_by_run", with_adapter(S.chain(S.V1) + " SELECT * FROM q_v1"), "V1 J1 W1 F3 P8")
def q_metrics_by_run(spark, sf_dir):
    return marts.metrics_by_run(_wh(spark, sf_dir))


@register("news_rolling_asof", with_adapter(S.chain(S.V2) + " SELECT * FROM q_v2"),
          "V2 F4 T1 J2 J5 F6 A1 P12")
def q_news_rolling_asof(spark, sf_dir):
    return marts.news_rolling_asof(_wh(spark, sf_dir), marts.MAX_RUNS)


@register("news_rolling_all_runs", with_adapter(S.chain(S.V2_ALL) + " SELECT * FROM q_v2"), "V2 A1 J2 P12")
def q_news_rolling_all_runs(spark, sf_dir):
    # timestamps are joined here, not read off the ids
    return marts.news_rolling_asof(replace(_wh(spark, sf_dir), micros_ids=False))


@register("overview_by_run", with_adapter(S.chain(S.V1, S.V2, S.V3) + " SELECT * FROM q_v3"),
          "V3 J3 J4 J6 P9 P10")
def q_overview_by_run(spark, sf_dir):
    return marts.overview_by_run(_wh(spark, sf_dir), marts.MAX_RUNS)


@register("overview_all_runs", with_adapter(S.chain(S.V1, S.V2_ALL, S.V3) + " SELECT * FROM q_v3"), "V3 J1 J2 J3 J4 J6")
def q_overview_all_runs(spark, sf_dir):
    return marts.overview_by_run(replace(_wh(spark, sf_dir), micros_ids=False))


@register("overview_latest_run",
          with_adapter(S.chain(S.V1, S.V2, S.V3) + f" SELECT * FROM q_v3 WHERE etl_run_id = {S.LATEST_RUN}"),
          "V4 F5 T2")
def q_overview_latest_run(spark, sf_dir):
    return marts.overview_latest_run(_wh(spark, sf_dir))


@register("news_latest", with_adapter(S.chain(S.V5_BASE) + " SELECT * FROM q_v5"), "V5 J7 W2")
def q_news_latest(spark, sf_dir):
    return marts.news_latest(_wh(spark, sf_dir))


@register("news_top_n", with_adapter(
    S.chain(S.V5_BASE) + " SELECT app_id, app_name, update_id, title, url, news_ts, rn FROM q_v5 WHERE rn <= 5"),
    "T6 W2")
def q_news_top_n(spark, sf_dir):
    return marts.news_top_n(_wh(spark, sf_dir), 5)


@register("news_daily", with_adapter(S.chain(S.V6) + " SELECT * FROM q_v6"), "V6 A2")
def q_news_daily(spark, sf_dir):
    return marts.news_daily(_wh(spark, sf_dir))


@register("timeseries_by_run", with_adapter(S.chain(S.V1, S.V2, S.V3, S.V6, S.V7) + " SELECT * FROM q_v7"),
          "V7 J8")
def q_timeseries_by_run(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return marts.timeseries_by_run(wh, marts.overview_by_run(wh, marts.MAX_RUNS))


@register("changes_by_run", with_adapter(S.chain(S.V1, S.V2, S.V3, S.V8) + " SELECT * FROM q_v8"),
          "V8 W4 P11")
def q_changes_by_run(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return marts.changes_by_run(wh, marts.overview_by_run(wh, marts.MAX_RUNS))


@register("latest_by_app", with_adapter(S.chain(S.V1, S.V2, S.V3, S.V9) + " SELECT * FROM q_v9"), "V9 W3")
def q_latest_by_app(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return marts.latest_by_app(wh, marts.overview_by_run(wh, marts.MAX_RUNS))


# ----------------------------------------------------------------- reports
_BASE3 = S.chain(S.V1, S.V2, S.V3)


@register("app_detail", with_adapter(
    S.chain(_BASE3, S.V9) + " SELECT " + ", ".join(reports.KPI_COLUMNS) + " FROM q_v9"), "D1")
def q_app_detail(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return reports.app_detail(wh, latest=marts.latest_by_app(wh, marts.overview_by_run(wh, marts.MAX_RUNS)))


@register("metric_course", with_adapter(
    S.chain(_BASE3, S.V6, S.V7) + " SELECT app_id, app_name, etl_run_id, etl_started_at, ccu, price, discount, "
    "news_count_7d, news_count_30d, news_count_daily FROM q_v7"), "D2")
def q_metric_course(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return reports.metric_course(wh, timeseries=marts.timeseries_by_run(wh, marts.overview_by_run(wh, marts.MAX_RUNS)))


@register("news_context", with_adapter(S.chain(S.V5_BASE, S.V6) + """
    SELECT v.app_id, v.app_name, v.update_id, v.title, v.news_ts, v.rn,
           COALESCE(d.news_count, 0) AS news_count_that_day
    FROM q_v5 v LEFT JOIN q_v6 d ON d.app_id = v.app_id AND d.news_date = v.news_ts::DATE
    WHERE v.rn <= 5"""), "D3")
def q_news_context(spark, sf_dir):
    return reports.news_context(_wh(spark, sf_dir), 5)


_LATEST = f"q_latest AS (SELECT * FROM q_v3 WHERE etl_run_id = {S.LATEST_RUN})"
_TIER = ("CASE WHEN price IS NULL THEN 'unknown' WHEN price = 0 THEN 'free' WHEN price < 10 THEN 'low' "
         "WHEN price < 30 THEN 'mid' ELSE 'high' END")


@register("distribution", with_adapter(S.chain(_BASE3, _LATEST) + f"""
    SELECT {_TIER} AS price_tier, (floor(ccu / {reports.CCU_BUCKET}) * {reports.CCU_BUCKET})::BIGINT AS ccu_bucket,
           count(*) AS apps, sum(ccu)::BIGINT AS total_ccu, min(ccu) AS min_ccu, max(ccu) AS max_ccu
    FROM q_latest GROUP BY 1, 2"""), "D4")
def q_distribution(spark, sf_dir):
    return reports.distribution(_wh(spark, sf_dir))


@register("news_vs_ccu", with_adapter(S.chain(_BASE3, _LATEST) + """
    SELECT news_count_30d, count(*) AS apps, sum(ccu)::BIGINT AS total_ccu, min(ccu) AS min_ccu,
           max(ccu) AS max_ccu
    FROM q_latest GROUP BY 1"""), "D5")
def q_news_vs_ccu(spark, sf_dir):
    return reports.news_vs_ccu(_wh(spark, sf_dir))


@register("run_monitor", with_adapter("""
    SELECT status, run_type, count(*) AS runs, sum(d)::BIGINT AS total_duration_s, min(d) AS min_duration_s,
           max(d) AS max_duration_s, min(started_at) AS first_started_at, max(started_at) AS last_started_at
    FROM (SELECT *, (epoch_us(ended_at) - epoch_us(started_at)) // 1000000 AS d FROM w_dim_etl_run)
    GROUP BY status, run_type"""), "D6")
def q_run_monitor(spark, sf_dir):
    return reports.run_monitor(_wh(spark, sf_dir))


@register("run_explorer", with_adapter(_BASE3 + """
    SELECT etl_run_id, etl_started_at, count(*) AS apps, sum(ccu)::BIGINT AS total_ccu, max(ccu) AS max_ccu,
           sum(news_count_30d)::BIGINT AS total_news_30d, count(*) FILTER (WHERE news_count_30d > 0) AS apps_with_news
    FROM q_v3 GROUP BY etl_run_id, etl_started_at"""), "D7")
def q_run_explorer(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return reports.run_explorer(wh, overview=marts.overview_by_run(wh, marts.MAX_RUNS))


# ------------------------------------------------- reports with a choice made
_APP = "Customer#000000007"      # a name that the customer table has at every scale
_ALL3 = S.chain(S.V1, S.V2_ALL, S.V3)
_RUN = "(SELECT min(etl_run_id) FROM w_dim_etl_run WHERE status = 'success')"
_OF_RUN = f"q_latest AS (SELECT * FROM q_v3 WHERE etl_run_id = {_RUN})"


def _first_run(wh):
    return marts.successful_runs(wh).agg({"etl_run_id": "min"}).first()[0]


@register("app_detail_by_name", with_adapter(
    S.chain(_ALL3, S.V9) + " SELECT " + ", ".join(reports.KPI_COLUMNS) + f" FROM q_v9 WHERE app_name = '{_APP}'"), "D1")
def q_app_detail_by_name(spark, sf_dir):
    return reports.app_detail(_wh(spark, sf_dir), _APP)


@register("metric_course_by_name", with_adapter(
    S.chain(_ALL3, S.V6, S.V7) + " SELECT app_id, app_name, etl_run_id, etl_started_at, ccu, price, discount, "
    f"news_count_7d, news_count_30d, news_count_daily FROM q_v7 WHERE app_name = '{_APP}'"), "D2")
def q_metric_course_by_name(spark, sf_dir):
    return reports.metric_course(_wh(spark, sf_dir), _APP)


@register("run_explorer_of_run", with_adapter(S.chain(_ALL3, _OF_RUN) + """
    SELECT etl_run_id, etl_started_at, count(*) AS apps, sum(ccu)::BIGINT AS total_ccu, max(ccu) AS max_ccu,
           sum(news_count_30d)::BIGINT AS total_news_30d, count(*) FILTER (WHERE news_count_30d > 0) AS apps_with_news
    FROM q_latest GROUP BY etl_run_id, etl_started_at"""), "D7")
def q_run_explorer_of_run(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return reports.run_explorer(wh, run_id=_first_run(wh))


@register("distribution_of_run", with_adapter(S.chain(_ALL3, _OF_RUN) + f"""
    SELECT {_TIER} AS price_tier, (floor(ccu / {reports.CCU_BUCKET}) * {reports.CCU_BUCKET})::BIGINT AS ccu_bucket,
           count(*) AS apps, sum(ccu)::BIGINT AS total_ccu, min(ccu) AS min_ccu, max(ccu) AS max_ccu
    FROM q_latest GROUP BY 1, 2"""), "D4")
def q_distribution_of_run(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return reports.distribution(wh, run_id=_first_run(wh))


# the ingest-side queries register themselves on import
from tidemark.plans import catalog_etl, catalog_incremental  # noqa: E402,F401
