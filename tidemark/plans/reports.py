"""Dashboard questions answered on top of the marts.

The chart definitions are not part of the reference; these are the queries the
dashboards are described to ask, with bucket edges of our choosing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import marts
from tidemark.warehouse import Warehouse

KPI_COLUMNS = ["app_id", "app_name", "etl_run_id", "etl_started_at", "ccu", "price",
               "news_count_7d", "news_count_30d", "ccu_per_news_30d"]
CCU_BUCKET = 500  # width of the ccu histogram bins


def app_detail(wh: Warehouse, app_name: str | None = None, latest: DataFrame | None = None) -> DataFrame:
    """Current KPIs per app (latest run of each app), optionally one app by name."""
    own = wh if app_name is None else marts.of_app(wh, app_name)
    df = latest if latest is not None else marts.latest_by_app(own)
    if app_name is not None:
        df = df.filter(F.col("app_name") == app_name)
    return df.select(*KPI_COLUMNS)


def metric_course(wh: Warehouse, app_name: str | None = None, timeseries: DataFrame | None = None) -> DataFrame:
    """Metric course over runs (ccu, price, discount, news)."""
    own = wh if app_name is None else marts.of_app(wh, app_name)
    df = timeseries if timeseries is not None else marts.timeseries_by_run(own)
    if app_name is not None:
        df = df.filter(F.col("app_name") == app_name)
    return df.select("app_id", "app_name", "etl_run_id", "etl_started_at", "ccu", "price", "discount",
                     "news_count_7d", "news_count_30d", "news_count_daily")


def news_context(wh: Warehouse, n: int = 5) -> DataFrame:
    """D3: latest ``n`` news per app next to the app's daily count on that day."""
    top = marts.news_top_n(wh, n).withColumn("news_date", F.to_date("news_ts"))
    daily = marts.news_daily(wh).select("app_id", "news_date", "news_count")
    return top.join(daily, ["app_id", "news_date"], "left").select(
        "app_id", "app_name", "update_id", "title", "news_ts", "rn",
        F.coalesce(F.col("news_count"), F.lit(0).cast("long")).alias("news_count_that_day"))


def _price_tier() -> F.Column:
    p = F.col("price")
    return (F.when(p.isNull(), "unknown").when(p == 0, "free").when(p < 10, "low")
            .when(p < 30, "mid").otherwise("high"))


def _one_run(wh: Warehouse, overview: DataFrame | None, run_id: int | None) -> DataFrame:
    """Overview rows of the chosen run, by default the newest successful one; only its partition is read."""
    if overview is not None:
        return overview
    return marts.overview_latest_run(wh) if run_id is None else marts.overview_by_run(marts.of_run(wh, run_id))


def distribution(wh: Warehouse, latest_run: DataFrame | None = None, run_id: int | None = None) -> DataFrame:
    """Ccu histogram by price tier over one run (default: the newest successful one)."""
    df = _one_run(wh, latest_run, run_id)
    bucket = (F.floor(F.col("ccu") / F.lit(CCU_BUCKET)) * F.lit(CCU_BUCKET)).cast("long")
    return (df.withColumn("price_tier", _price_tier()).withColumn("ccu_bucket", bucket)
            .groupBy("price_tier", "ccu_bucket")
            .agg(F.count(F.lit(1)).alias("apps"), F.sum("ccu").cast("long").alias("total_ccu"),
                 F.min("ccu").alias("min_ccu"), F.max("ccu").alias("max_ccu")))


def news_vs_ccu(wh: Warehouse, latest_run: DataFrame | None = None, run_id: int | None = None) -> DataFrame:
    """Ccu against 30-day news activity over one run (default: the newest successful one)."""
    df = _one_run(wh, latest_run, run_id)
    return (df.groupBy("news_count_30d")
            .agg(F.count(F.lit(1)).alias("apps"), F.sum("ccu").cast("long").alias("total_ccu"),
                 F.min("ccu").alias("min_ccu"), F.max("ccu").alias("max_ccu")))


def run_monitor(wh: Warehouse) -> DataFrame:
    """Number of runs and durations (whole seconds) per status and type."""
    r = wh.dim_etl_run
    dur = F.expr("(unix_micros(cast(ended_at AS timestamp)) - unix_micros(cast(started_at AS timestamp))) div 1000000")
    return (r.withColumn("duration_s", dur)
            .groupBy("status", "run_type")
            .agg(F.count(F.lit(1)).alias("runs"), F.sum("duration_s").alias("total_duration_s"),
                 F.min("duration_s").alias("min_duration_s"), F.max("duration_s").alias("max_duration_s"),
                 F.min("started_at").alias("first_started_at"), F.max("started_at").alias("last_started_at")))


def run_explorer(wh: Warehouse, overview: DataFrame | None = None, run_id: int | None = None) -> DataFrame:
    """Per-run summary of the overview, for comparing runs side by side, or of one chosen run."""
    if overview is None:
        overview = marts.overview_by_run(wh if run_id is None else marts.of_run(wh, run_id))
    o = overview if run_id is None else overview.filter(F.col("etl_run_id") == run_id)
    return (o.groupBy("etl_run_id", "etl_started_at")
            .agg(F.count(F.lit(1)).alias("apps"), F.sum("ccu").cast("long").alias("total_ccu"),
                 F.max("ccu").alias("max_ccu"), F.sum("news_count_30d").alias("total_news_30d"),
                 F.count_if(F.col("news_count_30d") > 0).alias("apps_with_news")))
