"""The nine marts of the warehouse (the public query surface).

Each mart is ``Warehouse -> DataFrame``; they stack like views: the
overview (``overview_by_run``) is the base of four others.  When several marts
are built in one job, persist the overview once (``build_marts``).

Join strategy: dimension joins are left to Catalyst / AQE, which broadcast a
side only when its measured size is under ``autoBroadcastJoinThreshold`` and
fall back to a shuffle join otherwise.  Explicit broadcasts are limited to
tables made from the run log (days and runs), and only up to ``CALENDAR_ROWS`` rows.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.parse import ntz_lit, safe_ratio
from tidemark.operators.ranking import split_row_number, top_per_group
from tidemark.schemas import DELTA_COLUMNS, METRICS, VIEW_NAMES
from tidemark.warehouse import Warehouse

MAX_RUNS = 30  # runs that get rolling news counts in the parity views; the library default is all runs
DAY = 86_400_000_000  # microseconds


def _ts(wh: Warehouse) -> DataFrame:
    return wh.dim_timestamp.select("timestamp_id", "ts")


def with_ts(df: DataFrame, wh: Warehouse) -> DataFrame:
    """Attach ``ts`` to fact rows (inner: rows without a timestamp drop out).

    With epoch-microsecond ids the timestamp is computed from the id -- no
    join against the timestamp dimension, which is as large as the number of
    distinct event times and would otherwise be a shuffle join on a key that
    all snapshot rows of a run share.
    """
    if wh.micros_ids:
        ts = F.timestamp_micros(F.col("timestamp_id")).cast("timestamp_ntz")
        return df.filter(F.col("timestamp_id").isNotNull()).withColumn("ts", ts)
    return df.join(_ts(wh), "timestamp_id")


def successful_runs(wh: Warehouse, limit: int | None = None) -> DataFrame:
    """Latest ``limit`` (None: all) successful runs (started_at DESC, id DESC) -> (etl_run_id, anchor_ts)."""
    runs = wh.dim_etl_run.filter(F.col("status") == "success")
    if limit is not None:
        runs = runs.orderBy(F.col("started_at").desc(), F.col("etl_run_id").desc()).limit(limit)
    return runs.select("etl_run_id", F.col("started_at").alias("anchor_ts"))


def latest_run_id(wh: Warehouse) -> int | None:
    """Id of the newest successful run (one row), ``None`` without one."""
    row = successful_runs(wh, 1).first()
    return None if row is None else row["etl_run_id"]


def of_app(wh: Warehouse, app_name: str) -> Warehouse:
    """The warehouse of the apps with that name: facts are semi-joined before any mart ranks or counts them."""
    apps = wh.dim_app.filter(F.col("app_name") == app_name)
    ids = apps.select("app_id")
    return wh.with_tables(
        dim_app=apps, fact_news=wh.fact_news.join(ids, "app_id", "left_semi"),
        dim_update_content=wh.dim_update_content.join(ids, "app_id", "left_semi"),
        fact_steamspy_stats=wh.fact_steamspy_stats.join(ids, "app_id", "left_semi"))


def of_run(wh: Warehouse, run_id: int) -> Warehouse:
    """The warehouse with one run's snapshot rows (a partition filter) and that run alone."""
    return wh.with_tables(dim_etl_run=wh.dim_etl_run.filter(F.col("etl_run_id") == run_id),
                          fact_steamspy_stats=wh.fact_steamspy_stats.filter(F.col("etl_run_id") == run_id))


# ------------------------------------------------------------------------ V1
def metrics_by_run(wh: Warehouse) -> DataFrame:
    """Latest snapshot row per (run, app); ties on ts broken by the newest stats id."""
    stats = wh.fact_steamspy_stats.select("stats_id", "timestamp_id", "etl_run_id", "app_id", *METRICS)
    joined = with_ts(stats, wh)
    latest = top_per_group(joined, ["etl_run_id", "app_id"],
                           [F.col("ts").desc(), F.col("stats_id").desc()], k=1, out=None)
    return latest.select("etl_run_id", "app_id", *METRICS, F.to_date("ts").alias("snapshot_date"))


# ------------------------------------------------------------------------ V2
def news_rolling_asof(wh: Warehouse, max_runs: int | None = None) -> DataFrame:
    """News counts in [anchor - 6 d, anchor] and [anchor - 29 d, anchor] per (run, app).

    Anchors are the started_at of the latest ``max_runs`` (None: all) successful
    runs.  Every app with any news gets a row for every anchor (count 0 included).

    Plan, linear in the news: a news row counts for the anchors from its own time
    to 29 days later, a range of anchor numbers.  It adds one where the range starts
    and takes one away where it ends; these changes are summed per (app, anchor
    number) in the scan tasks first, so a hot app crosses the shuffle as at most one
    row for each anchor and task, and a running sum over an app's anchors gives the
    counts.  Anchor numbers come from a calendar with one row for each day between
    the first and the last anchor, joined three times.  Only news inside
    [oldest anchor - 29 d, newest anchor] can count; these bounds are literals and
    reach the parquet scan.
    """
    spark = wh.fact_news.sparkSession
    runs = sorted((_micros(r["anchor_ts"]), r["etl_run_id"]) for r in successful_runs(wh, max_runs).collect())
    news = wh.fact_news.select("app_id", "timestamp_id")
    if not runs:
        return spark.createDataFrame([], "etl_run_id long, app_id int, news_count_7d long, news_count_30d long")
    lo, hi = runs[0][0] - 29 * DAY, runs[-1][0]
    if wh.micros_ids:
        window = news.filter(F.col("timestamp_id").between(lo, hi)).select("app_id", F.col("timestamp_id").alias("at"))
    else:
        at = F.unix_micros(F.col("ts").cast("timestamp"))
        window = with_ts(news, wh).select("app_id", at.alias("at")).filter(F.col("at").between(lo, hi))
    calendar = _calendar(spark, [at for at, _ in runs])

    def anchors_before(df: DataFrame, moment, name: str, inclusive: bool) -> DataFrame:
        """Number of anchors before ``moment`` (or at it)."""
        cal = calendar.select(F.col("day").alias("_day"), F.col("earlier").alias("_earlier"), F.col("at").alias("_ats"))
        j = df.withColumn("_m", moment).withColumn("_d", F.call_function("div", F.col("_m") - F.pmod("_m", F.lit(DAY)), F.lit(DAY))) \
            .join(cal, F.col("_d") == F.col("_day"), "left")
        own = F.size(F.filter("_ats", lambda a: (a <= F.col("_m")) if inclusive else (a < F.col("_m"))))
        number = F.when(F.col("_d") < lo_day, 0).when(F.col("_d") > hi_day, len(runs)).otherwise(F.col("_earlier") + own)
        return j.select(*df.columns, number.cast("int").alias(name))

    lo_day, hi_day = runs[0][0] // DAY, hi // DAY
    for name, days, inclusive in (("s", 0, False), ("e7", 6, True), ("e30", 29, True)):
        window = anchors_before(window, F.col("at") + F.lit(days * DAY), name, inclusive)
    one = F.lit(1).cast("long")
    changes = F.array(
        F.struct(F.col("s").alias("slot"), one.alias("d7"), one.alias("d30")),
        F.struct(F.col("e7").alias("slot"), (-one).alias("d7"), F.lit(0).cast("long").alias("d30")),
        F.struct(F.col("e30").alias("slot"), F.lit(0).cast("long").alias("d7"), (-one).alias("d30")))
    summed = window.select("app_id", F.explode(changes).alias("c")).groupBy("app_id", F.col("c.slot").alias("slot")) \
        .agg(F.sum("c.d7").alias("d7"), F.sum("c.d30").alias("d30"))
    numbered = _bounded(spark, [(k, run_id) for k, (_, run_id) in enumerate(runs)], "slot int, etl_run_id long")
    apps = with_ts(news, wh).select("app_id").distinct()
    grid = apps.crossJoin(numbered)      # the rows of the result
    order = Window.partitionBy("app_id").orderBy("slot")
    return grid.join(summed, ["app_id", "slot"], "left").select(
        "etl_run_id", "app_id",
        F.sum(F.coalesce("d7", F.lit(0))).over(order).alias("news_count_7d"),
        F.sum(F.coalesce("d30", F.lit(0))).over(order).alias("news_count_30d"))


CALENDAR_ROWS = 200_000  # rows up to which a table made from the run log may be broadcast


def _bounded(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A table made from the run log; broadcast only if it has at most CALENDAR_ROWS rows."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= CALENDAR_ROWS else df


def _calendar(spark, anchors: list[int]) -> DataFrame:
    """Per day from the first to the last anchor: how many anchors lie on earlier days, and the day's own."""
    of_day: dict[int, list[int]] = {}
    for at in anchors:
        of_day.setdefault(at // DAY, []).append(at)
    rows, earlier = [], 0
    for day in range(min(of_day), max(of_day) + 1):
        own = of_day.get(day, [])
        rows.append((day, earlier, own))
        earlier += len(own)
    return _bounded(spark, rows, "day long, earlier int, at array<long>")


def _micros(ts) -> int:
    """Epoch microseconds of a naive UTC datetime."""
    return int((ts - datetime(1970, 1, 1)) / timedelta(microseconds=1))


# ------------------------------------------------------------------------ V3
def overview_by_run(wh: Warehouse, max_runs: int | None = None, rolling: DataFrame | None = None) -> DataFrame:
    """Snapshot, rolling counts and their ratio per (run, app).  ``rolling``: V2 from kept parts (``plans.rolling``)."""
    m = metrics_by_run(wh)
    apps = wh.dim_app.select("app_id", "app_name")
    runs = wh.dim_etl_run.select("etl_run_id", F.col("started_at").alias("etl_started_at"))
    n = news_rolling_asof(wh, max_runs) if rolling is None else rolling
    # metrics and rolling counts are both partitioned by (run, app): join them
    # first, then the dimensions (broadcast when small, else one shuffle)
    joined = (m.join(n, ["app_id", "etl_run_id"], "left")
              .join(apps, "app_id").join(runs, "etl_run_id"))
    n7 = F.coalesce(F.col("news_count_7d"), F.lit(0).cast("long"))
    n30 = F.coalesce(F.col("news_count_30d"), F.lit(0).cast("long"))
    return joined.select(
        "app_id", "app_name", "etl_run_id", "etl_started_at", "snapshot_date", *METRICS,
        n7.alias("news_count_7d"), n30.alias("news_count_30d"),
        safe_ratio(F.col("ccu"), F.col("news_count_30d")).alias("ccu_per_news_30d"),
    )


# ------------------------------------------------------------------------ V4
def overview_latest_run(wh: Warehouse, overview: DataFrame | None = None) -> DataFrame:
    """Overview rows of the newest successful run.

    Its id is read first (one row), so only that run's partition is scanned and
    only its window of news is counted.
    """
    run_id = latest_run_id(wh)
    if overview is not None:
        return overview.filter(F.col("etl_run_id") == F.lit(run_id))
    return overview_by_run(wh, 1).limit(0) if run_id is None else overview_by_run(of_run(wh, run_id))


# ------------------------------------------------------------------------ V5
def news_latest(wh: Warehouse) -> DataFrame:
    """Every news row with its recency rank per app (rn = 1 is the newest).

    The rank uses the range-split numbering, so an app holding a large share
    of all news is numbered by many tasks.  Only the narrow key (app, id, ts)
    goes through the split, its checkpoint and its window; the wide columns
    join back on the primary key, and the content join reuses that
    partitioning.
    """
    keys = with_ts(wh.fact_news.select("app_id", "update_id", "timestamp_id"), wh).select("app_id", "update_id", "ts")
    keys = keys.join(wh.dim_app.select("app_id"), "app_id", "left_semi")  # the inner join with the app dimension
    ranked = split_row_number(keys, ["app_id"], [F.col("ts").desc(), F.col("update_id").desc()])
    wide = wh.fact_news.select("app_id", "update_id", "title", "url")
    content = wh.dim_update_content.select(
        "app_id", "update_id", "author", "feedlabel", "feedname", "feedtype",
        "is_external_url", "content_raw")
    rows = (ranked.join(wide, ["app_id", "update_id"])
            .join(content, ["app_id", "update_id"], "left")
            .join(wh.dim_app.select("app_id", "app_name"), "app_id"))
    return rows.select("app_id", "app_name", "update_id", "title", "url",
                       F.col("ts").alias("news_ts"), F.to_date("ts").alias("news_date"),
                       "author", "feedlabel", "feedname", "feedtype", "is_external_url",
                       "content_raw", "rn")


def news_top_n(wh: Warehouse, n: int = 5) -> DataFrame:
    """Latest ``n`` news per app (T6) -- top-k with a partial limit before the shuffle."""
    news = wh.fact_news.select("app_id", "update_id", "timestamp_id", "title", "url")
    base = with_ts(news, wh).join(wh.dim_app.select("app_id", "app_name"), "app_id")
    top = top_per_group(base, ["app_id"], [F.col("ts").desc(), F.col("update_id").desc()], k=n)
    return top.select("app_id", "app_name", "update_id", "title", "url",
                      F.col("ts").alias("news_ts"), "rn")


# ------------------------------------------------------------------------ V6
def news_daily(wh: Warehouse) -> DataFrame:
    news = wh.fact_news.select("app_id", "timestamp_id")
    if wh.micros_ids:
        dated = with_ts(news, wh).withColumn("news_date", F.to_date("ts"))
    else:
        dated = news.join(wh.dim_timestamp.select("timestamp_id", F.col("date").alias("news_date")), "timestamp_id")
    per_app_day = dated.groupBy("app_id", "news_date").agg(F.count(F.lit(1)).alias("news_count"))
    # app_name is functionally dependent on app_id: join after the aggregate
    return (per_app_day.join(wh.dim_app.select("app_id", "app_name"), "app_id")
            .select("app_id", "app_name", "news_date", "news_count"))


# ------------------------------------------------------------------------ V7
def timeseries_by_run(wh: Warehouse, overview: DataFrame | None = None) -> DataFrame:
    o = overview if overview is not None else overview_by_run(wh)
    d = news_daily(wh).select("app_id", F.col("news_date").alias("snapshot_date"),
                              F.col("news_count").alias("_daily"))
    cols = [c for c in o.columns if c != "ccu_per_news_30d"]
    return (o.join(d, ["app_id", "snapshot_date"], "left")
            .select(*cols, F.coalesce(F.col("_daily"), F.lit(0).cast("long")).alias("news_count_daily")))


# ------------------------------------------------------------------------ V8
def changes_by_run(wh: Warehouse, overview: DataFrame | None = None) -> DataFrame:
    """Differences to the previous run of the same app (one shared window, one sort)."""
    o = overview if overview is not None else overview_by_run(wh)
    w = Window.partitionBy("app_id").orderBy("etl_started_at", "etl_run_id")
    cols = [c for c in o.columns if c != "ccu_per_news_30d"]
    deltas = [(F.col(c) - F.lag(c).over(w)).alias(f"delta_{c}") for c in DELTA_COLUMNS]
    return o.select(*cols, *deltas)


# ------------------------------------------------------------------------ V9
def latest_by_app(wh: Warehouse, overview: DataFrame | None = None) -> DataFrame:
    o = overview if overview is not None else overview_by_run(wh)
    return top_per_group(o, ["app_id"], [F.col("etl_started_at").desc(), F.col("etl_run_id").desc()], k=1)


def build_marts(wh: Warehouse, max_runs: int | None = None) -> dict[str, DataFrame]:
    """All nine marts with the shared overview computed once; ``release_marts`` frees it."""
    overview = overview_by_run(wh, max_runs).persist()
    frames = [
        metrics_by_run(wh),
        news_rolling_asof(wh, max_runs),
        overview,
        overview_latest_run(wh, overview),
        news_latest(wh),
        news_daily(wh),
        timeseries_by_run(wh, overview),
        changes_by_run(wh, overview),
        latest_by_app(wh, overview),
    ]
    return dict(zip(VIEW_NAMES, frames))


def release_marts(marts: dict[str, DataFrame]) -> None:
    """Free the persisted overview of ``build_marts``."""
    marts[VIEW_NAMES[2]].unpersist()


def register_marts(wh: Warehouse, max_runs: int | None = None) -> dict[str, DataFrame]:
    """Register the marts as temp views under the reference's view names."""
    marts = build_marts(wh, max_runs)
    for name, df in marts.items():
        df.createOrReplaceTempView(name)
    return marts
