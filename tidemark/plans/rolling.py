"""Rolling news counts kept per load run instead of recounted (V2, V3).

The count of a run and an app is a sum over its news, so it can be kept as additive parts.
Every load run writes three small tables of its own:

* ``rolling_times`` (app_id, at, n): its news by event time in microseconds, files sorted by time;
* ``rolling_days`` (app_id, day, n): the same by day;
* ``rolling_counts`` (anchor_run, app_id, news_count_7d, news_count_30d): what the run adds to the counts of runs,
  its own and, through late news, of earlier ones; never zero in both.

A pair of a news row and an anchor is counted by the later of the run that brought the
news and the run of the anchor.  So a run reads its new news (against all anchors) and the buckets of
earlier runs (against its own anchor): whole days from ``rolling_days``, the days that the windows cut from
``rolling_times``, whose filter reaches the files.  No run reads old news.  ``counts`` adds the parts up
and equals ``marts.news_rolling_asof`` over all news.

``rolling_runs`` (run_id, batch) states which runs the parts cover, and is written last; runs that are not covered (an imported
snapshot, a store of an earlier version) are caught up by the next load or by ``refresh``.

Defined cases: news without a timestamp do not count, as in the mart; failed runs are no anchors and
their parts stay invisible, as all they wrote; a run without news writes empty parts; a run that is loaded again
replaces its parts; news of the future count for the later anchors that they precede.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import marts
from tidemark.plans.marts import DAY
from tidemark.sources.store import Store
from tidemark.warehouse import Warehouse

SCHEMAS = {
    "rolling_counts": "anchor_run long, app_id int, news_count_7d long, news_count_30d long",
    "rolling_days": "app_id int, day long, n long",
    "rolling_times": "app_id int, at long, n long",
}
RANGES = 20  # anchors up to which their cut days are single ranges in the filter; beyond, one range spans them


@dataclass(frozen=True)
class Parts:
    """The additive tables of some runs."""

    rolling_counts: DataFrame
    rolling_days: DataFrame
    rolling_times: DataFrame

    def plus(self, other: Parts) -> Parts:
        return Parts(*[getattr(self, k).unionByName(getattr(other, k)) for k in SCHEMAS])

    @staticmethod
    def empty(spark: SparkSession) -> Parts:
        return Parts(*[spark.createDataFrame([], s) for s in SCHEMAS.values()])


def parts_of(wh: Warehouse, news: DataFrame, anchors: list[tuple[int, int]], new: set[int], before: Parts) -> Parts:
    """What ``news`` and the runs ``new`` add.

    ``anchors``: (run id, microseconds) of all successful runs, the new ones included; ``before``: the parts of all other runs.
    """
    spark = news.sparkSession
    at = F.col("timestamp_id") if wh.micros_ids else F.unix_micros(F.col("ts").cast("timestamp"))
    times = marts.with_ts(news.select("app_id", "timestamp_id"), wh).groupBy("app_id", at.alias("at")) \
        .agg(F.count(F.lit(1)).alias("n"))
    days = times.groupBy("app_id", _day("at").alias("day")).agg(F.sum("n").alias("n"))
    runs = spark.createDataFrame([(r, a) for r, a in anchors], "etl_run_id long, a long").select(
        "etl_run_id", F.lit("success").alias("status"), F.timestamp_micros("a").cast("timestamp_ntz").alias("started_at"))
    own = marts.news_rolling_asof(wh.with_tables(fact_news=news, dim_etl_run=runs)).select(
        F.col("etl_run_id").alias("anchor_run"), "app_id", "news_count_7d", "news_count_30d")
    own = own.filter((F.col("news_count_7d") != 0) | (F.col("news_count_30d") != 0))
    older = _older(before, [x for x in anchors if x[0] in new])
    return Parts(own if older is None else own.unionByName(older), days, times)


def _day(micros: str):
    m = F.col(micros)
    return F.call_function("div", m - F.pmod(m, F.lit(DAY)), F.lit(DAY))


def _older(before: Parts, anchors: list[tuple[int, int]]) -> DataFrame | None:
    """Counts at ``anchors`` from the buckets of other runs."""
    if not anchors:
        return None
    spark = before.rolling_days.sparkSession
    whole, cut, ranges = [], [], []
    for run, a in anchors:
        week, month = a - 6 * DAY, a - 29 * DAY
        edges = {a // DAY, week // DAY, month // DAY}
        for day in range(month // DAY, a // DAY + 1):
            (cut if day in edges else whole).append((run, day, week, month, a))
        ranges += [(day * DAY, (day + 1) * DAY - 1) for day in edges]
    if len(anchors) > RANGES:
        ranges = [(min(lo for lo, _ in ranges), max(hi for _, hi in ranges))]
    schema = "anchor_run long, day long, week long, month long, anchor long"

    def counted(rows: DataFrame, moment) -> DataFrame:
        """A day's bucket stands for its first moment: it lies wholly inside or outside."""
        inside = (moment >= F.col("month")) & (moment <= F.col("anchor"))
        return rows.filter(inside).groupBy("anchor_run", "app_id").agg(
            F.sum(F.when(moment >= F.col("week"), F.col("n")).otherwise(F.lit(0))).cast("long").alias("news_count_7d"),
            F.sum("n").cast("long").alias("news_count_30d"))

    first, last = min(d for _, d, *_ in whole), max(d for _, d, *_ in whole)
    days = before.rolling_days.filter(F.col("day").between(first, last)) \
        .join(marts._bounded(spark, whole, schema), "day")
    times = before.rolling_times.filter(reduce(lambda x, y: x | y, [F.col("at").between(lo, hi) for lo, hi in ranges]))
    times = times.withColumn("day", _day("at")).join(marts._bounded(spark, cut, schema), "day")
    return counted(days, F.col("day") * F.lit(DAY)).unionByName(counted(times, F.col("at"))) \
        .groupBy("anchor_run", "app_id").agg(F.sum("news_count_7d").alias("news_count_7d"), F.sum("news_count_30d").alias("news_count_30d"))


def counts(parts: Parts, wh: Warehouse, max_runs: int | None = None) -> DataFrame:
    """V2 from the parts: rows as ``marts.news_rolling_asof``, without reading news."""
    spark = parts.rolling_counts.sparkSession
    runs = [(r["etl_run_id"],) for r in marts.successful_runs(wh, max_runs).collect()]
    grid = parts.rolling_days.select("app_id").distinct().crossJoin(marts._bounded(spark, runs, "etl_run_id long"))  # the rows of the result
    summed = parts.rolling_counts.groupBy(F.col("anchor_run").alias("etl_run_id"), "app_id").agg(
        F.sum("news_count_7d").alias("s7"), F.sum("news_count_30d").alias("s30"))
    zero = F.lit(0).cast("long")
    return grid.join(summed, ["etl_run_id", "app_id"], "left").select(
        "etl_run_id", "app_id", F.coalesce("s7", zero).alias("news_count_7d"), F.coalesce("s30", zero).alias("news_count_30d"))


# ---------------------------------------------------------------- parts in a store
def stored(store: Store) -> tuple[Parts, set[int]]:
    """The committed parts and the runs that they cover."""
    done = store.committed_runs()
    runs = store.side("rolling_runs", "run_id long, batch string, etl_run_id long").filter(F.col("etl_run_id").isin(done)).collect()
    covered, batches = {r["run_id"] for r in runs} & set(done), sorted({r["batch"] for r in runs})     # one row for each load run
    parts = [store.side(k, f"{s}, batch string, etl_run_id long").filter(F.col("etl_run_id").isin(done) & F.col("batch").isin(batches))
             .drop("etl_run_id", "batch") for k, s in SCHEMAS.items()]
    return Parts(*parts), covered


def maintain(store: Store, wh: Warehouse, run_id: int, started, news: DataFrame | None) -> None:
    """Write the parts of the run ``run_id``, whose new news are ``news``; ``wh`` is the committed state before it.

    Part of the run's commit: its parts become visible with its final run record.  Without ``started`` only what is
    missing is added to the parts of a run that is committed already.
    """
    before, covered = stored(store)
    missing = set(store.committed_runs()) - covered - ({run_id} if started is not None else set())
    if missing:           # news of runs that the parts do not cover yet
        old = wh.fact_news.filter(F.col("etl_run_id").isin(sorted(missing))).select("app_id", "timestamp_id")
        news = old if news is None else old.unionByName(news.select("app_id", "timestamp_id"))
    if news is None:
        news = wh.fact_news.limit(0)
    anchors = _anchors(wh) + ([(run_id, marts._micros(started))] if started is not None else [])
    new = missing | ({run_id} if started is not None else set())
    _write(store, parts_of(wh, news, anchors, new, before), new, run_id, append=started is None)


def _anchors(wh: Warehouse) -> list[tuple[int, int]]:
    return [(r["etl_run_id"], marts._micros(r["anchor_ts"])) for r in marts.successful_runs(wh).collect()]   # one row for each run


def _write(store: Store, parts: Parts, covered: set[int], run_id: int, append: bool) -> None:
    """The parts and last the runs that they cover: parts whose batch is not stated there do not count."""
    batch = uuid.uuid4().hex
    runs = store.spark.createDataFrame([(r,) for r in sorted(covered)], "run_id long").coalesce(1)
    for kind, df in (("rolling_counts", parts.rolling_counts), ("rolling_days", parts.rolling_days),
                     ("rolling_times", parts.rolling_times.sortWithinPartitions("at")), ("rolling_runs", runs)):
        store.write_side(kind, df.withColumn("batch", F.lit(batch)), run_id, append)


def refresh(store: Store) -> None:
    """Catch up runs that the parts do not cover, without a load (after an import)."""
    wh, done = store.load(), store.committed_runs()
    if set(done) - stored(store)[1]:
        maintain(store, wh, max(done), None, None)


def news_rolling(store: Store, max_runs: int | None = None) -> DataFrame:
    """V2 of a store from its kept parts."""
    refresh(store)
    return counts(stored(store)[0], store.load(), max_runs)


def overview(store: Store, max_runs: int | None = None) -> DataFrame:
    """V3 of a store with the kept counts."""
    return marts.overview_by_run(store.load(), max_runs, rolling=news_rolling(store, max_runs))
