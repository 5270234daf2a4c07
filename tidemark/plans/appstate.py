"""What each load run leaves behind for the next: the newest snapshot row per app, and the newest news time per app.

Two marts compare or pick snapshot rows per app over all runs (V8, V9), and an incremental load asks for each app's
newest news (A3, F2, J11).  Both need the state after the last run only, so every run writes

* ``app_state``: per app its newest snapshot row so far (the state before, replaced where the run has a row);
* ``app_deltas``: the run's own rows with the differences to the state before and the run they differ from;
* ``news_marks`` (app_id, at): per app the newest time among the run's own news, in microseconds.

Rolling news counts of a run can still rise when late news arrive, so rows do not hold them: ``changes`` and
``latest`` join the kept counts of ``plans.rolling`` at both runs.  No run and no reader looks at old fact rows.

``app_state_runs`` states which runs a chain of states covers and is written last.  A run continues the newest chain
if it begins after all runs of that chain and the chain covers every committed run; otherwise (an imported
snapshot, a run dated back) a new chain is computed from all facts, once.  Readers use the newest committed chain only.

Defined cases: an app without a row in a run keeps its state; snapshot rows without an app or a timestamp do not count,
as in the marts; failed runs leave nothing that is read; a run that is written again gives the same rows; two runs that
begin at one time are ordered by their ids.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.parse import safe_ratio
from tidemark.operators import pages
from tidemark.operators.ranking import top_per_group
from tidemark.plans import marts, rolling
from tidemark.schemas import DELTA_COLUMNS, METRICS
from tidemark.sources.store import Store
from tidemark.warehouse import Warehouse

DELTA_METRICS = [c for c in DELTA_COLUMNS if c in METRICS]
COUNTS = ["news_count_7d", "news_count_30d"]
_PLAIN = "app_id int, run_id long, etl_started_at timestamp_ntz, snapshot_date date, "
RUNS = "run_id long, started long, chain string, seq long, etl_run_id long"
MARKS = "app_id int, at long, run_id long, batch string, etl_run_id long"


def run_rows(wh: Warehouse, run_id: int | None = None) -> DataFrame:
    """Newest snapshot row per app and run (V1) with the time the run began."""
    wh = wh if run_id is None else marts.of_run(wh, run_id)
    runs = wh.dim_etl_run.select(F.col("etl_run_id"), F.col("started_at").alias("etl_started_at"))
    return marts.metrics_by_run(wh).filter(F.col("app_id").isNotNull()).join(runs, "etl_run_id").select(
        "app_id", F.col("etl_run_id").alias("run_id"), "etl_started_at", "snapshot_date", *METRICS)


def step(state: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deltas of ``rows``, state after them) from the state before; ``rows`` are of one run or several later than the state."""
    both = state.select(*rows.columns, F.lit(False).alias("_new")).unionByName(rows.withColumn("_new", F.lit(True)))
    order = Window.partitionBy("app_id").orderBy("etl_started_at", "run_id")
    deltas = both.select(*both.columns, F.lag("run_id").over(order).alias("previous_run"),
                         *[(F.col(c) - F.lag(c).over(order)).alias(f"delta_{c}") for c in DELTA_METRICS])
    newest = [F.col("etl_started_at").desc(), F.col("run_id").desc()]
    return deltas.filter("_new").drop("_new"), top_per_group(both.drop("_new"), ["app_id"], newest, k=1, out=None)


def first_step(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same without a state before (a new chain)."""
    return step(rows.limit(0), rows)


def changes_of(deltas: DataFrame, counts: DataFrame, apps: DataFrame) -> DataFrame:
    """V8 from deltas, rolling counts per (run, app) and the app dimension."""
    now = counts.select("app_id", F.col("etl_run_id").alias("run_id"), *COUNTS)
    then = counts.select("app_id", F.col("etl_run_id").alias("previous_run"), *[F.col(c).alias(f"_{c}") for c in COUNTS])
    both = deltas.join(now, ["app_id", "run_id"], "left").join(then, ["app_id", "previous_run"], "left") \
        .join(apps.select("app_id", "app_name"), "app_id")
    zero = F.lit(0).cast("long")
    held = {c: F.coalesce(F.col(c), zero) for c in COUNTS}
    moved = {c: F.when(F.col("previous_run").isNotNull(), held[c] - F.coalesce(F.col(f"_{c}"), zero)) for c in COUNTS}
    return both.select("app_id", "app_name", F.col("run_id").alias("etl_run_id"), "etl_started_at", "snapshot_date", *METRICS,
                       *[held[c].alias(c) for c in COUNTS],
                       *[(moved[c] if c in moved else F.col(f"delta_{c}")).alias(f"delta_{c}") for c in DELTA_COLUMNS])


def latest_of(state: DataFrame, counts: DataFrame, apps: DataFrame) -> DataFrame:
    """V9 from the state."""
    now = counts.select("app_id", F.col("etl_run_id").alias("run_id"), *COUNTS)
    both = state.join(now, ["app_id", "run_id"], "left").join(apps.select("app_id", "app_name"), "app_id")
    zero = F.lit(0).cast("long")
    return both.select("app_id", "app_name", F.col("run_id").alias("etl_run_id"), "etl_started_at", "snapshot_date", *METRICS,
                       *[F.coalesce(F.col(c), zero).alias(c) for c in COUNTS],
                       safe_ratio(F.col("ccu"), F.col("news_count_30d")).alias("ccu_per_news_30d"), F.lit(1).alias("rn"))


# --------------------------------------------------------------- in a store
def _side(store: Store, kind: str, like: DataFrame) -> DataFrame:
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in like.schema.fields)
    return store.side(kind, f"{fields}, chain string, etl_run_id long")


def _chain(store: Store, without: int | None = None) -> tuple[str | None, dict[int, int], int | None]:
    """Newest committed chain: its name, its runs with their beginnings, and the run whose folder holds its state."""
    done = [r for r in store.committed_runs() if r != without]
    marks = store.side("app_state_runs", RUNS).filter(F.col("etl_run_id").isin(done)).collect()     # one row for each load run
    if not marks:
        return None, {}, None
    newest = max(marks, key=lambda r: (r["etl_run_id"], r["seq"]))
    own = [r for r in marks if r["chain"] == newest["chain"]]
    return newest["chain"], {r["run_id"]: r["started"] for r in own if r["run_id"] in done}, newest["etl_run_id"]


def _tables(store: Store, wh: Warehouse, chain: str | None, holder: int | None) -> tuple[DataFrame, DataFrame]:
    """(deltas, state) of a chain."""
    empty_deltas, empty_state = first_step(run_rows(wh).limit(0))
    held = F.col("chain") == F.lit(chain)
    deltas = _side(store, "app_deltas", empty_deltas).filter(held)
    state = _side(store, "app_state", empty_state).filter(held & (F.col("etl_run_id") == F.lit(holder)))
    return deltas.drop("chain", "etl_run_id"), state.drop("chain", "etl_run_id")


def _with_times(store: Store, wh: Warehouse, run_id: int) -> Warehouse:
    """The committed state with the timestamps that the run has written."""
    new = store.partition("dim_timestamp", run_id).select(*wh.dim_timestamp.columns)
    return wh.with_tables(dim_timestamp=wh.dim_timestamp.unionByName(new))


def maintain(store: Store, wh: Warehouse, run_id: int, started) -> None:
    """Write what the run ``run_id`` leaves behind, from the partition of facts it wrote; part of the run's commit.

    ``wh`` is the committed state before the run.
    """
    spark, at, wh = store.spark, marts._micros(started), _with_times(store, wh, run_id)
    chain, covered, holder = _chain(store, run_id)
    own = store.partition("fact_steamspy_stats", run_id).withColumn("etl_run_id", F.lit(run_id).cast("long"))
    this = spark.createDataFrame([(run_id, started)], "etl_run_id long, started_at timestamp_ntz")
    new = run_rows(wh.with_tables(fact_steamspy_stats=own, dim_etl_run=this))
    follows = set(store.committed_runs()) - {run_id} == set(covered) and all((at, run_id) > (a, r) for r, a in covered.items())
    if follows:
        _, state = _tables(store, wh, chain, holder)
        _write(store, *step(state, new), chain or uuid.uuid4().hex, [(run_id, at)], run_id)
    else:
        old = wh.dim_etl_run.filter(F.col("status") == "success")
        rows = run_rows(wh).join(old.select(F.col("etl_run_id").alias("run_id")), "run_id", "left_semi").unionByName(new)
        _write(store, *first_step(rows), uuid.uuid4().hex, rolling._anchors(wh) + [(run_id, at)], run_id)


def _write(store: Store, deltas: DataFrame, state: DataFrame, chain: str, runs: list[tuple[int, int]], run_id: int, append: bool = False) -> None:
    for kind, df in (("app_deltas", deltas), ("app_state", state)):
        store.write_side(kind, df.withColumn("chain", F.lit(chain)), run_id, append)
    seq = time.time_ns()
    marks = store.spark.createDataFrame([(r, a, chain, seq) for r, a in runs], "run_id long, started long, chain string, seq long")
    store.write_side("app_state_runs", marks.coalesce(1), run_id, append)


def refresh(store: Store, wh: Warehouse) -> None:
    """A new chain if committed runs are not covered, without a load (after an import)."""
    done = store.committed_runs()
    if done and set(done) - set(_chain(store)[1]):
        good = wh.with_tables(dim_etl_run=wh.dim_etl_run.filter(F.col("status") == "success"))
        _write(store, *first_step(run_rows(good)), uuid.uuid4().hex, rolling._anchors(wh), max(done), append=True)


def changes(store: Store, run_id: int | None = None) -> DataFrame:
    """V8 of a store, of all runs or one, without a window over runs."""
    wh = store.load()
    refresh(store, wh)
    chain, _, holder = _chain(store)
    deltas = _tables(store, wh, chain, holder)[0]
    if run_id is not None:
        deltas = deltas.filter(F.col("run_id") == run_id)
    return changes_of(deltas, rolling.news_rolling(store), wh.dim_app)


def latest(store: Store) -> DataFrame:
    """V9 of a store from its newest state."""
    wh = store.load()
    refresh(store, wh)
    chain, _, holder = _chain(store)
    return latest_of(_tables(store, wh, chain, holder)[1], rolling.news_rolling(store), wh.dim_app)


# ------------------------------------------------------------ A3, F2, J11
def marks_of(news: DataFrame, wh: Warehouse) -> DataFrame:
    """(app_id, at): newest time per app among ``news``, as microseconds."""
    newest = pages.latest_news_ts(news, wh.dim_timestamp, wh.micros_ids)
    return newest.select("app_id", F.unix_micros(F.col("latest_ts").cast("timestamp")).alias("at")).filter(F.col("at").isNotNull())


def watermark_of(marks: DataFrame) -> DataFrame:
    """A3 from the marks of any runs: (app_id, latest_ts)."""
    newest = marks.groupBy("app_id").agg(F.max("at").alias("at"))
    return newest.select("app_id", F.timestamp_micros("at").cast("timestamp_ntz").alias("latest_ts"))


def _marks(store: Store, without: int | None = None) -> tuple[DataFrame, set[int]]:
    """Marks of committed runs, and the runs that they cover (each has a row without an app)."""
    done = [r for r in store.committed_runs() if r != without]
    kept = store.side("news_marks", MARKS).filter(F.col("etl_run_id").isin(done))
    own = kept.filter(F.col("app_id").isNull()).select("run_id", "batch").collect()                 # one row for each load run
    batches = sorted({r["batch"] for r in own})
    marks = kept.filter(F.col("app_id").isNotNull() & F.col("batch").isin(batches)).select("app_id", "at")
    return marks, {r["run_id"] for r in own} & set(done)


def watermark(store: Store, wh: Warehouse) -> DataFrame:
    """A3 of the committed state; news are read of those runs alone that left no marks (an imported snapshot)."""
    marks, covered = _marks(store)
    missing = sorted(set(store.committed_runs()) - covered)
    if missing:
        marks = marks.unionByName(marks_of(wh.fact_news.filter(F.col("etl_run_id").isin(missing)), wh))
    return watermark_of(marks)


def maintain_marks(store: Store, wh: Warehouse, run_id: int, news: DataFrame | None) -> None:
    """Write the marks of the run, whose new news are ``news``, and of runs before it that left none."""
    spark, done = store.spark, [r for r in store.committed_runs() if r != run_id]
    missing = sorted(set(done) - _marks(store, run_id)[1])
    parts = [] if news is None else [marks_of(news, _with_times(store, wh, run_id))]
    if missing:
        parts.append(marks_of(wh.fact_news.filter(F.col("etl_run_id").isin(missing)), wh))
    rows = spark.createDataFrame([(None, None, r) for r in [*missing, run_id]], "app_id int, at long, run_id long").coalesce(1)
    for p in parts:
        rows = rows.unionByName(p.withColumn("run_id", F.lit(None).cast("long")))
    store.write_side("news_marks", rows.withColumn("batch", F.lit(uuid.uuid4().hex)), run_id)
