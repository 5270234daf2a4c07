"""Warehouse store on a (shared) file system, parquet throughout.

Layout under ``root``::

    runs/                                 run state log (append): one record per state change
    append/<table>/etl_run_id=<r>/        insert-only tables, one partition per load run:
                                          fact_steamspy_stats, fact_news,
                                          dim_update_content, dim_timestamp
    dims/v=<n>/<table>/                   upserted dimensions, one full version per run:
                                          dim_app, dim_update_typ
    quarantine/etl_run_id=<r>/            rejected snapshot rows with their reason
    report/etl_run_id=<r>/                per-app ingest counters of a run
    rolling_*/etl_run_id=<r>/             what a run adds to the rolling news counts (plans/rolling.py)

Commit protocol: a run writes its partitions and a new dimension version,
then appends its final run record carrying that version.  Readers take the
dimension version of the newest successful run and only the partitions of
successful runs, so a job that dies half-way leaves the readable state as it
was -- and a re-run writes its partitions again (dynamic overwrite).
Parquet has no in-place update and a path cannot be overwritten while it is
being read, hence versions instead of overwrites.
"""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.warehouse import Warehouse

APPEND_TABLES = ["fact_steamspy_stats", "fact_news", "dim_update_content", "dim_timestamp"]
VERSIONED_TABLES = ["dim_app", "dim_update_typ"]
FINAL_STATES = ("success", "failed")

RUN_LOG = T.StructType(schemas.DIM_ETL_RUN.fields + [
    T.StructField("dims_version", T.LongType(), True),
    T.StructField("seq", T.LongType(), False),
    T.StructField("load_key", T.StringType(), True),   # the batch that the run loaded, if it has a name
    T.StructField("micros_ids", T.BooleanType(), True),  # false: timestamp ids are not epoch microseconds
])


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---------------------------------------------------------------- paths
    def _p(self, *parts) -> str:
        return "/".join([self.root, *[str(p) for p in parts]])

    def path(self, *parts) -> str:
        return self._p(*parts)

    def has(self, *parts) -> bool:
        return self._exists(self._p(*parts))

    def _exists(self, path: str) -> bool:
        """Whether the folder is there; anything wrong inside it is an error of whoever reads it."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(where) and len(fs.listStatus(where)) > 0

    # ----------------------------------------------------------------- runs
    def run_log(self) -> DataFrame:
        path = self._p("runs")
        if not self._exists(path):
            return self.spark.createDataFrame([], RUN_LOG)
        return self.spark.read.schema(RUN_LOG).parquet(path)

    def runs(self) -> DataFrame:
        """``dim_etl_run``: newest state record per run id."""
        log = self.run_log()
        from tidemark.operators.ranking import top_per_group
        latest = top_per_group(log, ["etl_run_id"], [F.col("seq").desc()], k=1, out=None)
        return latest.select(*[f.name for f in schemas.DIM_ETL_RUN.fields])

    def _finalized(self) -> DataFrame:
        """Runs whose data is visible: finished with ``success``.  A failed run
        keeps its run record, but what it wrote before failing stays hidden,
        so the readable state never mixes half a run in."""
        log = self.run_log()
        return log.filter(F.col("status") == "success")

    def next_run_id(self) -> int:
        """Next run id (max + 1); one-row aggregate read on the driver."""
        row = self.run_log().agg(F.max("etl_run_id").alias("m")).first()
        return int(row["m"] or 0) + 1

    def append_run_state(self, run_id: int, run_type: str, status: str, started_at, ended_at,
                         now, dims_version: int | None, load_key: str | None = None,
                         micros_ids: bool = True) -> None:
        # order of state records: wall-clock nanoseconds of the (single) writer of a run
        seq = time.time_ns()
        row = [(run_id, run_type, status, started_at, ended_at, now, now, dims_version, seq, load_key, micros_ids)]
        self.spark.createDataFrame(row, RUN_LOG).coalesce(1).write.mode("append").parquet(self._p("runs"))

    def loaded(self, load_key: str) -> bool:
        """Whether a successful run has loaded the batch of that name."""
        return not self._finalized().filter(F.col("load_key") == load_key).isEmpty()

    def current_dims_version(self) -> int | None:
        row = self._finalized().agg(F.max("dims_version").alias("v")).first()
        return None if row["v"] is None else int(row["v"])

    # ---------------------------------------------------------------- reads
    def load(self) -> Warehouse:
        """The committed warehouse state (typed empty tables when nothing is committed)."""
        empty = Warehouse.empty(self.spark)
        frames = {"dim_etl_run": self.runs()}
        done = self._finalized().select("etl_run_id").distinct()
        for name in APPEND_TABLES:
            path = self._p("append", name)
            if self._exists(path):
                schema = T.StructType(schemas.TABLES[name].fields + (
                    [] if name in ("fact_steamspy_stats", "fact_news")
                    else [T.StructField("etl_run_id", T.LongType(), True)]))
                df = self.spark.read.schema(schema).parquet(path)
                df = df.join(done, "etl_run_id", "left_semi")  # committed runs only
                frames[name] = df.select(*[f.name for f in schemas.TABLES[name].fields])
            else:
                frames[name] = getattr(empty, name)
        version = self.current_dims_version()
        for name in VERSIONED_TABLES:
            if version is None:
                frames[name] = getattr(empty, name)
            else:
                frames[name] = self.spark.read.schema(schemas.TABLES[name]).parquet(self._p("dims", f"v={version}", name))
        foreign = self._finalized().filter(~F.coalesce(F.col("micros_ids"), F.lit(True)))
        return Warehouse(**frames, micros_ids=foreign.isEmpty())

    # --------------------------------------------------------------- writes
    def write_append(self, name: str, df: DataFrame, run_id: int) -> None:
        """Write the rows a run adds to an insert-only table (its own partition)."""
        out = df.withColumn("etl_run_id", F.lit(run_id).cast("long")) if "etl_run_id" not in df.columns else df
        cols = [f.name for f in schemas.TABLES[name].fields]
        if "etl_run_id" not in cols:
            cols = cols + ["etl_run_id"]
        (out.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("etl_run_id").parquet(self._p("append", name)))

    def partition(self, name: str, run_id: int) -> DataFrame:
        """Rows a run wrote to an insert-only table (its partition)."""
        schema = T.StructType([f for f in schemas.TABLES[name].fields if f.name != "etl_run_id"])
        path = self._p("append", name, f"etl_run_id={run_id}")
        if not self._exists(path):  # a run that added no rows writes no partition
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def write_dims(self, version: int, frames: dict[str, DataFrame]) -> None:
        for name in VERSIONED_TABLES:
            cols = [f.name for f in schemas.TABLES[name].fields]
            frames[name].select(*cols).write.mode("overwrite").parquet(self._p("dims", f"v={version}", name))

    def write_side(self, kind: str, df: DataFrame, run_id: int, append: bool = False) -> None:
        # the run id lives in the folder name (partition column), not in the files
        df.drop("etl_run_id").write.mode("append" if append else "overwrite").parquet(self._p(kind, f"etl_run_id={run_id}"))

    def side(self, kind: str, schema: str) -> DataFrame:
        """A side table of all runs, empty if no run wrote it; the schema names ``etl_run_id`` last."""
        if not self._exists(self._p(kind)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._p(kind))

    def side_of(self, kind: str, df: DataFrame, run_id: int) -> DataFrame:
        """``df`` as one run wrote it to a side table."""
        return self.spark.read.schema(df.drop("etl_run_id").schema).parquet(self._p(kind, f"etl_run_id={run_id}"))

    def committed_runs(self) -> list[int]:
        """Ids of the runs whose data is visible (one for each load run)."""
        return sorted(r["etl_run_id"] for r in self._finalized().select("etl_run_id").distinct().collect())

    def read_side(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(self._p(kind))

    def reset(self) -> None:
        """Empty the store (M9): everything under its root goes."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def adopt(self, wh: Warehouse) -> None:
        """Take a whole warehouse into this empty store: an imported snapshot or a fixture.

        Facts go to the partitions of their runs, rows without a run to the
        newest run's; the run log gets every run with its own state.
        """
        runs = wh.dim_etl_run.orderBy("etl_run_id").collect()          # one row per load run
        if self._exists(self._p("runs")):
            raise ValueError(f"{self.root} is not empty")
        if not runs:
            return
        good = [r["etl_run_id"] for r in runs if r["status"] == "success"]
        version = max(good) if good else max(r["etl_run_id"] for r in runs)
        for name in APPEND_TABLES:
            self.write_append(name, getattr(wh, name), version)
        self.write_dims(version, {name: getattr(wh, name) for name in VERSIONED_TABLES})
        seq = time.time_ns()
        log = [(*[r[f.name] for f in schemas.DIM_ETL_RUN.fields], version, seq + k, None, wh.has_micros_ids())
               for k, r in enumerate(runs)]
        self.spark.createDataFrame(log, RUN_LOG).coalesce(1).write.mode("append").parquet(self._p("runs"))

    # ---------------------------------------------------- export / import
    def export(self, target: str, fmt: str = "parquet") -> None:
        """Write every table of the committed state to ``target/<table>``."""
        if fmt not in ("parquet", "json"):
            raise ValueError(f"unsupported export format {fmt!r}")
        for name, df in self.load().tables().items():
            df.write.mode("overwrite").format(fmt).save(f"{target.rstrip('/')}/{name}")


def import_snapshot(spark: SparkSession, source: str, fmt: str | None = None,
                    validate: bool = False) -> Warehouse:
    """Load a whole warehouse snapshot, dispatching on the format.

    ``fmt`` defaults to the file extension of the table folders' content
    (``parquet`` / ``json`` / ``csv``); anything else is an error.  Every table
    is read with its declared schema.
    """
    fmt = fmt or _sniff_format(spark, source)
    if fmt not in ("parquet", "json", "csv"):
        raise ValueError(f"unsupported snapshot format {fmt!r}")
    frames = {}
    for name, schema in schemas.TABLES.items():
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", "true")
        frames[name] = reader.format(fmt).load(f"{source.rstrip('/')}/{name}")
    wh = Warehouse(**frames)
    wh = replace(wh, micros_ids=wh.has_micros_ids())
    if validate:  # the smoke test after an import: every declared constraint must hold
        from tidemark.operators.checks import assert_clean, constraint_report
        assert_clean(constraint_report(wh))
    return wh


def _sniff_format(spark: SparkSession, source: str) -> str:
    """The format that all data files of one small table have, by extension (compressed ones too)."""
    files = spark.read.format("binaryFile").load(f"{source.rstrip('/')}/dim_etl_run").select("path")
    names = {p.rsplit("/", 1)[-1] for (p,) in files.collect()}       # the run table: few files
    found = {ext for ext in ("parquet", "json", "csv") for n in names if f".{ext}" in n[n.find("."):]}
    if len(found) != 1:
        raise ValueError(f"name the snapshot's format: its files are {sorted(names)[:5]}")
    return found.pop()
