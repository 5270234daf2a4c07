"""Data-quality checks (C1-C5, K1-K3) as DataFrames of counts.

Every check is an aggregate (or anti join + count), so it runs distributed
and returns a handful of rows; ``assert_clean`` turns a result into an error
for job / CI use.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.warehouse import Warehouse

SMOKE_TABLES = ["dim_timestamp", "dim_app", "dim_update_typ", "dim_update_content", "fact_news",
                "fact_steamspy_stats"]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """K1: (table_name, row_count) for each table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_count(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Number of rows with a NULL in any of ``cols`` -> (check, violations)."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.agg(F.count_if(cond).cast("long").alias("violations")).select(F.lit(name).alias("check"), "violations")


def orphan_count(child: DataFrame, parent: DataFrame, child_cols: list[str], parent_cols: list[str],
                 name: str, skip_null: bool = False) -> DataFrame:
    """Child rows without a parent row (anti join).  With
    ``skip_null`` a child whose key has a NULL is not an orphan (FK rule);
    without it the count is the reference's LEFT JOIN ... IS NULL.  Children are
    counted by key first, so a key that many rows share crosses the shuffle once a task."""
    c = child.select(*[F.col(a).alias(f"_k{i}") for i, a in enumerate(child_cols)])
    if skip_null:
        c = c.dropna()
    p = parent.select(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(parent_cols)]).dropna()
    keys = [f"_k{i}" for i in range(len(child_cols))]
    counted = c.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (counted.join(p, keys, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))
            .select(F.lit(name).alias("check"), "violations"))


def duplicate_keys(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """Keys that occur more than once -> (check, violations = such keys, extra_rows)."""
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return g.agg(F.count(F.lit(1)).alias("violations"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("extra_rows")).select(
        F.lit(name).alias("check"), "violations", "extra_rows")


def check_owners(df: DataFrame) -> DataFrame:
    """C4: CHECK owners_min <= owners_max (NULL passes)."""
    bad = F.col("owners_min").isNotNull() & F.col("owners_max").isNotNull() & (F.col("owners_min") > F.col("owners_max"))
    return df.agg(F.count_if(bad).cast("long").alias("violations")).select(F.lit("owners_check").alias("check"), "violations")


# -------------------------------------------------------------------- K1-K3
def smoke_counts(wh: Warehouse) -> DataFrame:
    t = wh.tables()
    return row_counts({n: t[n] for n in SMOKE_TABLES})


def smoke_null_keys(wh: Warehouse) -> DataFrame:
    return null_count(wh.fact_news, ["app_id", "update_id", "timestamp_id", "etl_run_id"], "fact_news_null_keys") \
        .unionByName(null_count(wh.fact_steamspy_stats, ["app_id", "timestamp_id", "etl_run_id"],
                                "fact_steamspy_null_keys"))


def smoke_orphans(wh: Warehouse) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        orphan_count(wh.fact_news, wh.dim_update_content, ["app_id", "update_id"], ["app_id", "update_id"],
                     "fact_news_orphan_content"),
        orphan_count(wh.fact_news, wh.dim_timestamp, ["timestamp_id"], ["timestamp_id"], "fact_news_orphan_timestamp"),
        orphan_count(wh.fact_steamspy_stats, wh.dim_timestamp, ["timestamp_id"], ["timestamp_id"],
                     "fact_steamspy_orphan_timestamp"),
    ])


def constraint_report(wh: Warehouse) -> DataFrame:
    """All declared constraints of the schema: NOT NULL, PK / UNIQUE, FK, CHECK."""
    t = wh.tables()
    parts = []
    for name, cols in schemas.NOT_NULL.items():
        if cols:
            parts.append(null_count(t[name], cols, f"not_null:{name}").withColumn("extra_rows", F.lit(0).cast("long")))
    for name, key in {**schemas.PRIMARY_KEYS}.items():
        parts.append(duplicate_keys(t[name], key, f"pk:{name}"))
    for name, key in schemas.UNIQUE_KEYS.items():
        parts.append(duplicate_keys(t[name], key, f"unique:{name}"))
    for child, ccols, parent, pcols in schemas.FOREIGN_KEYS:
        parts.append(orphan_count(t[child], t[parent], ccols, pcols, f"fk:{child}->{parent}:{','.join(ccols)}",
                                  skip_null=True).withColumn("extra_rows", F.lit(0).cast("long")))
    parts.append(check_owners(t["fact_steamspy_stats"]).withColumn("extra_rows", F.lit(0).cast("long")))
    return reduce(DataFrame.unionByName, parts)


def assert_clean(report: DataFrame) -> None:
    """Raise when any check of a report has violations (K4)."""
    bad = report.filter(F.col("violations") > 0).collect()   # at most one row for each declared constraint
    if bad:
        raise AssertionError("data-quality checks failed: " + ", ".join(f"{r['check']}={r['violations']}" for r in bad))
