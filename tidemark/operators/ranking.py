"""Row numbers and running sums that do not put a whole group into one task.

``Window.partitionBy(k).orderBy(...)`` ships every row of a key to a single
task.  When one key holds a third of the table that task holds a third of the
table.  ``split_running_sum`` gets the same running sums in three
distributed steps:

1. range-partition on (group keys, order keys); the partitioner samples the
   full sort key, so a hot group is cut into many contiguous slices;
2. running sums inside each (group, slice) -- bounded by the slice size;
3. add, per (group, slice), the totals of the group's earlier slices
   (a small frame: one row per group and slice).

A row number is the running sum of 1.  Top-k per group (``rn <= k``) does not
need any of this: Catalyst applies a partial ``WindowGroupLimit`` before the
shuffle, so use ``top_per_group``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

_SLICE = "_tm_slice"


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def split_running_sum(df: DataFrame, group_cols: list[str], order_cols: list,
                      sums: dict[str, Column], slices: int | None = None,
                      keep_slice: bool = False) -> DataFrame:
    """Add ``SUM(expr) OVER (PARTITION BY group ORDER BY order ROWS UNBOUNDED
    PRECEDING)`` for each ``name -> expr`` of ``sums`` (inclusive of the row).

    ``order_cols`` must be a total order within a group (include the key).
    ``keep_slice`` also returns the slice each row was numbered in (``_tm_slice``).
    """
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _cols(order_cols)
    keys = [F.col(c) for c in group_cols]
    names = list(sums)
    vals = {name: f"_tm_v_{i}" for i, name in enumerate(names)}
    # NULL-safe group key as plain columns: value-or-sentinel plus an is-NULL
    # flag.  The local window and the offset join then use the same columns,
    # so the join reuses the window's partitioning instead of re-shuffling.
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    gk: list[str] = []
    gexprs = []
    for i, c in enumerate(group_cols):
        gexprs += [F.coalesce(F.col(c), _sentinel(types[c])).alias(f"_tm_g{i}"),
                   F.col(c).isNull().alias(f"_tm_z{i}")]
        gk += [f"_tm_g{i}", f"_tm_z{i}"]
    # The slice a row lands in depends on the sampled range bounds, and the
    # sample depends on row order after upstream shuffles.  The sliced frame
    # is used twice below, so it is checkpointed (to the shared checkpoint
    # folder): both uses then see one slice assignment, and a lost executor
    # re-reads the checkpoint instead of re-sampling.
    checkpoint_dir(spark)
    sliced = (df.select("*", *gexprs, *[sums[nm].alias(vals[nm]) for nm in names])
              .repartitionByRange(n, *keys, *order)
              .withColumn(_SLICE, F.spark_partition_id())
              .checkpoint(eager=True))

    local_w = (Window.partitionBy(*gk, _SLICE).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = sliced.select(*df.columns, *gk, _SLICE,
                          *[F.sum(vals[nm]).over(local_w).alias(f"_tm_l_{vals[nm]}") for nm in names])

    totals = sliced.groupBy(*gk, _SLICE).agg(*[F.sum(vals[nm]).alias(f"_tm_t_{vals[nm]}") for nm in names])
    before = Window.partitionBy(*gk).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *gk, _SLICE,
        *[F.coalesce(F.sum(f"_tm_t_{vals[nm]}").over(before), F.lit(0)).alias(f"_tm_o_{vals[nm]}") for nm in names])

    joined = local.join(offsets, [*gk, _SLICE], "inner")
    return joined.select(
        *df.columns,
        *[(F.col(f"_tm_o_{vals[nm]}") + F.col(f"_tm_l_{vals[nm]}")).alias(nm) for nm in names],
        *([F.col(_SLICE)] if keep_slice else []),
    )


def _sentinel(dtype) -> Column:
    """A non-NULL stand-in of the column's type (paired with an is-NULL flag)."""
    from pyspark.sql import types as T
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(0).cast("timestamp").cast(dtype)
    return F.lit(0).cast(dtype)


def split_row_number(df: DataFrame, group_cols: list[str], order_cols: list,
                     out: str = "rn", slices: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group_cols ORDER BY order_cols)`` as BIGINT.

    With ``group_cols == []`` this is a global, gap-free numbering (used for
    surrogate ids).
    """
    res = split_running_sum(df, group_cols, order_cols, {out: F.lit(1).cast("long")}, slices)
    return res.withColumn(out, F.col(out).cast("long"))


def top_per_group(df: DataFrame, group_cols: list[str], order_cols: list, k: int = 1,
                  out: str | None = "rn") -> DataFrame:
    """Rows with ``row_number() <= k`` per group (partial limit before shuffle)."""
    w = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
    rn = out or "_tm_rn"
    ranked = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    ranked = ranked.withColumn(rn, F.col(rn).cast("long"))
    return ranked if out else ranked.drop(rn)
