"""Fact-side operators: typed snapshot rows with quarantine, insert-only
appends, first-seen de-duplication.

Validation happens on the whole row before anything is written: a row that
the database would refuse (type, range, CHECK) is rejected as a whole and
leaves neither a fact nor an app change behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parse import (
    fits_decimal,
    fits_int,
    is_decimal_nan,
    owners_range,
    parse_int_strict,
    parse_money,
)
from tidemark.schemas import METRIC_INT_COLUMNS

INT_METRICS = [c for c in METRIC_INT_COLUMNS if c not in ("owners_min", "owners_max")]
MONEY = [("price", 100, 12), ("initialprice", 100, 12), ("discount", 1, 5)]


# ------------------------------------------------------------ P14 + F9 + C4/C5
def parse_snapshot(raw: DataFrame) -> DataFrame:
    """Landed snapshot rows (all text) -> typed rows plus ``reject_reason``.

    ``reject_reason`` is NULL for a valid row, else the first failed rule: ``pos`` (no payload
    position, so no id and no order), ``appid``, ``owners_range``, ``owners_check``, ``int:<col>``,
    ``nan:<col>`` or ``range:<col>``.
    """
    # Two projections: values and per-rule flags first, the reason from the
    # flag columns second -- one projection that re-derives every value inside
    # the reason outgrows the 64 KB method limit of generated code.
    app_id, app_ok = parse_int_strict("appid")
    o_min, o_max = owners_range("owners")
    cols: dict[str, Column] = {"app_id": app_id, "_o_min": o_min, "_o_max": o_max}
    flags: list[tuple[str, Column]] = [("appid", F.col("appid").isNull() | ~app_ok), ("pos", F.col("pos").isNull())]
    for c in INT_METRICS:
        val, ok = parse_int_strict(c)
        cols[c] = val
        flags.append((f"int:{c}", ~ok))
    for c, scale, precision in MONEY:
        cols[f"_w_{c}"] = parse_money(c, scale=scale, precision=precision)
        flags.append((f"nan:{c}", is_decimal_nan(c)))
    step1 = raw.select("pos", F.col("name").alias("app_name"), "developer", "publisher",
                       *[v.alias(k) for k, v in cols.items()],
                       *[v.alias(f"_f{i}") for i, (_, v) in enumerate(flags)])
    lo, hi = F.col("_o_min"), F.col("_o_max")
    checks: list[tuple[Column, str]] = [(F.col("_f1"), "pos"), (F.col("_f0"), "appid"),
                                        (~(fits_int(lo) & fits_int(hi)), "owners_range"),
                                        (lo.isNotNull() & hi.isNotNull() & (lo > hi), "owners_check")]
    checks += [(F.col(f"_f{i}"), tag) for i, (tag, _) in enumerate(flags) if tag.startswith("int:")]
    for c, _scale, precision in MONEY:
        i = [t for t, _ in flags].index(f"nan:{c}")
        checks.append((F.col(f"_f{i}"), f"nan:{c}"))
        checks.append((~fits_decimal(F.col(f"_w_{c}"), precision), f"range:{c}"))
    reason = F.coalesce(*[F.when(cond, F.lit(tag)) for cond, tag in checks])
    typed = {
        "app_id": F.col("app_id"),
        "owners_min": F.when(fits_int(lo), lo.cast("int")),
        "owners_max": F.when(fits_int(hi), hi.cast("int")),
        **{c: F.col(c) for c in INT_METRICS},
        **{c: F.when(fits_decimal(F.col(f"_w_{c}"), p), F.col(f"_w_{c}")).cast(f"decimal({p},2)")
           for c, _s, p in MONEY},
    }
    return step1.select(
        "pos",
        *[typed[c].alias(c) for c in ["app_id"] + METRIC_INT_COLUMNS + [m[0] for m in MONEY]],
        "app_name", "developer", "publisher",
        reason.alias("reject_reason"),
    )


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of a parsed frame."""
    return (parsed.filter(F.col("reject_reason").isNull()),
            parsed.filter(F.col("reject_reason").isNotNull()))


# ------------------------------------------------------------------------- M6
def with_unique_positions(valid: DataFrame) -> DataFrame:
    """Rows whose payload positions are unique: as they are, or numbered anew if several files brought the same ones.

    The new numbers follow (pos, app, all other columns), in range slices.
    """
    repeated = valid.groupBy("pos").count().filter(F.col("count") > 1)
    if repeated.isEmpty():
        return valid
    from tidemark.operators.ranking import split_row_number
    order = ["pos", "app_id", *[c for c in valid.columns if c not in ("pos", "app_id")]]
    return split_row_number(valid, [], order, out="_number").withColumn("pos", F.col("_number") - 1).drop("_number")


def snapshot_facts(valid: DataFrame, timestamp_id: Column, etl_run_id: Column, now: Column) -> DataFrame:
    """Snapshot fact rows of one run (append-only).

    ``stats_id = run * 2^32 + payload position``: unique, increasing with
    the run and, within a run, with the payload order (so "newest stats id"
    breaks ties the way the serial id did), and computed per row without a
    numbering job.  Ids are opaque and may have gaps.
    """
    run = etl_run_id.cast("long")
    return valid.select(
        (run * F.lit(1 << 32) + F.col("pos")).cast("long").alias("stats_id"),
        timestamp_id.cast("long").alias("timestamp_id"),
        run.alias("etl_run_id"),
        "app_id", *METRIC_INT_COLUMNS, "price", "initialprice", "discount",
        now.cast("timestamp_ntz").alias("created_at"),
    )


# ------------------------------------------------------------------- M4 / M5
def insert_only(batch: DataFrame, existing: DataFrame | None, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to append, rows that conflict with an existing key).

    ``ON CONFLICT DO NOTHING``: the batch must already be unique on ``key``
    (see ``first_seen``); existing rows are never touched.

    The existing keys are first reduced to those present in the batch with a
    left-semi join whose build side is the batch: when a run's batch is small
    AQE broadcasts it and the (large) history streams past without being
    shuffled; otherwise it stays a shuffle join.  The batch is then
    anti-joined against that small hit set.
    """
    if existing is None:
        return batch, batch.limit(0)
    hits = existing.select(*key).join(batch.select(*key), key, "left_semi")
    return batch.join(hits, key, "left_anti"), batch.join(hits, key, "left_semi")


# ------------------------------------------------------------------------- U1
def first_seen(df: DataFrame, key: list[str], order_cols: list[str], flag: str = "is_first") -> DataFrame:
    """Flag the first occurrence of each key in ``order_cols`` order.

    The first position per key is a (map-side pre-aggregated) minimum, joined
    back on the key, so a key with a huge number of copies is reduced in
    every task instead of being sent whole to one.
    """
    pos = F.struct(*[F.col(c) for c in order_cols])
    keyed = {c: f"_tm_k{i}" for i, c in enumerate(key)}
    first = df.groupBy(*[F.col(c).alias(a) for c, a in keyed.items()]).agg(F.min(pos).alias("_tm_first"))
    j = df.join(first, [F.col(c).eqNullSafe(F.col(a)) for c, a in keyed.items()], "inner")
    return j.select(*df.columns, (pos == F.col("_tm_first")).alias(flag))


def dedupe_first(df: DataFrame, key: list[str], order_cols: list[str]) -> DataFrame:
    """Keep only the first occurrence of each key (top-1 with a partial limit)."""
    from tidemark.operators.ranking import top_per_group
    return top_per_group(df, key, order_cols, k=1, out=None)
