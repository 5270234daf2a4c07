"""Checked queries: kept rolling counts, news as a stream, and checks that have something to find.

The checks run on a spoiled warehouse: keys, parents and values of the derived tables taken away by a filter, the same
on both sides, so that every kind of violation occurs.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.parse import ntz_lit
from tidemark.operators import checks, dims
from tidemark.plans import mart_sql as S
from tidemark.plans import appstate, marts, rolling
from tidemark.plans.catalog import register
from tidemark.plans.catalog_etl import INGEST_PAGE, NOW_SQL, SPLIT, SPLIT_SQL, _now, _tags_of
from tidemark.session import checkpoint_dir
from tidemark.sources.adapter import ORIGIN, ORIGIN_SQL, read_table, warehouse_from_driver, with_adapter
from tidemark.sources.keyhistory import KeyHistory
from tidemark.sources.store import Store
from tidemark.warehouse import Warehouse


# ------------------------------------------------------- V2 kept in additive parts
@register("rolling_incremental", with_adapter(S.chain(S.V2_ALL) + " SELECT * FROM q_v2"), "V2 A1 J5 F6")
def q_rolling_incremental(spark, sf_dir):
    """The runs' news handed over in three steps, late news included: each step reads its own news and the kept parts."""
    wh = warehouse_from_driver(spark, sf_dir)
    anchors = rolling._anchors(wh)
    # a news row comes with the third that its run or, if late, its id's remainder names
    top = max((r for r, _ in anchors), default=0)
    step = F.least(F.lit(2), F.floor(F.col("etl_run_id") * 3 / F.lit(top + 1)) + F.when(F.expr("CAST(update_id AS BIGINT) % 5 = 0"), 1).otherwise(0))
    news = wh.fact_news.withColumn("_step", step)
    parts, seen = rolling.Parts.empty(spark), set()
    for k in range(3):
        new = {r for r, _ in anchors if min(2, r * 3 // (top + 1)) == k}
        known = [x for x in anchors if x[0] in seen | new]
        mine = news.filter(F.col("_step") == k).drop("_step")
        parts, seen = parts.plus(rolling.parts_of(wh, mine, known, new, parts)), seen | new
    return rolling.counts(parts, wh)


# ----------------------------------------- V8, V9, A3 from what each run leaves behind
def _in_steps(wh: Warehouse):
    """(deltas, state) after the runs are handed over in three steps, each from the state before it."""
    rows = appstate.run_rows(wh)
    runs = wh.dim_etl_run.select("etl_run_id", F.row_number().over(Window.orderBy("started_at", "etl_run_id")).alias("_n"))
    third = F.ceil(F.col("_n") * 3 / F.lit(max(wh.dim_etl_run.count(), 1)))
    rows = rows.join(runs.select(F.col("etl_run_id").alias("run_id"), third.alias("_third")), "run_id")
    deltas, state = appstate.first_step(rows.filter("_third = 1").drop("_third"))
    for k in (2, 3):
        more, state = appstate.step(state, rows.filter(F.col("_third") == k).drop("_third"))
        deltas = deltas.unionByName(more)
    return deltas, state


@register("changes_incremental", with_adapter(S.chain(S.V1, S.V2_ALL, S.V3, S.V8) + " SELECT * FROM q_v8"), "V8 W4 T1")
def q_changes_incremental(spark, sf_dir):
    wh = warehouse_from_driver(spark, sf_dir)
    return appstate.changes_of(_in_steps(wh)[0], marts.news_rolling_asof(wh), wh.dim_app)


@register("latest_incremental", with_adapter(S.chain(S.V1, S.V2_ALL, S.V3, S.V9) + " SELECT * FROM q_v9"), "V9 W3")
def q_latest_incremental(spark, sf_dir):
    wh = warehouse_from_driver(spark, sf_dir)
    return appstate.latest_of(_in_steps(wh)[1], marts.news_rolling_asof(wh), wh.dim_app)


@register("watermark_incremental", with_adapter("""
    SELECT n.app_id, max(t.ts) AS latest_ts FROM w_fact_news n JOIN w_dim_timestamp t ON t.timestamp_id = n.timestamp_id
    GROUP BY n.app_id"""), "A3 J11 F2")
def q_watermark_incremental(spark, sf_dir):
    """Marks of each run's news, then their maxima."""
    wh = warehouse_from_driver(spark, sf_dir)
    of_run = wh.fact_news.select("app_id", "timestamp_id", "etl_run_id").groupBy("etl_run_id", "app_id").agg(F.max("timestamp_id").alias("at"))
    return appstate.watermark_of(of_run)


# ------------------------------------------------------- landed news as a stream
@register("news_stream", f"""
    WITH good AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_custkey IN (SELECT user_id FROM events))
    SELECT user_id::INTEGER AS app_id, event_id::VARCHAR AS update_id, epoch_us(date_trunc('second', ts)) AS timestamp_id,
           CASE WHEN ts < {SPLIT_SQL} THEN 2 ELSE 3 END::BIGINT AS etl_run_id, 'title ' || event_id AS title, props AS content_raw,
           event_type AS author
    FROM events JOIN good ON c_custkey = user_id WHERE event_type IN ('purchase', 'signup')
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, 'runs', count(*)::VARCHAR, NULL FROM (VALUES (1), (2), (3)) AS r(n)""",
          "S2 I5 U1 M4 M5")
def q_news_stream(spark, sf_dir):
    """A snapshot load, then news as they land: the older pages, all pages (copies of the older ones among them),
    and a call with nothing new.  Rows of the facts with their content, and the number of runs."""
    from tidemark.jobs import run_load
    from tidemark.sources.landing import news_pages_from_driver, snapshot_rows_from_driver, write_jsonl
    from tidemark.sources.store import Store
    from tidemark.streaming.news_stream import load_news_available_now

    root = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-news-{uuid.uuid4().hex}"
    snap = write_jsonl(snapshot_rows_from_driver(spark, sf_dir, None), f"{root}/landing/snapshot")
    run_load(spark, f"{root}/store", snap, None, "initial", run_ts=SPLIT)
    for pages in (news_pages_from_driver(spark, sf_dir, INGEST_PAGE, until=SPLIT), news_pages_from_driver(spark, sf_dir, INGEST_PAGE), None):
        if pages is not None:
            pages.write.mode("append").json(f"{root}/landing/news")
        load_news_available_now(spark, f"{root}/landing/news", f"{root}/store")
    wh = Store(spark, f"{root}/store").load()
    rows = wh.fact_news.join(wh.dim_update_content, ["app_id", "update_id"]).select(
        "app_id", "update_id", "timestamp_id", "etl_run_id", "title", "content_raw", "author")
    runs = wh.dim_etl_run.filter("status = 'success'").agg(F.count("*").cast("string").alias("content_raw")) \
        .withColumn("title", F.lit("runs"))
    return rows.unionByName(runs, allowMissingColumns=True)


# ------------------------------------------------------- checks with something to find
#: Table -> (columns replaced, rows kept, rows added) as SQL that both engines read.
SPOILED: dict[str, tuple[dict[str, str], str, str | None]] = {
    "dim_timestamp": ({}, "timestamp_id % 3 <> 0", "timestamp_id % 17 = 1"),
    "dim_etl_run": ({}, "etl_run_id % 10 <> 0", None),
    "dim_app": ({"app_name": "CASE WHEN app_id % 9 = 0 THEN NULL ELSE app_name END"}, "app_id % 4 <> 0", "app_id % 6 = 1"),
    "dim_update_typ": ({}, "update_type_id % 5 <> 0", "update_type_id % 2 = 1"),
    "dim_update_content": ({}, "CAST(update_id AS BIGINT) % 4 <> 0", "CAST(update_id AS BIGINT) % 13 = 1"),
    "fact_news": ({"timestamp_id": "CASE WHEN CAST(update_id AS BIGINT) % 7 = 0 THEN NULL ELSE timestamp_id END",
                   "title": "CASE WHEN CAST(update_id AS BIGINT) % 19 = 0 THEN NULL ELSE title END"},
                  "CAST(update_id AS BIGINT) % 23 <> 0", "CAST(update_id AS BIGINT) % 11 = 0"),
    "fact_steamspy_stats": ({"app_id": "CASE WHEN stats_id % 5 = 0 THEN NULL ELSE app_id END",
                             "owners_max": "CASE WHEN stats_id % 8 = 0 THEN owners_min - 1 ELSE owners_max END"},
                            "stats_id % 29 <> 0", "stats_id % 31 = 0"),
}


def _columns(name: str) -> str:
    replaced = SPOILED[name][0]
    return ", ".join(f"{replaced[f.name]} AS {f.name}" if f.name in replaced else f.name for f in schemas.TABLES[name].fields)


def spoiled(wh: Warehouse) -> Warehouse:
    frames = {}
    for name, (_, kept, added) in SPOILED.items():
        df = getattr(wh, name)
        keep, plain = df.filter(kept), [f.name for f in schemas.TABLES[name].fields]
        both = keep.unionAll(keep.filter(added)) if added else keep
        frames[name] = both.selectExpr(*[f"{SPOILED[name][0][c]} AS {c}" if c in SPOILED[name][0] else c for c in plain])
    return wh.with_tables(**frames)


def _spoiled_sql(body: str) -> str:
    tables = []
    for name, (_, kept, added) in SPOILED.items():
        more = f" UNION ALL SELECT * FROM w_{name} WHERE ({kept}) AND ({added})" if added else ""
        tables.append(f"x_{name} AS (SELECT {_columns(name)} FROM (SELECT * FROM w_{name} WHERE {kept}{more}))")
    return with_adapter(", ".join(tables) + body)


def _constraints_sql() -> str:
    parts = []
    for name, cols in schemas.NOT_NULL.items():
        if cols:
            null = " OR ".join(f"{c} IS NULL" for c in cols)
            parts.append(f"SELECT 'not_null:{name}' AS \"check\", count(*) FILTER ({null}) AS violations, 0::BIGINT AS extra_rows FROM x_{name}")
    for kind, keys in (("pk", schemas.PRIMARY_KEYS), ("unique", schemas.UNIQUE_KEYS)):
        for name, key in keys.items():
            parts.append(f"SELECT '{kind}:{name}', count(*), coalesce(sum(n - 1), 0)::BIGINT FROM "
                         f"(SELECT count(*) AS n FROM x_{name} GROUP BY {', '.join(key)} HAVING count(*) > 1)")
    for child, ccols, parent, pcols in schemas.FOREIGN_KEYS:
        known = " AND ".join(f"c.{a} IS NOT NULL" for a in ccols)
        same = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(ccols, pcols, strict=True))
        parts.append(f"SELECT 'fk:{child}->{parent}:{','.join(ccols)}', count(*), 0 FROM x_{child} c "
                     f"WHERE {known} AND NOT EXISTS (SELECT 1 FROM x_{parent} p WHERE {same})")
    parts.append("SELECT 'owners_check', count(*) FILTER (owners_min > owners_max), 0 FROM x_fact_steamspy_stats")
    return " " + " UNION ALL ".join(parts)


@register("constraint_report_spoiled", _spoiled_sql(_constraints_sql()), "C1 C2 C3 C4 F7 F8 J9 A5")
def q_constraint_report_spoiled(spark, sf_dir):
    return checks.constraint_report(spoiled(warehouse_from_driver(spark, sf_dir)))


@register("smoke_spoiled", _spoiled_sql("""
    SELECT 'fact_news_null_keys' AS "check", count(*) FILTER (app_id IS NULL OR update_id IS NULL
           OR timestamp_id IS NULL OR etl_run_id IS NULL) AS violations FROM x_fact_news
    UNION ALL SELECT 'fact_steamspy_null_keys', count(*) FILTER (app_id IS NULL OR timestamp_id IS NULL OR etl_run_id IS NULL)
      FROM x_fact_steamspy_stats
    UNION ALL SELECT 'fact_news_orphan_content', count(*) FROM x_fact_news n
      WHERE NOT EXISTS (SELECT 1 FROM x_dim_update_content c WHERE c.app_id = n.app_id AND c.update_id = n.update_id)
    UNION ALL SELECT 'fact_news_orphan_timestamp', count(*) FROM x_fact_news n
      WHERE NOT EXISTS (SELECT 1 FROM x_dim_timestamp t WHERE t.timestamp_id = n.timestamp_id)
    UNION ALL SELECT 'fact_steamspy_orphan_timestamp', count(*) FROM x_fact_steamspy_stats s
      WHERE NOT EXISTS (SELECT 1 FROM x_dim_timestamp t WHERE t.timestamp_id = s.timestamp_id)"""), "K2 K3 A5 A6 F7 F8 J9")
def q_smoke_spoiled(spark, sf_dir):
    wh = spoiled(warehouse_from_driver(spark, sf_dir))
    return checks.smoke_null_keys(wh).unionByName(checks.smoke_orphans(wh))


_TAG = "'k' || json_extract_string(props, '$.k')"


@register("tag_upsert_new", f"""
    WITH old AS (
        SELECT (row_number() OVER (ORDER BY type_name))::INTEGER AS update_type_id, type_name, {ORIGIN_SQL} AS updated_at
        FROM (SELECT DISTINCT {_TAG} AS type_name FROM events WHERE event_type = 'view') WHERE ascii(right(type_name, 1)) % 3 = 0),
    batch AS (SELECT DISTINCT {_TAG} AS type_name FROM events WHERE event_type = 'purchase'),
    fresh AS (
        SELECT ((SELECT coalesce(max(update_type_id), 0) FROM old) + row_number() OVER (ORDER BY type_name))::INTEGER AS update_type_id,
               type_name, {NOW_SQL} AS updated_at
        FROM batch WHERE type_name NOT IN (SELECT type_name FROM old))
    SELECT o.update_type_id, o.type_name, CASE WHEN b.type_name IS NOT NULL THEN {NOW_SQL} ELSE o.updated_at END AS updated_at
    FROM old o LEFT JOIN batch b ON b.type_name = o.type_name
    UNION ALL SELECT * FROM fresh""", "A7 M3 M8")
def q_tag_upsert_new(spark, sf_dir):
    """Tags of which two thirds are not in the dimension yet."""
    ev = read_table(spark, sf_dir, "events")
    known = _tags_of(ev, "view").filter(F.ascii(F.right("type_name", F.lit(1))) % 3 == 0)
    return dims.assign_type_ids(_tags_of(ev, "purchase"), dims.assign_type_ids(known, None, ntz_lit(ORIGIN)), _now())


# ------------------------------------------------------- runs that failed
@register("overview_failed_runs", with_adapter(S.chain(S.V1, S.V2_ALL, S.V3) + """
    SELECT q_v3.* FROM q_v3 JOIN w_dim_etl_run USING (etl_run_id) WHERE status = 'failed'"""), "V3 J3 J4 F4")
def q_overview_failed_runs(spark, sf_dir):
    """What the overview shows of failed runs when their rows are in the tables, as after an import: a store written
    by the jobs hides them (``Store.load``)."""
    wh = replace(warehouse_from_driver(spark, sf_dir), micros_ids=False)
    failed = wh.dim_etl_run.filter(F.col("status") == "failed").select("etl_run_id")
    return marts.overview_by_run(wh).join(failed, "etl_run_id", "left_semi")


# ------------------------------------------- M4, M5, U1 against bucketed keys
@register("insert_only_bucketed", """
    SELECT DISTINCT CAST(l_linenumber AS INTEGER) AS app_id, CAST(l_orderkey AS VARCHAR) AS update_id
    FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem e WHERE e.l_orderkey = l.l_orderkey AND e.l_linenumber = l.l_linenumber
                      AND e.l_returnflag IN ('R', 'A'))
    """, "U1 M4 M5")
def q_insert_only_bucketed(spark, sf_dir):
    """The keys of two earlier runs are kept bucketed; a third batch of all keys is merged with them, without a shuffle of theirs."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("int").alias("app_id"), F.col("l_orderkey").cast("string").alias("update_id"), "l_returnflag")
    store = Store(spark, f"{checkpoint_dir(spark).rstrip('/')}/tidemark-keys-{uuid.uuid4().hex}")
    history = KeyHistory(store, "dim_update_content", buckets=16, broadcast_keys=0)
    for run, flag in enumerate("RA", start=1):
        seen = lines.where(F.col("l_returnflag") == flag).select("app_id", "update_id").distinct()
        history.add(seen.withColumn("etl_run_id", F.lit(run)), [run])
        store.append_run_state(run, "incremental", "success", _now_value(run), _now_value(run), _now_value(run), None)
    return history.new_rows(lines.select("app_id", "update_id").distinct())


def _now_value(day: int) -> datetime:
    return datetime(2024, 1, day)
