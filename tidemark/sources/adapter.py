"""Shape the driver's generic tables into the warehouse (deterministic).

The checks run each mart against DuckDB on the same parquet files, so the
mapping is written twice: here as DataFrame code (what the marts use) and in
``ADAPTER_SQL`` as the DuckDB twin used by the oracle queries.

Mapping (all derived from the input rows, so the work grows with them):

* runs        -- one load run per 12-hour slot of ``events.ts`` that has
                 events; started at the slot start, ended at the slot's last
                 event; a run whose last event is an ``error`` failed; the
                 first slot is the ``initial`` run.
* dim_timestamp -- distinct ``events.ts``; id = epoch microseconds.
* dim_app     -- ``customer`` (app id = customer key).
* snapshots   -- ``events`` of type view / click / error, app = ``user_id``,
                 metrics derived from ``value`` and ``event_id``.
* news        -- ``events`` of type purchase / signup, id = ``event_id`` as
                 text, tag = ``"k" || props.k``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parse import date_parts, ntz_lit, ts_id
from tidemark.warehouse import Warehouse

ORIGIN = datetime(2024, 1, 1)
ORIGIN_SQL = "TIMESTAMP '2024-01-01 00:00:00'"
SLOT_HOURS = 12
SNAPSHOT_TYPES = ["view", "click", "error"]
NEWS_TYPES = ["purchase", "signup"]

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_id_of(ts) -> F.Column:
    """12-hour slot number of a timestamp, counted from ORIGIN (first slot = 1)."""
    origin_us = int((ORIGIN - datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    slot_us = SLOT_HOURS * 3600 * 1_000_000
    return (F.floor((ts_id(ts) - F.lit(origin_us)) / F.lit(slot_us)) + 1).cast("long")


def slot_start(run_id) -> F.Column:
    return ntz_lit(ORIGIN) + F.make_dt_interval(
        hours=((run_id - 1) * SLOT_HOURS).cast("int"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").withColumn("run_id", run_id_of(F.col("ts")))


def runs_from_events(ev: DataFrame) -> DataFrame:
    per_run = ev.groupBy("run_id").agg(
        F.max("ts").alias("ended_at"),
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"),
    )
    first = F.broadcast(per_run.agg(F.min("run_id").alias("first_run")))  # one row
    return per_run.crossJoin(first).select(
        F.col("run_id").alias("etl_run_id"),
        F.when(F.col("run_id") == F.col("first_run"), "initial").otherwise("incremental").alias("run_type"),
        F.when(F.col("last_type") == "error", "failed").otherwise("success").alias("status"),
        slot_start(F.col("run_id")).alias("started_at"),
        "ended_at",
        slot_start(F.col("run_id")).alias("created_at"),
        F.col("ended_at").alias("updated_at"),
    )


def timestamps_from_events(ev: DataFrame) -> DataFrame:
    parts = date_parts("ts")
    return (ev.select("ts").distinct()
            .select(ts_id("ts").alias("timestamp_id"), "ts", *[c.alias(n) for n, c in parts.items()]))


def apps_from_customer(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("int").alias("app_id"),
        F.col("c_name").alias("app_name"),
        F.col("c_mktsegment").alias("developer"),
        F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("publisher"),
        ntz_lit(ORIGIN).alias("updated_at"),
    )


def stats_from_events(ev: DataFrame) -> DataFrame:
    v, eid = F.col("value"), F.col("event_id")
    owners_min = F.floor(v).cast("int") * F.lit(1000)
    return ev.filter(F.col("event_type").isin(SNAPSHOT_TYPES)).select(
        eid.alias("stats_id"),
        ts_id("ts").alias("timestamp_id"),
        F.col("run_id").alias("etl_run_id"),
        F.col("user_id").cast("int").alias("app_id"),
        owners_min.alias("owners_min"),
        (owners_min + F.lit(20000)).alias("owners_max"),
        F.round(v * 100).cast("int").alias("ccu"),
        (eid % 1000).cast("int").alias("positive"),
        (eid % 97).cast("int").alias("negative"),
        (eid % 101).cast("int").alias("userscore"),
        F.floor(v * 10).cast("int").alias("average_forever"),
        F.floor(v * 5).cast("int").alias("median_forever"),
        (eid % 60).cast("int").alias("average_2weeks"),
        (eid % 30).cast("int").alias("median_2weeks"),
        v.cast("decimal(12,2)").alias("price"),
        (v * 2).cast("decimal(12,2)").alias("initialprice"),
        (eid % 100).cast("decimal(5,2)").alias("discount"),
        F.col("ts").alias("created_at"),
    )


def news_source(ev: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return (ev.filter(F.col("event_type").isin(NEWS_TYPES))
            .withColumn("tag", F.concat(F.lit("k"), k)).withColumn("k", k.try_cast("int")))


def content_from_news(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("user_id").cast("int").alias("app_id"),
        F.col("event_id").cast("string").alias("update_id"),
        F.col("props").alias("content_raw"),
        F.col("event_type").alias("author"),
        F.lit("label").alias("feedlabel"),
        F.lit("feed").alias("feedname"),
        (F.col("event_id") % 2).cast("int").alias("feedtype"),
        (F.col("value") > 50).alias("is_external_url"),
        F.to_json(F.array("tag")).alias("tags_raw"),
        F.col("ts").alias("created_at"),
    )


def facts_from_news(src: DataFrame) -> DataFrame:
    # the tag id is a function of the tag (see types_from_news): no lookup join
    return src.select(
        F.col("user_id").cast("int").alias("app_id"),
        F.col("event_id").cast("string").alias("update_id"),
        ts_id("ts").alias("timestamp_id"),
        F.col("run_id").alias("etl_run_id"),
        F.when(F.col("tag").isNotNull(), F.col("k") + 1).cast("int").alias("update_type_id"),
        F.concat(F.lit("title "), F.col("event_id").cast("string")).alias("title"),
        F.concat(F.lit("https://example.com/news/"), F.col("event_id").cast("string")).alias("url"),
        F.col("ts").alias("created_at"),
    )


def types_from_news(src: DataFrame) -> DataFrame:
    """Tag dimension: one row per tag ``k<n>`` with id n + 1 (fixed by the tag,
    so building the adapter needs no numbering job)."""
    return (src.select("tag", "k").filter(F.col("tag").isNotNull()).distinct()
            .select((F.col("k") + 1).cast("int").alias("update_type_id"), F.col("tag").alias("type_name"),
                    ntz_lit(ORIGIN).alias("updated_at")))


def warehouse_from_driver(spark: SparkSession, sf_dir: str) -> Warehouse:
    ev = _events(spark, sf_dir)
    src = news_source(ev)
    typ = types_from_news(src)
    return Warehouse(
        dim_timestamp=timestamps_from_events(ev),
        dim_etl_run=runs_from_events(ev),
        dim_app=apps_from_customer(read_table(spark, sf_dir, "customer")),
        dim_update_typ=typ,
        dim_update_content=content_from_news(src),
        fact_news=facts_from_news(src),
        fact_steamspy_stats=stats_from_events(ev),
        micros_ids=True,
    )


# ----------------------------------------------------------------- SQL twin
ADAPTER_SQL = f"""
w_events AS (
    SELECT *, (floor((epoch_us(ts) - epoch_us({ORIGIN_SQL})) / 43200000000.0)::BIGINT + 1) AS run_id
    FROM events
),
w_dim_etl_run AS (
    SELECT run_id AS etl_run_id,
           CASE WHEN run_id = (SELECT min(run_id) FROM w_events) THEN 'initial' ELSE 'incremental' END AS run_type,
           CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'failed' ELSE 'success' END AS status,
           {ORIGIN_SQL} + to_hours(((run_id - 1) * 12)::BIGINT) AS started_at,
           max(ts) AS ended_at,
           {ORIGIN_SQL} + to_hours(((run_id - 1) * 12)::BIGINT) AS created_at,
           max(ts) AS updated_at
    FROM w_events GROUP BY run_id
),
w_dim_timestamp AS (
    SELECT epoch_us(ts) AS timestamp_id, ts, ts::DATE AS date, year(ts)::INTEGER AS year,
           month(ts)::INTEGER AS month, day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour,
           isodow(ts)::INTEGER AS weekday
    FROM (SELECT DISTINCT ts FROM events)
),
w_dim_app AS (
    SELECT c_custkey::INTEGER AS app_id, c_name AS app_name, c_mktsegment AS developer,
           'nation-' || c_nationkey::VARCHAR AS publisher, {ORIGIN_SQL} AS updated_at
    FROM customer
),
w_fact_steamspy_stats AS (
    SELECT event_id AS stats_id, epoch_us(ts) AS timestamp_id, run_id AS etl_run_id,
           user_id::INTEGER AS app_id,
           floor(value)::INTEGER * 1000 AS owners_min,
           floor(value)::INTEGER * 1000 + 20000 AS owners_max,
           round(value * 100)::INTEGER AS ccu,
           (event_id % 1000)::INTEGER AS positive,
           (event_id % 97)::INTEGER AS negative,
           (event_id % 101)::INTEGER AS userscore,
           floor(value * 10)::INTEGER AS average_forever,
           floor(value * 5)::INTEGER AS median_forever,
           (event_id % 60)::INTEGER AS average_2weeks,
           (event_id % 30)::INTEGER AS median_2weeks,
           value::DECIMAL(12,2) AS price,
           (value * 2)::DECIMAL(12,2) AS initialprice,
           (event_id % 100)::DECIMAL(5,2) AS discount,
           ts AS created_at
    FROM w_events WHERE event_type IN ('view', 'click', 'error')
),
w_news_src AS (
    SELECT *, 'k' || json_extract_string(props, '$.k') AS tag,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM w_events WHERE event_type IN ('purchase', 'signup')
),
w_dim_update_typ AS (
    SELECT (k + 1)::INTEGER AS update_type_id, tag AS type_name, {ORIGIN_SQL} AS updated_at
    FROM (SELECT DISTINCT tag, k FROM w_news_src WHERE tag IS NOT NULL)
),
w_dim_update_content AS (
    SELECT user_id::INTEGER AS app_id, event_id::VARCHAR AS update_id, props AS content_raw,
           event_type AS author, 'label' AS feedlabel, 'feed' AS feedname,
           (event_id % 2)::INTEGER AS feedtype, value > 50 AS is_external_url,
           to_json([tag])::VARCHAR AS tags_raw, ts AS created_at
    FROM w_news_src
),
w_fact_news AS (
    SELECT n.user_id::INTEGER AS app_id, n.event_id::VARCHAR AS update_id,
           epoch_us(n.ts) AS timestamp_id, n.run_id AS etl_run_id, t.update_type_id,
           'title ' || n.event_id::VARCHAR AS title,
           'https://example.com/news/' || n.event_id::VARCHAR AS url, n.ts AS created_at
    FROM w_news_src n LEFT JOIN w_dim_update_typ t ON t.type_name = n.tag
)
"""


def with_adapter(body: str) -> str:
    """Prefix a query over the ``w_*`` tables with the adapter CTEs.

    ``body`` is either a plain ``SELECT`` or further CTE definitions followed
    by the final ``SELECT``.
    """
    body = body.strip()
    joiner = "\n" if body.upper().startswith("SELECT") else ",\n"
    return "WITH " + ADAPTER_SQL.strip() + joiner + body
