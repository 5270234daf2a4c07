"""Explicit schemas of the seven warehouse tables and the two landing sources.

All timestamps are UTC wall-clock values stored as TIMESTAMP_NTZ, so no
comparison in the marts depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

TS = T.TimestampNTZType()

# ----------------------------------------------------------------- fixed values
# Names that must equal the reference's so that existing queries and dashboards
# keep working unchanged: the nine views and their metric columns.
VIEW_NAMES = ["vw_app_metrics_by_etl_run", "vw_app_news_7d_30d_asof_etl_run", "vw_app_overview_by_etl_run",
              "vw_app_overview_latest_etl_run", "vw_app_news_latest", "vw_app_news_daily",
              "vw_app_timeseries_by_etl_run", "vw_app_changes_by_etl_run", "vw_app_overview_latest_by_app"]
# The metric columns of the views, and those with a difference to the previous run, in the views' order.
METRICS = ["ccu", "owners_min", "owners_max", "userscore", "positive", "negative", "average_forever", "median_forever",
           "average_2weeks", "median_2weeks", "price", "initialprice", "discount"]
DELTA_COLUMNS = ["ccu", "owners_min", "owners_max", "positive", "negative", "userscore", "price", "initialprice",
                 "discount", "news_count_7d", "news_count_30d"]

DIM_TIMESTAMP = T.StructType([
    T.StructField("timestamp_id", T.LongType(), False),
    T.StructField("ts", TS, False),
    T.StructField("date", T.DateType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
    T.StructField("hour", T.IntegerType(), True),
    T.StructField("weekday", T.IntegerType(), True),
])

DIM_ETL_RUN = T.StructType([
    T.StructField("etl_run_id", T.LongType(), False),
    T.StructField("run_type", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("started_at", TS, False),
    T.StructField("ended_at", TS, True),
    T.StructField("created_at", TS, True),
    T.StructField("updated_at", TS, True),
])

DIM_APP = T.StructType([
    T.StructField("app_id", T.IntegerType(), False),
    T.StructField("app_name", T.StringType(), True),
    T.StructField("developer", T.StringType(), True),
    T.StructField("publisher", T.StringType(), True),
    T.StructField("updated_at", TS, True),
])

DIM_UPDATE_TYP = T.StructType([
    T.StructField("update_type_id", T.IntegerType(), False),
    T.StructField("type_name", T.StringType(), False),
    T.StructField("updated_at", TS, True),
])

DIM_UPDATE_CONTENT = T.StructType([
    T.StructField("app_id", T.IntegerType(), False),
    T.StructField("update_id", T.StringType(), False),
    T.StructField("content_raw", T.StringType(), True),
    T.StructField("author", T.StringType(), True),
    T.StructField("feedlabel", T.StringType(), True),
    T.StructField("feedname", T.StringType(), True),
    T.StructField("feedtype", T.IntegerType(), True),
    T.StructField("is_external_url", T.BooleanType(), True),
    T.StructField("tags_raw", T.StringType(), True),  # JSON array text
    T.StructField("created_at", TS, True),
])

FACT_NEWS = T.StructType([
    T.StructField("app_id", T.IntegerType(), False),
    T.StructField("update_id", T.StringType(), False),
    T.StructField("timestamp_id", T.LongType(), True),
    T.StructField("etl_run_id", T.LongType(), False),
    T.StructField("update_type_id", T.IntegerType(), True),
    T.StructField("title", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("created_at", TS, True),
])

METRIC_INT_COLUMNS = [
    "owners_min", "owners_max", "ccu", "positive", "negative", "userscore",
    "average_forever", "median_forever", "average_2weeks", "median_2weeks",
]

FACT_STEAMSPY_STATS = T.StructType(
    [
        T.StructField("stats_id", T.LongType(), False),
        T.StructField("timestamp_id", T.LongType(), False),
        T.StructField("etl_run_id", T.LongType(), False),
        T.StructField("app_id", T.IntegerType(), False),
    ]
    + [T.StructField(c, T.IntegerType(), True) for c in METRIC_INT_COLUMNS]
    + [
        T.StructField("price", T.DecimalType(12, 2), True),
        T.StructField("initialprice", T.DecimalType(12, 2), True),
        T.StructField("discount", T.DecimalType(5, 2), True),
        T.StructField("created_at", TS, True),
    ]
)

TABLES = {
    "dim_timestamp": DIM_TIMESTAMP,
    "dim_etl_run": DIM_ETL_RUN,
    "dim_app": DIM_APP,
    "dim_update_typ": DIM_UPDATE_TYP,
    "dim_update_content": DIM_UPDATE_CONTENT,
    "fact_news": FACT_NEWS,
    "fact_steamspy_stats": FACT_STEAMSPY_STATS,
}

# Primary / unique keys (C2) and foreign keys (C3): (child, child cols, parent, parent cols).
PRIMARY_KEYS = {
    "dim_timestamp": ["timestamp_id"],
    "dim_etl_run": ["etl_run_id"],
    "dim_app": ["app_id"],
    "dim_update_typ": ["update_type_id"],
    "dim_update_content": ["app_id", "update_id"],
    "fact_news": ["app_id", "update_id"],
    "fact_steamspy_stats": ["stats_id"],
}
UNIQUE_KEYS = {"dim_timestamp": ["ts"], "dim_update_typ": ["type_name"]}
FOREIGN_KEYS = [
    ("dim_update_content", ["app_id"], "dim_app", ["app_id"]),
    ("fact_news", ["app_id"], "dim_app", ["app_id"]),
    ("fact_news", ["timestamp_id"], "dim_timestamp", ["timestamp_id"]),
    ("fact_news", ["etl_run_id"], "dim_etl_run", ["etl_run_id"]),
    ("fact_news", ["update_type_id"], "dim_update_typ", ["update_type_id"]),
    ("fact_news", ["app_id", "update_id"], "dim_update_content", ["app_id", "update_id"]),
    ("fact_steamspy_stats", ["timestamp_id"], "dim_timestamp", ["timestamp_id"]),
    ("fact_steamspy_stats", ["etl_run_id"], "dim_etl_run", ["etl_run_id"]),
    ("fact_steamspy_stats", ["app_id"], "dim_app", ["app_id"]),
]
NOT_NULL = {name: [f.name for f in schema.fields if not f.nullable] for name, schema in TABLES.items()}

# ---------------------------------------------------------------- landing zone
# Snapshot source: one JSON object per app (JSON lines); every value read as
# text and typed by the parser so that bad values can be quarantined.
SNAPSHOT_FIELDS = [
    "appid", "name", "developer", "publisher", "positive", "negative", "userscore",
    "owners", "average_forever", "average_2weeks", "median_forever", "median_2weeks",
    "price", "initialprice", "discount", "ccu",
]
SNAPSHOT_LINE = T.StructType(
    [T.StructField("pos", T.LongType(), True)]
    + [T.StructField(f, T.StringType(), True) for f in SNAPSHOT_FIELDS]
)

NEWS_ITEM = T.StructType([
    T.StructField("gid", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("is_external_url", T.VariantType(), True),
    T.StructField("author", T.StringType(), True),
    T.StructField("contents", T.StringType(), True),
    T.StructField("feedlabel", T.StringType(), True),
    T.StructField("date", T.VariantType(), True),
    T.StructField("feedname", T.StringType(), True),
    T.StructField("feed_type", T.StringType(), True),   # typed later, so that a bad value rejects its item
    T.StructField("appid", T.IntegerType(), True),
    T.StructField("tags", T.ArrayType(T.StringType()), True),
])

# One landed news page: the response body plus the envelope the fetcher saw.
NEWS_PAGE = T.StructType([
    T.StructField("app_id", T.IntegerType(), True),
    T.StructField("page", T.IntegerType(), True),
    T.StructField("enddate", T.LongType(), True),
    T.StructField("http_status", T.IntegerType(), True),
    T.StructField("fetch_id", T.StringType(), True),   # optional: tells pages of different fetches apart
    T.StructField("appnews", T.StructType([
        T.StructField("count", T.StringType(), True),
        T.StructField("newsitems", T.ArrayType(NEWS_ITEM), True),
    ]), True),
])

CORRUPT = "_corrupt_record"  # what a landed line held that does not parse
