"""Landing-zone sources (S1, S2) and a writer that lands data derived from the
driver tables (used by tests and the benchmark; nothing is made up).

Snapshot source: JSON lines, one app per line, every value as text plus its
payload position ``pos``; or one JSON object keyed by app id (the raw API
shape), cut at its braces (``sources/rawobject.py``).  News source: JSON lines, one fetched page
per line with the fetch envelope (app_id, page, enddate, http_status).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.parse import ntz_lit
from tidemark.operators.ranking import split_row_number
from tidemark.sources import rawobject
from tidemark.sources.adapter import NEWS_TYPES, read_table, run_id_of

_SNAPSHOT_VALUE = "struct<" + ",".join(f"`{f}`:string" for f in schemas.SNAPSHOT_FIELDS) + ">"


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """S1, JSON-lines form (splittable; the form to land at scale)."""
    return spark.read.schema(schemas.SNAPSHOT_LINE).option("mode", "PERMISSIVE").json(path)


def read_snapshot_object(spark: SparkSession, path: str) -> DataFrame:
    """S1, raw form: one JSON object ``{"<appid>": {...}, ...}`` per file, each read by several tasks.

    A repeated key keeps its first position and its last value (what a JSON
    object decoder does).
    """
    return rawobject.members(spark, path, _SNAPSHOT_VALUE).select("pos", "v.*")


def read_news_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed news pages with their fetch envelope; a line that does not parse keeps its text."""
    schema = T.StructType([*schemas.NEWS_PAGE.fields, T.StructField(schemas.CORRUPT, T.StringType(), True)])
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path)


# --------------------------------------------------------- derived landings
def snapshot_rows_from_driver(spark: SparkSession, sf_dir: str, run_id: int | None) -> DataFrame:
    """Snapshot payload of one run: one line per customer whose events fall in
    the 12-hour slot ``run_id`` (all events when ``None``), metrics from those
    events, as text.  Customers with a negative balance get a reversed owners
    range (rejected by the CHECK rule)."""
    ev = read_table(spark, sf_dir, "events")
    if run_id is not None:
        ev = ev.withColumn("run_id", run_id_of(F.col("ts"))).filter(F.col("run_id") == run_id)
    agg = ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"),
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.max("value").alias("top"))
    cust = read_table(spark, sf_dir, "customer")
    j = agg.join(cust, agg.user_id == cust.c_custkey)
    owners_lo = (F.col("n") * 1000).cast("long")
    owners_hi = (F.col("n") * 2000).cast("long")
    fmt = lambda c: F.format_number(c, 0)  # noqa: E731  "12,000"
    owners = F.when(F.col("c_acctbal") < 0, F.concat(fmt(owners_hi), F.lit(" .. "), fmt(owners_lo))) \
        .otherwise(F.concat(fmt(owners_lo), F.lit(" .. "), fmt(owners_hi)))
    return j.select(
        F.col("c_custkey").cast("long").alias("pos"),
        F.col("c_custkey").cast("string").alias("appid"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("developer"),
        F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("publisher"),
        (F.col("views") * 10).cast("string").alias("positive"),
        F.col("errors").cast("string").alias("negative"),
        F.lit("0").alias("userscore"),
        owners.alias("owners"),
        F.floor(F.col("total")).cast("string").alias("average_forever"),
        F.col("n").cast("string").alias("average_2weeks"),
        F.floor(F.col("top")).cast("string").alias("median_forever"),
        F.col("views").cast("string").alias("median_2weeks"),
        F.round(F.col("top") * 100).cast("long").cast("string").alias("price"),
        F.round(F.col("top") * 200).cast("long").cast("string").alias("initialprice"),
        (F.col("errors") * 5).cast("string").alias("discount"),
        F.round(F.col("total") * 100).cast("long").cast("string").alias("ccu"),
    )


def news_pages_from_driver(spark: SparkSession, sf_dir: str, page_size: int = 100,
                           until=None) -> DataFrame:
    """News pages per customer from purchase / signup events (newest first,
    ``page_size`` items per page, ``count`` = the app's item total), as the
    fetcher would land them.  ``until`` limits to events before a timestamp
    (to land an older state for an incremental test)."""
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin(NEWS_TYPES))
    if until is not None:
        ev = ev.filter(F.col("ts") < ntz_lit(until))
    items = ev.select(
        F.col("user_id").cast("int").alias("app_id"), "ts", "event_id",
        F.struct(
            F.col("event_id").cast("string").alias("gid"),
            F.concat(F.lit("title "), F.col("event_id").cast("string")).alias("title"),
            F.concat(F.lit("https://example.com/news/"), F.col("event_id").cast("string")).alias("url"),
            (F.col("value") > 50).alias("is_external_url"),
            F.col("event_type").alias("author"),
            F.col("props").alias("contents"),
            F.lit("label").alias("feedlabel"),
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("date"),
            F.lit("feed").alias("feedname"),
            (F.col("event_id") % 2).cast("int").alias("feed_type"),
            F.col("user_id").cast("int").alias("appid"),
            F.array(F.concat(F.lit("k"), F.get_json_object("props", "$.k"))).alias("tags"),
        ).alias("item"))
    ranked = split_row_number(items, ["app_id"], [F.col("ts").desc(), F.col("event_id").desc()], out="seq")
    ranked = ranked.withColumn("page", ((F.col("seq") - 1) / page_size).cast("int") + 1)
    totals = items.groupBy("app_id").agg(F.count(F.lit(1)).cast("int").alias("count"))     # from the events: unranked, one column
    pages = ranked.groupBy("app_id", "page").agg(
        F.sort_array(F.collect_list(F.struct("seq", "item"))).alias("rows"),
        F.min(F.col("item.date")).alias("oldest"))
    # request enddate of page p = oldest item date of page p-1, minus one (equi-join, no window)
    prev = pages.select("app_id", (F.col("page") + 1).alias("page"), (F.col("oldest") - 1).alias("enddate"))
    return pages.join(totals, "app_id").join(prev, ["app_id", "page"], "left").select(
        "app_id", "page", "enddate", F.lit(200).alias("http_status"),
        F.struct(F.col("count"), F.transform("rows", lambda r: r["item"]).alias("newsitems")).alias("appnews"))


def as_landed(pages: DataFrame) -> DataFrame:
    """Give derived pages the landed shape (``NEWS_PAGE``, ``date`` as VARIANT)
    without a round trip through files."""
    return pages.select(F.from_json(F.to_json(F.struct("*")), schemas.NEWS_PAGE).alias("p")).select("p.*")


def write_jsonl(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path
