"""News pages: landed items, the per-app high watermark, item preparation and
per-app ingest counters.

The fetcher lands every response it got as one record (app, page sequence,
request ``enddate``, HTTP status, body).  ``landed_news`` is the load path: every
landed item counts.  ``walk_pages`` tells which prefix of the pages a paging loop
would have asked for; it answers that question only and decides no load.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.parse import (
    epoch_ok, epoch_to_ts, first_tag, parse_int_strict, tags_json, truthy, truthy_variant, ts_to_epoch,
)
from tidemark.operators.facts import dedupe_first, first_seen
from tidemark.operators.ranking import split_running_sum
from tidemark.schemas import CORRUPT


@dataclass(frozen=True)
class WalkParams:
    page_size: int = 100
    max_pages: int | None = None  # None / 0 = unlimited


INT_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def variant_kind(v: Column) -> Column:
    return F.call_function("schema_of_variant", v)


def explode_items(pages: DataFrame) -> DataFrame:
    """One row per landed item of a 200 page: (app_id, page, pos, item fields)."""
    ok = pages.filter((F.col("http_status") == 200) & F.col("app_id").isNotNull())
    return ok.select("app_id", "page", _fetch_id(pages), F.posexplode("appnews.newsitems").alias("pos", "it")).select(
        "app_id", "page", "fetch_id", "pos", "it.*")


def _fetch_id(pages: DataFrame) -> Column:
    return F.col("fetch_id") if "fetch_id" in pages.columns else F.lit(None).cast("string").alias("fetch_id")


def malformed_pages(pages: DataFrame) -> DataFrame:
    """Landed lines that do not parse or name no app: (app_id, page, reason, line)."""
    line = F.col(CORRUPT) if CORRUPT in pages.columns else F.lit(None).cast("string")
    reason = F.when(line.isNotNull(), "malformed_line").when(F.col("app_id").isNull(), "app_id")
    return pages.select("app_id", "page", reason.alias("reason"), line.alias("line")).filter(F.col("reason").isNotNull())


def unknown_app_pages(pages: DataFrame, apps: DataFrame) -> DataFrame:
    """Landed pages (or items) of apps that are not in ``apps``: a row like those of ``malformed_pages`` for each."""
    return pages.filter(F.col("app_id").isNotNull()).join(apps.select("app_id"), "app_id", "left_anti").select(
        "app_id", "page", F.lit("unknown_app").alias("reason"), F.lit(None).cast("string").alias("line"))


# -------------------------------------------------------------- the load path
def landed_news(pages: DataFrame, cutoffs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Every landed item that is new, and one row of counters per app.

    Items are all those of 200 responses, whatever their page held besides.  Of
    items that share (app, gid) the first by fetch, page and position stays; items
    without a gid stay all and are rejected when typed.  Items with an integer date
    at or before their app's watermark are left out.

    Counters: ``pages`` with items, ``fetched`` items kept, ``duplicates`` of a gid,
    ``total_expected`` (the first page's count), ``forbidden`` and
    ``rate_limited_hits`` responses, ``last_enddate``, and ``walk_status``
    (``failed`` if any response had another status).  They describe the fetch;
    they decide nothing.
    """
    kept = landed_items(pages, cutoffs)
    return kept, fetch_counters(pages, kept)


def landed_items(pages: DataFrame, cutoffs: DataFrame | None = None) -> DataFrame:
    """The items of ``landed_news``."""
    items = explode_items(pages)
    has_gid = F.coalesce(F.col("gid"), F.lit("")) != ""
    named = items.filter(has_gid)
    first = dedupe_first(named, ["app_id", "gid"], ["fetch_id", "page", "pos", "title", "url", "contents"])
    kept = first.unionByName(items.filter(~has_gid))
    if cutoffs is not None:
        is_int = F.coalesce(variant_kind(F.col("date")).isin(*INT_KINDS), F.lit(False))
        epoch = F.when(is_int, F.expr("try_variant_get(date, '$', 'bigint')"))
        kept = after_cutoff(kept.withColumn("_epoch", epoch), cutoffs, "_epoch").drop("_epoch")
    return kept


def fetch_counters(pages: DataFrame, kept: DataFrame, unique: DataFrame | None = None) -> DataFrame:
    """The counters of ``landed_news``; ``kept`` and ``unique`` may be held rows, so that the pages are not parsed again.

    ``kept``: a row for each item kept.  ``unique``: one for each (app, gid) that landed, before any cut-off; taken from
    the pages if not given.
    """
    if unique is None:
        unique = explode_items(pages).filter(F.coalesce(F.col("gid"), F.lit("")) != "").select("app_id", "gid").distinct()
    status, n_items = F.col("http_status"), F.size(F.coalesce(F.col("appnews.newsitems"), F.array()))
    count = F.col("appnews.count").try_cast("int")
    is_data = (status == 200) & (n_items > 0)
    meta = pages.filter(F.col("app_id").isNotNull()).groupBy("app_id").agg(
        F.count_if(is_data).alias("pages"),
        F.sum(F.when(is_data, F.size(F.filter("appnews.newsitems", lambda i: F.coalesce(i["gid"], F.lit("")) != "")))
              .otherwise(0)).cast("long").alias("_named"),
        F.min_by(F.when(status == 200, count), F.when((status == 200) & count.isNotNull(), F.col("page"))).alias("total_expected"),
        F.coalesce(F.max(status == 403), F.lit(False)).alias("forbidden"),
        F.count_if(status == 429).alias("rate_limited_hits"),
        F.max_by("enddate", "page").alias("last_enddate"),
        F.coalesce(F.max(~status.isin(200, 403, 429)), F.lit(False)).alias("_failed"))
    unique = unique.groupBy("app_id").agg(F.count(F.lit(1)).alias("_unique"))
    fetched = kept.groupBy("app_id").agg(F.count(F.lit(1)).alias("fetched"))
    meta = meta.join(unique, "app_id", "left").join(fetched, "app_id", "left").fillna(0, ["_unique", "fetched"])
    return meta.select(
        "app_id", "pages", "fetched", F.col("fetched").alias("unique_total"),
        (F.col("_named") - F.col("_unique")).alias("duplicates"), "total_expected", "forbidden", "rate_limited_hits",
        "last_enddate", F.when(F.col("_failed"), "failed").otherwise("ok").alias("walk_status"))


# ------------------------------------------------------------------------- A3
def latest_news_ts(fact_news: DataFrame, dim_timestamp: DataFrame, micros_ids: bool = False) -> DataFrame:
    """High watermark per app: newest news timestamp (app_id, latest_ts).

    With epoch-microsecond ids the maximum is taken on the id itself (a
    partial aggregate per app, no join)."""
    news = fact_news.select("app_id", "timestamp_id")
    if micros_ids:
        return (news.groupBy("app_id").agg(F.max("timestamp_id").alias("_m"))
                .select("app_id", F.timestamp_micros("_m").cast("timestamp_ntz").alias("latest_ts")))
    return (news.join(dim_timestamp.select("timestamp_id", "ts"), "timestamp_id")
            .groupBy("app_id").agg(F.max("ts").alias("latest_ts")))


def cutoffs_from_watermark(watermark: DataFrame) -> DataFrame:
    """(app_id, cutoff_epoch): the watermark as UTC epoch seconds."""
    return watermark.select("app_id", ts_to_epoch("latest_ts").alias("cutoff_epoch"))


def after_cutoff(items: DataFrame, cutoffs: DataFrame, date_col: str = "date") -> DataFrame:
    """F2 on integer epoch dates: keep items newer than their app's cutoff
    (apps without a watermark keep everything)."""
    j = items.join(cutoffs, "app_id", "left")
    keep = F.col("cutoff_epoch").isNull() | F.col(date_col).isNull() | (F.col(date_col) > F.col("cutoff_epoch"))
    return j.filter(keep).drop("cutoff_epoch")


# ------------------------------------------------------------------- I3 + F2
def walk_pages(pages: DataFrame, cutoffs: DataFrame | None = None,
               params: WalkParams = WalkParams()) -> tuple[DataFrame, DataFrame]:
    """Run the paging rules over landed pages.

    Returns ``(items, meta)``: the items the loop keeps (new by gid, newer
    than the app's cutoff) with their page / position, and one row per app
    with pages, fetched, duplicates, total_expected, forbidden,
    rate_limited_hits, last_enddate and ``walk_status`` (``ok`` / ``failed``).
    """
    max_pages = params.max_pages if params.max_pages and params.max_pages > 0 else None
    cut = cutoffs if cutoffs is not None else pages.sparkSession.createDataFrame([], "app_id int, cutoff_epoch long")

    # the walk runs on the narrow item key; the wide fields (e.g. the content
    # body) are attached to the kept items only, at the end
    exploded = explode_items(pages).drop("fetch_id")
    items = exploded.select("app_id", "page", "pos", "gid", "date").withColumn(
        "walk_key", F.coalesce(F.col("gid"), F.lit("None")))
    items = items.filter(F.col("walk_key") != "")
    items = first_seen(items, ["app_id", "walk_key"], ["page", "pos"], flag="is_new")
    is_int = F.coalesce(variant_kind(F.col("date")).isin(*INT_KINDS), F.lit(False))
    items = (items.join(cut, "app_id", "left")
             .withColumn("is_int", is_int)
             .withColumn("date_int", F.when(is_int, F.expr("try_variant_get(date, '$', 'bigint')"))))
    at_or_below = F.col("is_int") & F.col("cutoff_epoch").isNotNull() & (F.col("date_int") <= F.col("cutoff_epoch"))
    items = items.withColumn("is_kept", F.col("is_new") & ~at_or_below).withColumn(
        "is_cut", F.col("is_new") & at_or_below)

    per_page = items.groupBy("app_id", "page").agg(
        F.count_if("is_kept").alias("n_kept"),
        F.count_if(~F.col("is_new")).alias("n_dup"),
        F.max(F.col("is_cut").cast("int")).alias("reached"),
        F.max((F.col("is_new") & F.col("is_int")).cast("int")).alias("has_int"),
    )
    pg = pages.select(
        "app_id", "page", "enddate", "http_status", F.col("appnews.count").try_cast("int").alias("count"),
        F.size(F.coalesce(F.col("appnews.newsitems"), F.array())).alias("n_items"),
    ).join(per_page, ["app_id", "page"], "left").fillna(0, ["n_kept", "n_dup", "reached", "has_int"])

    status = F.col("http_status")
    is_data = (status == 200) & (F.col("n_items") > 0)
    pg = pg.withColumn("is_data", is_data)
    pg = split_running_sum(pg, ["app_id"], ["page"], {
        "data_pages": F.col("is_data").cast("long"),
        "kept_so_far": F.when(F.col("is_data"), F.col("n_kept")).otherwise(0).cast("long"),
    })
    # total_expected: first non-NULL count of a 200 response, in page order
    first_count = (pg.filter((status == 200) & F.col("count").isNotNull())
                   .groupBy("app_id").agg(F.min_by("count", "page").alias("total_expected"),
                                          F.min("page").alias("count_page")))
    pg = pg.join(first_count, "app_id", "left")
    rule_pages = (F.col("data_pages") >= max_pages) if max_pages else F.lit(False)
    rule_count = (F.col("count_page").isNotNull() & (F.col("page") >= F.col("count_page"))
                  & (F.col("kept_so_far") >= F.col("total_expected")))
    stop_data = F.col("is_data") & (rule_pages | rule_count | (F.col("n_items") < params.page_size)
                                    | (F.col("reached") == 1) | (F.col("has_int") == 0))
    terminal = (status == 403) | ((status == 200) & (F.col("n_items") == 0)) | \
        (~status.isin(200, 403, 429)) | stop_data
    ends = pg.filter(terminal).groupBy("app_id").agg(
        F.min("page").alias("end_page"),
        F.min_by("http_status", "page").alias("end_status"))
    pg = pg.join(ends, "app_id", "left")
    consumed = pg.filter(F.col("end_page").isNull() | (F.col("page") <= F.col("end_page")))

    meta = consumed.groupBy("app_id").agg(
        F.count_if("is_data").alias("pages"),
        F.sum(F.when(F.col("is_data"), F.col("n_kept")).otherwise(0)).cast("long").alias("fetched"),
        F.sum(F.when(F.col("is_data"), F.col("n_dup")).otherwise(0)).cast("long").alias("duplicates"),
        F.max(F.when(F.col("page") >= F.col("count_page"), F.col("total_expected"))).alias("total_expected"),
        F.max(F.col("end_status") == 403).alias("forbidden"),
        F.count_if(status == 429).alias("rate_limited_hits"),
        F.max_by("enddate", "page").alias("last_enddate"),
        F.max(~F.col("end_status").isin(200, 403, 429)).alias("_failed"),
    ).select(
        "app_id", "pages", "fetched", F.col("fetched").alias("unique_total"), "duplicates",
        "total_expected", F.coalesce("forbidden", F.lit(False)).alias("forbidden"),
        "rate_limited_hits", "last_enddate",
        F.when(F.coalesce(F.col("_failed"), F.lit(False)), "failed").otherwise("ok").alias("walk_status"),
    )
    good_pages = consumed.filter(F.col("is_data")).select("app_id", "page")
    ok_apps = meta.filter(F.col("walk_status") == "ok").select("app_id")
    kept_keys = (items.filter("is_kept").join(good_pages, ["app_id", "page"], "left_semi")
                 .join(ok_apps, "app_id", "left_semi").select("app_id", "page", "pos"))
    kept = exploded.join(kept_keys, ["app_id", "page", "pos"], "left_semi")
    return kept, meta


# ------------------------------------------------------------------ F1 + P*
def prepare_items(items: DataFrame) -> DataFrame:
    """Type landed items for insert and give each an ``outcome``.

    ``skipped_missing`` (no gid / title / url), ``failed`` or ``ok``.  ``reason`` says
    why an item is not inserted: ``missing_fields``, ``date`` (null, not a number, or
    outside the years 1 to 9999) or ``feed_type`` (no whole number).  A bad value
    rejects its item and nothing else.
    """
    gid = F.coalesce(F.col("gid"), F.lit(""))
    missing = ((gid == "") | (F.coalesce(F.col("title"), F.lit("")) == "")
               | (F.coalesce(F.col("url"), F.lit("")) == ""))
    kind = variant_kind(F.col("date"))
    numeric = kind.isin(*INT_KINDS, "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    epoch = F.when(F.col("date").isNull(), F.lit(0).cast("decimal(38,6)")).otherwise(
        F.expr("try_variant_get(date, '$', 'decimal(38,6)')"))
    date_ok = F.col("date").isNull() | F.coalesce(numeric & epoch_ok(epoch), F.lit(False))
    feed, feed_ok = parse_int_strict(F.col("feed_type").cast("string"))
    reason = F.when(missing, "missing_fields").when(~date_ok, "date").when(~F.coalesce(feed_ok, F.lit(True)), "feed_type")
    external = F.col("is_external_url")
    is_variant = items.schema["is_external_url"].dataType.typeName() == "variant"
    return items.select(
        "app_id", "page", "pos",
        gid.alias("update_id"), "title", "url",
        F.when(date_ok, epoch_to_ts(epoch)).alias("ts"),
        first_tag("tags").alias("type_name"),
        tags_json("tags").alias("tags_raw"),
        F.col("contents").alias("content_raw"), "author", "feedlabel", "feedname",
        feed.alias("feedtype"),
        (truthy_variant(external) if is_variant else truthy(external)).alias("is_external_url"),
        F.when(reason.isNull(), "ok").when(reason == "missing_fields", "skipped_missing").otherwise("failed").alias("outcome"),
        reason.alias("reason"),
    )


# ------------------------------------------------------------------------- A8
def item_counters(prepared: DataFrame, inserted_content: DataFrame, inserted_fact: DataFrame) -> DataFrame:
    """Per-app counters of one news phase."""
    ins_c = inserted_content.groupBy("app_id").agg(F.count(F.lit(1)).alias("inserted_dim_update_content"))
    ins_f = inserted_fact.groupBy("app_id").agg(F.count(F.lit(1)).alias("inserted_fact_news"))
    base = prepared.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(F.col("outcome") == "ok").alias("_ok"),
        F.count_if(F.col("outcome") == "skipped_missing").alias("skipped_missing_fields"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
    )
    j = base.join(ins_c, "app_id", "left").join(ins_f, "app_id", "left").fillna(
        0, ["inserted_dim_update_content", "inserted_fact_news"])
    return j.select(
        "app_id", "attempted", "inserted_fact_news", "inserted_dim_update_content",
        (F.col("_ok") - F.col("inserted_fact_news")).alias("conflict_fact_news"),
        (F.col("_ok") - F.col("inserted_dim_update_content")).alias("conflict_dim_update_content"),
        "skipped_missing_fields", "failed",
    )
