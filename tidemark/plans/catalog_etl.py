"""Checked queries for the ingest operators (parsing, upserts, insert-only,
walk, quarantine, checks).  Inputs are shaped from the driver tables the
same way on both sides; each Spark builder runs the library operator."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions.parse import (
    first_tag, gid_text, ntz_lit, owners_range, parse_money, tags_json, truthy,
)
from tidemark.operators import checks, dims, facts, pages
from tidemark.plans.catalog import register
from tidemark.sources.adapter import (
    NEWS_TYPES, ORIGIN, ORIGIN_SQL, read_table, warehouse_from_driver, with_adapter,
)

NOW = datetime(2024, 2, 1)
NOW_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
SPLIT = datetime(2024, 1, 20)
SPLIT_SQL = "TIMESTAMP '2024-01-20 00:00:00'"


def _now():
    return ntz_lit(NOW)


# ------------------------------------------------------------- M1, P6, P7
@register("dim_timestamp", """
    SELECT epoch_us(ts) AS timestamp_id, ts, ts::DATE AS date, year(ts)::INTEGER AS year,
           month(ts)::INTEGER AS month, day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour,
           isodow(ts)::INTEGER AS weekday
    FROM (SELECT DISTINCT ts FROM events)
    WHERE ts NOT IN (SELECT ts FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')""", "M1 P6 P7 J10")
def q_dim_timestamp(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    existing = dims.new_timestamps(ev.filter(F.col("ts") < ntz_lit(datetime(2024, 1, 15))), None)
    return dims.new_timestamps(ev, existing)


# --------------------------------------------------------------------- P1
_OWNERS_SPARK = {
    "ECONOMY": lambda lo, hi: F.concat(lo.cast("string"), F.lit(" .. "), hi.cast("string")),
    "SMALL": lambda lo, hi: F.concat(F.format_number(lo, 0), F.lit(" .. "), F.format_number(hi, 0)),
    "LARGE": lambda lo, hi: F.col("p_name"),
    "MEDIUM": lambda lo, hi: F.concat(lo.cast("string"), F.lit(".."), hi.cast("string"), F.lit(".."),
                                      F.col("p_size").cast("string")),
    "PROMO": lambda lo, hi: F.concat(F.col("p_brand"), F.lit(" .. "), hi.cast("string")),
}


def owners_text():
    lo, hi = F.col("p_size") * F.lit(1000), F.col("p_size") * F.lit(2500)
    expr = F.lit("")
    for typ, fn in _OWNERS_SPARK.items():
        expr = F.when(F.col("p_type") == typ, fn(lo, hi)).otherwise(expr)
    return expr


OWNERS_SQL_TEXT = """CASE p_type
        WHEN 'ECONOMY' THEN (p_size * 1000)::VARCHAR || ' .. ' || (p_size * 2500)::VARCHAR
        WHEN 'SMALL' THEN format('{:,}', p_size * 1000) || ' .. ' || format('{:,}', p_size * 2500)
        WHEN 'LARGE' THEN p_name
        WHEN 'MEDIUM' THEN (p_size * 1000)::VARCHAR || '..' || (p_size * 2500)::VARCHAR || '..' || p_size::VARCHAR
        WHEN 'PROMO' THEN p_brand || ' .. ' || (p_size * 2500)::VARCHAR
        ELSE '' END"""


@register("owners_parse", f"""
    WITH t AS (SELECT p_partkey, {OWNERS_SQL_TEXT} AS owners FROM part),
    s AS (SELECT p_partkey, owners, string_split(owners, '..') AS parts FROM t),
    v AS (SELECT p_partkey, owners,
                 CASE WHEN len(parts) = 2 THEN TRY_CAST(trim(replace(parts[1], ',', '')) AS BIGINT) END AS lo,
                 CASE WHEN len(parts) = 2 THEN TRY_CAST(trim(replace(parts[2], ',', '')) AS BIGINT) END AS hi
          FROM s)
    SELECT p_partkey, owners,
           CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN lo END AS owners_min,
           CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN hi END AS owners_max
    FROM v""", "P1")
def q_owners_parse(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").withColumn("owners", owners_text())
    lo, hi = owners_range("owners")
    return part.select("p_partkey", "owners", lo.alias("owners_min"), hi.alias("owners_max"))


# ----------------------------------------------------------------- P2, P3
def money_text():
    cents = F.round(F.col("p_retailprice") * 100).cast("long").cast("string")
    return (F.when(F.col("p_type") == "ECONOMY", F.concat(cents, F.lit(".5")))
            .when(F.col("p_type") == "SMALL", F.lit(""))
            .when(F.col("p_type") == "LARGE", F.lit("0"))
            .when(F.col("p_type") == "MEDIUM", F.col("p_name"))
            .otherwise(cents))


MONEY_SQL_TEXT = """CASE p_type
        WHEN 'ECONOMY' THEN round(p_retailprice * 100)::BIGINT::VARCHAR || '.5'
        WHEN 'SMALL' THEN ''
        WHEN 'LARGE' THEN '0'
        WHEN 'MEDIUM' THEN p_name
        ELSE round(p_retailprice * 100)::BIGINT::VARCHAR END"""


@register("money_parse", f"""
    WITH t AS (SELECT p_partkey, {MONEY_SQL_TEXT} AS price_text,
                      p_size::VARCHAR || '.125' AS discount_text FROM part)
    SELECT p_partkey, price_text,
           (CASE WHEN price_text IS NULL OR price_text IN ('', '0') THEN 0
                 ELSE round_even(TRY_CAST(price_text AS DECIMAL(38,10)) * 0.01, 2) END)::DECIMAL(12,2) AS price,
           (CASE WHEN discount_text IS NULL OR discount_text IN ('', '0') THEN 0
                 ELSE round_even(TRY_CAST(discount_text AS DECIMAL(38,10)), 2) END)::DECIMAL(5,2) AS discount
    FROM t""", "P2 P3")
def q_money_parse(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", money_text().alias("price_text"),
        F.concat(F.col("p_size").cast("string"), F.lit(".125")).alias("discount_text"))
    return part.select("p_partkey", "price_text",
                       parse_money("price_text", 100).cast("decimal(12,2)").alias("price"),
                       parse_money("discount_text", 1).cast("decimal(5,2)").alias("discount"))


# ----------------------------------------------------------- P15-P19, P4
@register("json_tag", """
    WITH t AS (SELECT event_id, event_type, value, ts, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
               FROM events),
    a AS (SELECT event_id, value, ts,
                 CASE WHEN k >= 95 THEN NULL WHEN k < 20 THEN []::VARCHAR[]
                      WHEN k < 60 THEN ['k' || k::VARCHAR] ELSE ['k' || k::VARCHAR, event_type] END AS tags
          FROM t)
    SELECT event_id::VARCHAR AS update_id,
           tags[1] AS type_name,
           to_json(COALESCE(tags, []::VARCHAR[]))::VARCHAR AS tags_raw,
           COALESCE(CASE WHEN value > 90 THEN NULL ELSE value > 50 END, false) AS is_external_url,
           make_timestamp(floor(epoch_us(ts) / 1000000)::BIGINT * 1000000) AS news_ts
    FROM a""", "P4 P5 P15 P16 P17 P18 P19")
def q_json_tag(spark, sf_dir):
    from tidemark.functions.parse import epoch_to_ts, ts_to_epoch
    ev = read_table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
    k = F.col("k")
    one = F.array(F.concat(F.lit("k"), k.cast("string")))
    two = F.array(F.concat(F.lit("k"), k.cast("string")), F.col("event_type"))
    tags = (F.when(k >= 95, F.lit(None).cast("array<string>")).when(k < 20, F.array().cast("array<string>"))
            .when(k < 60, one).otherwise(two))
    ext = F.when(F.col("value") > 90, F.lit(None).cast("boolean")).otherwise(F.col("value") > 50)
    return ev.withColumn("tags", tags).select(
        gid_text(F.col("event_id").cast("string")).alias("update_id"),
        first_tag("tags").alias("type_name"),
        tags_json("tags").alias("tags_raw"),
        truthy(ext).alias("is_external_url"),
        epoch_to_ts(ts_to_epoch("ts")).alias("news_ts"),
    )


# --------------------------------------------------------------------- M2
def _app_batch(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("int").alias("app_id"),
        F.col("o_orderkey").alias("pos"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("Cust "), F.col("o_custkey").cast("string"), F.lit(" "), F.col("o_orderstatus"))).alias("app_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.lit(None).cast("string")).alias("developer"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority")).otherwise(
            F.lit(None).cast("string")).alias("publisher"),
    )


@register("app_upsert", with_adapter(f"""
    b AS (SELECT o_custkey::INTEGER AS app_id, o_orderkey AS pos,
                 CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'Cust ' || o_custkey::VARCHAR || ' ' || o_orderstatus END AS app_name,
                 CASE WHEN o_orderstatus = 'F' THEN '' END AS developer,
                 CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority END AS publisher
          FROM orders),
    r AS (SELECT app_id,
                 arg_max(app_name, pos) FILTER (WHERE app_name IS NOT NULL) AS app_name,
                 arg_max(developer, pos) FILTER (WHERE developer IS NOT NULL) AS developer,
                 arg_max(publisher, pos) FILTER (WHERE publisher IS NOT NULL) AS publisher
          FROM b GROUP BY app_id)
    SELECT COALESCE(r.app_id, o.app_id) AS app_id,
           COALESCE(r.app_name, o.app_name) AS app_name,
           COALESCE(r.developer, o.developer) AS developer,
           COALESCE(r.publisher, o.publisher) AS publisher,
           CASE WHEN r.app_id IS NOT NULL THEN {NOW_SQL} ELSE o.updated_at END AS updated_at
    FROM w_dim_app o FULL OUTER JOIN r ON r.app_id = o.app_id"""), "M2 Q19")
def q_app_upsert(spark, sf_dir):
    wh = warehouse_from_driver(spark, sf_dir)
    return dims.upsert_apps(wh.dim_app, _app_batch(spark, sf_dir), _now())


# ----------------------------------------------------------------- M3, M8
def _tags_of(ev, kind):
    return ev.filter(F.col("event_type") == kind).select(
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("type_name"))


@register("tag_upsert", f"""
    WITH old AS (
        SELECT (row_number() OVER (ORDER BY type_name))::INTEGER AS update_type_id, type_name,
               {ORIGIN_SQL} AS updated_at
        FROM (SELECT DISTINCT 'k' || json_extract_string(props, '$.k') AS type_name FROM events
              WHERE event_type = 'view')),
    batch AS (SELECT DISTINCT 'k' || json_extract_string(props, '$.k') AS type_name FROM events
              WHERE event_type = 'purchase'),
    fresh AS (
        SELECT ((SELECT COALESCE(max(update_type_id), 0) FROM old)
                + row_number() OVER (ORDER BY type_name))::INTEGER AS update_type_id,
               type_name, {NOW_SQL} AS updated_at
        FROM batch WHERE type_name NOT IN (SELECT type_name FROM old))
    SELECT o.update_type_id, o.type_name,
           CASE WHEN b.type_name IS NOT NULL THEN {NOW_SQL} ELSE o.updated_at END AS updated_at
    FROM old o LEFT JOIN batch b ON b.type_name = o.type_name
    UNION ALL SELECT * FROM fresh""", "M3 M8")
def q_tag_upsert(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    old = dims.assign_type_ids(_tags_of(ev, "view"), None, ntz_lit(ORIGIN))
    return dims.assign_type_ids(_tags_of(ev, "purchase"), old, _now())


# -------------------------------------------------------------- U1, M4, M5
# a total order: all columns but the key
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register("insert_only_dedupe", f"""
    WITH firsts AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                         ORDER BY {', '.join(LINE_ORDER)}) AS rn
            FROM lineitem) WHERE rn = 1),
    existing AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R')
    SELECT f.* FROM firsts f
    WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.l_orderkey = f.l_orderkey AND e.l_linenumber = f.l_linenumber)
    """, "U1 M4 M5")
def q_insert_only_dedupe(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    batch = facts.dedupe_first(li, key, LINE_ORDER)
    existing = li.filter(F.col("l_returnflag") == "R").select(*key)
    new, _conflicts = facts.insert_only(batch, existing, key)
    return new


# ------------------------------------------------------------------ A8, F1
def _items_from_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin(NEWS_TYPES))
    return ev.select(
        F.col("user_id").cast("int").alias("app_id"),
        F.lit(1).alias("page"), F.col("event_id").alias("pos"),
        F.col("event_id").cast("string").alias("gid"),
        F.when(F.col("value") < 5, F.lit(None).cast("string")).otherwise(F.lit("title")).alias("title"),
        F.when((F.col("event_type") == "signup") & (F.col("value") > 90), F.lit("")).otherwise(F.lit("u")).alias("url"),
        F.lit(None).cast("boolean").alias("is_external_url"), F.col("event_type").alias("author"),
        F.col("props").alias("contents"), F.lit("label").alias("feedlabel"),
        F.when(F.col("value") >= 99, F.lit(None).cast("string"))
         .otherwise(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
         .alias("_date_text"),
        F.lit("feed").alias("feedname"), F.lit(0).alias("feed_type"),
        F.col("user_id").cast("int").alias("appid"),
        F.array(F.concat(F.lit("k"), F.get_json_object("props", "$.k"))).alias("tags"),
        F.col("ts").alias("_ts"),
    ).withColumn("date", F.when(F.col("_date_text").isNull(), F.parse_json(F.lit("null")))
                 .otherwise(F.parse_json("_date_text")))


@register("ingest_counters", f"""
    WITH i AS (
        SELECT user_id::INTEGER AS app_id, event_id::VARCHAR AS update_id, ts,
               CASE WHEN value < 5 OR (event_type = 'signup' AND value > 90) THEN 'skipped_missing'
                    WHEN value >= 99 THEN 'failed' ELSE 'ok' END AS outcome
        FROM events WHERE event_type IN ('purchase', 'signup')),
    ins AS (SELECT * FROM i WHERE outcome = 'ok' AND ts >= {SPLIT_SQL})
    SELECT app_id, count(*) AS attempted,
           count(*) FILTER (WHERE outcome = 'ok' AND ts >= {SPLIT_SQL}) AS inserted_fact_news,
           count(*) FILTER (WHERE outcome = 'ok' AND ts >= {SPLIT_SQL}) AS inserted_dim_update_content,
           count(*) FILTER (WHERE outcome = 'ok' AND ts < {SPLIT_SQL}) AS conflict_fact_news,
           count(*) FILTER (WHERE outcome = 'ok' AND ts < {SPLIT_SQL}) AS conflict_dim_update_content,
           count(*) FILTER (WHERE outcome = 'skipped_missing') AS skipped_missing_fields,
           count(*) FILTER (WHERE outcome = 'failed') AS failed
    FROM i GROUP BY app_id""", "A8 F1 M4 M5")
def q_ingest_counters(spark, sf_dir):
    items = _items_from_events(spark, sf_dir)
    prepared = pages.prepare_items(items.drop("_date_text", "_ts"))
    existing = items.filter(F.col("_ts") < ntz_lit(SPLIT)).select(
        "app_id", F.col("gid").alias("update_id"))
    ok = prepared.filter(F.col("outcome") == "ok").select("app_id", "update_id")
    content_new, _ = facts.insert_only(ok, existing, ["app_id", "update_id"])
    fact_new, _ = facts.insert_only(ok, existing, ["app_id", "update_id"])
    return pages.item_counters(prepared, content_new, fact_new)


# ----------------------------------------------------------------- A3, F2
@register("high_watermark", with_adapter("""
    SELECT n.app_id, max(t.ts) AS latest_ts, floor(epoch_us(max(t.ts)) / 1000000)::BIGINT AS cutoff_epoch
    FROM w_fact_news n JOIN w_dim_timestamp t ON t.timestamp_id = n.timestamp_id
    GROUP BY n.app_id"""), "A3 P5 J11")
def q_high_watermark(spark, sf_dir):
    wh = warehouse_from_driver(spark, sf_dir)
    wm = pages.latest_news_ts(wh.fact_news, wh.dim_timestamp, wh.micros_ids)
    return wm.join(pages.cutoffs_from_watermark(wm), "app_id")


@register("incremental_delta", f"""
    WITH c AS (SELECT user_id::INTEGER AS app_id, floor(epoch_us(max(ts)) / 1000000)::BIGINT AS cutoff_epoch
               FROM events WHERE event_type IN ('purchase', 'signup') AND ts < {SPLIT_SQL} GROUP BY 1),
    i AS (SELECT user_id::INTEGER AS app_id, event_id::VARCHAR AS update_id,
                 floor(epoch_us(ts) / 1000000)::BIGINT AS date
          FROM events WHERE event_type IN ('purchase', 'signup'))
    SELECT i.app_id, i.update_id, i.date FROM i LEFT JOIN c ON c.app_id = i.app_id
    WHERE c.cutoff_epoch IS NULL OR i.date > c.cutoff_epoch""", "F2 A3 Q8")
def q_incremental_delta(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin(NEWS_TYPES))
    old = ev.filter(F.col("ts") < ntz_lit(SPLIT)).select(F.col("user_id").cast("int").alias("app_id"), F.col("ts"))
    wm = old.groupBy("app_id").agg(F.max("ts").alias("latest_ts"))
    items = ev.select(F.col("user_id").cast("int").alias("app_id"), F.col("event_id").cast("string").alias("update_id"),
                      F.unix_seconds(F.col("ts").cast("timestamp")).alias("date"))
    return pages.after_cutoff(items, pages.cutoffs_from_watermark(wm), "date").select("app_id", "update_id", "date")


# -------------------------------------------------------------------- I3, A9
WALK_PAGE = 20


@register("page_walk", f"""
    WITH it AS (
        SELECT user_id::INTEGER AS app_id, floor(epoch_us(ts) / 1000000)::BIGINT AS date,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS seq,
               count(*) OVER (PARTITION BY user_id) AS total
        FROM events WHERE event_type IN ('purchase', 'signup')),
    c AS (SELECT user_id::INTEGER AS app_id, floor(epoch_us(max(ts)) / 1000000)::BIGINT AS cutoff_epoch
          FROM events WHERE event_type IN ('purchase', 'signup') AND ts < {SPLIT_SQL} GROUP BY 1),
    pg AS (
        SELECT it.app_id, ((seq - 1) // {WALK_PAGE} + 1)::INTEGER AS page, min(total) AS count,
               count(*) AS n_items, min(date) AS oldest,
               count(*) FILTER (WHERE c.cutoff_epoch IS NULL OR date > c.cutoff_epoch) AS n_kept,
               bool_or(c.cutoff_epoch IS NOT NULL AND date <= c.cutoff_epoch) AS reached
        FROM it LEFT JOIN c ON c.app_id = it.app_id GROUP BY 1, 2),
    w AS (
        SELECT *, sum(n_kept) OVER (PARTITION BY app_id ORDER BY page) AS kept_so_far,
               lag(oldest) OVER (PARTITION BY app_id ORDER BY page) - 1 AS enddate
        FROM pg),
    s AS (SELECT *, (n_items < {WALK_PAGE} OR reached OR kept_so_far >= count) AS stop FROM w),
    e AS (SELECT app_id, min(page) FILTER (WHERE stop) AS end_page FROM s GROUP BY app_id)
    SELECT s.app_id, count(*) AS pages, sum(n_kept)::BIGINT AS fetched, sum(n_kept)::BIGINT AS unique_total,
           0::BIGINT AS duplicates, min(count)::INTEGER AS total_expected, false AS forbidden,
           0::BIGINT AS rate_limited_hits, arg_max(enddate, page) AS last_enddate, 'ok' AS walk_status
    FROM s JOIN e ON e.app_id = s.app_id
    WHERE e.end_page IS NULL OR s.page <= e.end_page
    GROUP BY s.app_id""", "I3 A9 F2")
def q_page_walk(spark, sf_dir):
    from tidemark.sources.landing import as_landed, news_pages_from_driver
    landed = as_landed(news_pages_from_driver(spark, sf_dir, page_size=WALK_PAGE))
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin(NEWS_TYPES))
    wm = (ev.filter(F.col("ts") < ntz_lit(SPLIT)).groupBy(F.col("user_id").cast("int").alias("app_id"))
          .agg(F.max("ts").alias("latest_ts")))
    _kept, meta = pages.walk_pages(landed, pages.cutoffs_from_watermark(wm), pages.WalkParams(WALK_PAGE, None))
    return meta


# --------------------------------------------- the load path: every new landed item
@register("news_delta", f"""
    WITH wm AS (SELECT user_id, max(ts) AS newest FROM events
                WHERE event_type IN ('purchase', 'signup') AND ts < {SPLIT_SQL} GROUP BY user_id)
    SELECT user_id::INTEGER AS app_id, event_id::VARCHAR AS update_id, 'title ' || event_id AS title,
           'https://example.com/news/' || event_id AS url, date_trunc('second', ts) AS ts,
           'k' || json_extract_string(props, '$.k') AS type_name, props AS content_raw, event_type AS author,
           (event_id % 2)::INTEGER AS feedtype, value > 50 AS is_external_url, 'ok' AS outcome
    FROM events LEFT JOIN wm USING (user_id)
    WHERE event_type IN ('purchase', 'signup')
      AND (newest IS NULL OR epoch_us(date_trunc('second', ts)) > epoch_us(date_trunc('second', newest)))""",
          "S2 F2 U1 P13 P15 P16 P18 A3")
def q_news_delta(spark, sf_dir):
    from tidemark.sources.landing import as_landed, news_pages_from_driver
    # two page sizes, as fetchers of different settings leave them: every item counts all the same
    landed = as_landed(news_pages_from_driver(spark, sf_dir, page_size=WALK_PAGE)).unionByName(
        as_landed(news_pages_from_driver(spark, sf_dir, page_size=WALK_PAGE + 7)))
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin(NEWS_TYPES))
    wm = (ev.filter(F.col("ts") < ntz_lit(SPLIT)).groupBy(F.col("user_id").cast("int").alias("app_id"))
          .agg(F.max("ts").alias("latest_ts")))
    kept, _meta = pages.landed_news(landed, pages.cutoffs_from_watermark(wm))
    return pages.prepare_items(kept).select(
        "app_id", "update_id", "title", "url", "ts", "type_name", "content_raw", "author", "feedtype",
        "is_external_url", "outcome")


# ---------------------------------------------------------- F9, C4, C5, P14
def _raw_snapshot(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    lo, hi = F.col("p_size") * F.lit(1000), F.col("p_size") * F.lit(2000)
    owners = F.when(F.col("p_brand") == "Brand#1", F.concat(hi.cast("string"), F.lit(" .. "), lo.cast("string"))) \
        .otherwise(F.concat(lo.cast("string"), F.lit(" .. "), hi.cast("string")))
    s = lambda c: F.col(c).cast("string")
    return p.select(
        F.col("p_partkey").alias("pos"),
        F.when(F.col("p_brand") == "Brand#2", F.concat(F.lit("x"), s("p_partkey"))).otherwise(s("p_partkey")).alias("appid"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("developer"), F.col("p_type").alias("publisher"),
        s("p_size").alias("positive"), s("p_size").alias("negative"), F.lit("0").alias("userscore"),
        owners.alias("owners"),
        s("p_size").alias("average_forever"), s("p_size").alias("average_2weeks"),
        s("p_size").alias("median_forever"), s("p_size").alias("median_2weeks"),
        F.when(F.col("p_brand") == "Brand#3", F.lit("NaN"))
         .otherwise(F.round(F.col("p_retailprice") * 100).cast("long").cast("string")).alias("price"),
        F.round(F.col("p_retailprice") * 100).cast("long").cast("string").alias("initialprice"),
        F.when(F.col("p_brand") == "Brand#4", F.lit("2000")).otherwise(s("p_size")).alias("discount"),
        F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(s("p_size")).alias("ccu"),
    )


@register("quarantine", """
    WITH r AS (SELECT p_partkey AS pos, p_brand, p_type, p_size, p_retailprice FROM part)
    SELECT pos,
           CASE WHEN p_brand = 'Brand#2' THEN 'appid'
                WHEN p_brand = 'Brand#1' THEN 'owners_check'
                WHEN p_type = 'PROMO' THEN 'int:ccu'
                WHEN p_brand = 'Brand#3' THEN 'nan:price'
                WHEN p_brand = 'Brand#4' THEN 'range:discount' END AS reject_reason,
           CASE WHEN p_brand = 'Brand#2' THEN NULL ELSE pos::INTEGER END AS app_id,
           CASE WHEN p_brand = 'Brand#1' THEN p_size * 2000 ELSE p_size * 1000 END AS owners_min,
           CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_size END AS ccu,
           CASE WHEN p_brand = 'Brand#3' THEN NULL
                ELSE (round(p_retailprice * 100)::BIGINT::DECIMAL(38,10) * 0.01)::DECIMAL(12,2) END AS price,
           CASE WHEN p_brand = 'Brand#4' THEN NULL ELSE p_size::DECIMAL(5,2) END AS discount
    FROM r""", "F9 C4 C5 P14")
def q_quarantine(spark, sf_dir):
    parsed = facts.parse_snapshot(_raw_snapshot(spark, sf_dir))
    return parsed.select("pos", "reject_reason", "app_id", "owners_min", "ccu", "price", "discount")


# --------------------------------------------------------------- K1-K3, C2
_SMOKE = ["dim_timestamp", "dim_app", "dim_update_typ", "dim_update_content", "fact_news", "fact_steamspy_stats"]


@register("row_counts", with_adapter(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM w_{t}" for t in _SMOKE)), "K1 A4")
def q_row_counts(spark, sf_dir):
    return checks.smoke_counts(warehouse_from_driver(spark, sf_dir))


@register("null_keys", with_adapter("""
    SELECT 'fact_news_null_keys' AS "check", count(*) FILTER (WHERE app_id IS NULL OR update_id IS NULL
           OR timestamp_id IS NULL OR etl_run_id IS NULL) AS violations FROM w_fact_news
    UNION ALL
    SELECT 'fact_steamspy_null_keys', count(*) FILTER (WHERE app_id IS NULL OR timestamp_id IS NULL
           OR etl_run_id IS NULL) FROM w_fact_steamspy_stats"""), "K2 A5 C1")
def q_null_keys(spark, sf_dir):
    return checks.smoke_null_keys(warehouse_from_driver(spark, sf_dir))


@register("orphans", with_adapter("""
    SELECT 'fact_news_orphan_content' AS "check", count(*) AS violations FROM w_fact_news n
      WHERE NOT EXISTS (SELECT 1 FROM w_dim_update_content c WHERE c.app_id = n.app_id AND c.update_id = n.update_id)
    UNION ALL SELECT 'fact_news_orphan_timestamp', count(*) FROM w_fact_news n
      WHERE NOT EXISTS (SELECT 1 FROM w_dim_timestamp t WHERE t.timestamp_id = n.timestamp_id)
    UNION ALL SELECT 'fact_steamspy_orphan_timestamp', count(*) FROM w_fact_steamspy_stats s
      WHERE NOT EXISTS (SELECT 1 FROM w_dim_timestamp t WHERE t.timestamp_id = s.timestamp_id)
    UNION ALL SELECT 'lineitem_orphan_order', count(*) FROM lineitem l
      WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
    UNION ALL SELECT 'labels_orphan_document', count(*) FROM labels l
      WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)"""), "K3 A6 J9 C3")
def q_orphans(spark, sf_dir):
    wh = warehouse_from_driver(spark, sf_dir)
    extra = [
        checks.orphan_count(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders"),
                            ["l_orderkey"], ["o_orderkey"], "lineitem_orphan_order"),
        checks.orphan_count(read_table(spark, sf_dir, "labels"), read_table(spark, sf_dir, "documents"),
                            ["doc_id"], ["doc_id"], "labels_orphan_document"),
    ]
    out = checks.smoke_orphans(wh)
    for e in extra:
        out = out.unionByName(e)
    return out


@register("dup_keys", """
    WITH g1 AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
         g2 AS (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1),
         g3 AS (SELECT count(*) AS n FROM events GROUP BY ts HAVING count(*) > 1)
    SELECT 'pk:lineitem' AS "check", count(*) AS violations, COALESCE(sum(n - 1), 0)::BIGINT AS extra_rows FROM g1
    UNION ALL SELECT 'pk:orders', count(*), COALESCE(sum(n - 1), 0)::BIGINT FROM g2
    UNION ALL SELECT 'unique:dim_timestamp.ts', count(*), COALESCE(sum(n - 1), 0)::BIGINT FROM g3""", "C2")
def q_dup_keys(spark, sf_dir):
    return (checks.duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "pk:lineitem")
            .unionByName(checks.duplicate_keys(read_table(spark, sf_dir, "orders"), ["o_orderkey"], "pk:orders"))
            .unionByName(checks.duplicate_keys(read_table(spark, sf_dir, "events"), ["ts"], "unique:dim_timestamp.ts")))


# -------------------------------------------------------------------- S6, S7
@register("snapshot_export_import", with_adapter(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM w_{t}"
    for t in ["dim_timestamp", "dim_etl_run", "dim_app", "dim_update_typ", "dim_update_content", "fact_news",
              "fact_steamspy_stats"])), "S6 S7")
def q_snapshot_export_import(spark, sf_dir):
    import uuid

    from tidemark.session import checkpoint_dir
    from tidemark.sources.store import import_snapshot

    wh = warehouse_from_driver(spark, sf_dir)
    target = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-export-{uuid.uuid4().hex}"
    for name, df in wh.tables().items():
        df.write.mode("overwrite").parquet(f"{target}/{name}")
    back = import_snapshot(spark, target)
    return checks.row_counts(back.tables())


# ------------------------------------------------------------ I1, I2, I4, I6
INGEST_PAGE = 100


@register("ingest_initial_report", f"""
    WITH apps AS (
        SELECT DISTINCT e.user_id FROM events e JOIN customer c ON c.c_custkey = e.user_id
        WHERE c.c_acctbal >= 0),
    it AS (
        SELECT user_id::INTEGER AS app_id, floor(epoch_us(ts) / 1000000)::BIGINT AS date,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS seq,
               count(*) OVER (PARTITION BY user_id) AS n
        FROM events WHERE event_type IN ('purchase', 'signup') AND user_id IN (SELECT user_id FROM apps)),
    pg AS (SELECT app_id, (seq - 1) // {INGEST_PAGE} + 1 AS page, min(date) AS oldest, min(n) AS n
           FROM it GROUP BY 1, 2),
    per_app AS (SELECT app_id, max(page) AS pages, min(n) AS n FROM pg GROUP BY app_id)
    SELECT a.app_id, a.pages::BIGINT AS pages, a.n AS fetched, a.n AS unique_total, 0::BIGINT AS duplicates,
           a.n::INTEGER AS total_expected, false AS forbidden, 0::BIGINT AS rate_limited_hits,
           p.oldest - 1 AS last_enddate, 'ok' AS walk_status,
           a.n AS attempted, a.n AS inserted_fact_news, a.n AS inserted_dim_update_content,
           0::BIGINT AS conflict_fact_news, 0::BIGINT AS conflict_dim_update_content,
           0::BIGINT AS skipped_missing_fields, 0::BIGINT AS failed, 1::BIGINT AS etl_run_id
    FROM per_app a LEFT JOIN pg p ON p.app_id = a.app_id AND p.page = a.pages - 1""", "I1 I2 I3 I4 I6 A8 A9")
def q_ingest_initial_report(spark, sf_dir):
    """A whole initial load (snapshot phase + news phase) into a fresh store
    under the shared checkpoint folder; returns the run's per-app report."""
    import uuid

    from tidemark.jobs import LoadParams, run_load
    from tidemark.session import checkpoint_dir
    from tidemark.sources.landing import news_pages_from_driver, snapshot_rows_from_driver, write_jsonl

    root = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-ingest-{uuid.uuid4().hex}"
    # land first (JSON lines, as the fetcher would), then load from the landing zone
    snap = write_jsonl(snapshot_rows_from_driver(spark, sf_dir, None), f"{root}/landing/snapshot")
    news = write_jsonl(news_pages_from_driver(spark, sf_dir, page_size=INGEST_PAGE), f"{root}/landing/news")
    res = run_load(spark, f"{root}/store", snap, news, "initial", LoadParams(), run_ts=SPLIT)
    return res.report



# ------------------------------- S4-S7, M4-M6, I5, I6, A10, A11: what two loads store
LATER = datetime(2024, 1, 31)
_TEXT = "concat_ws('|', {})"


def _row(*cols: str) -> str:
    """The columns as one text, nulls as ``-``."""
    return _TEXT.format(", ".join(f"coalesce(CAST({c} AS {{text}}), '-')" for c in cols))


_STORED = {
    "fact_news": _row("app_id", "update_id", "timestamp_id", "etl_run_id", "title", "url"),
    "dim_update_content": _row("app_id", "update_id", "content_raw", "author", "feedtype", "is_external_url", "tags_raw"),
    "fact_steamspy_stats": _row("etl_run_id", "app_id", "owners_min", "owners_max", "positive", "negative",
                                "average_2weeks", "price", "initialprice", "discount"),
    "dim_app": _row("app_id", "app_name", "developer", "publisher"),
    "totals": _row("etl_run_id", "snapshot_ok", "snapshot_failed", "apps", "fetched_total", "inserted_fact_total",
                   "inserted_content_total", "skipped_missing", "failed_items", "malformed_pages"),
}


@register("stored_warehouse", f"""
    WITH s AS (
        SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'view') AS views,
               count(*) FILTER (event_type = 'error') AS errors, max(value) AS top
        FROM events GROUP BY user_id),
    p AS (
        SELECT c_custkey::INTEGER AS app_id, c_name AS app_name, c_mktsegment AS developer,
               'nation-' || c_nationkey AS publisher, c_acctbal >= 0 AS good, n, views, errors, top
        FROM s JOIN customer ON c_custkey = user_id),
    runs AS (SELECT * FROM (VALUES (1, {SPLIT_SQL}), (2, TIMESTAMP '2024-01-31 00:00:00')) AS v(etl_run_id, started)),
    news AS (
        SELECT app_id, event_id::VARCHAR AS update_id, epoch_us(date_trunc('second', ts)) AS timestamp_id,
               CASE WHEN ts < {SPLIT_SQL} THEN 1 ELSE 2 END AS etl_run_id, 'title ' || event_id AS title,
               'https://example.com/news/' || event_id AS url, props AS content_raw, event_type AS author,
               event_id % 2 AS feedtype, value > 50 AS is_external_url,
               '["k' || json_extract_string(props, '$.k') || '"]' AS tags_raw
        FROM events JOIN p ON p.app_id = user_id AND good WHERE event_type IN ('purchase', 'signup')),
    stored AS (
        SELECT * FROM news n
        WHERE etl_run_id = 1 OR timestamp_id > coalesce((SELECT max(m.timestamp_id) FROM news m
                                                        WHERE m.app_id = n.app_id AND m.etl_run_id = 1), -1)),
    stats AS (
        SELECT etl_run_id, app_id, n * 1000 AS owners_min, n * 2000 AS owners_max, views * 10 AS positive, errors AS negative,
               n AS average_2weeks, (round(top * 100)::BIGINT::DECIMAL(30,2) / 100)::DECIMAL(12,2) AS price,
               (round(top * 200)::BIGINT::DECIMAL(30,2) / 100)::DECIMAL(12,2) AS initialprice,
               (errors * 5)::DECIMAL(5,2) AS discount
        FROM p, runs WHERE good),
    totals AS (
        SELECT etl_run_id, (SELECT count(*) FROM p WHERE good) AS snapshot_ok, (SELECT count(*) FROM p WHERE NOT good) AS snapshot_failed,
               (SELECT count(DISTINCT app_id) FROM news WHERE news.etl_run_id <= runs.etl_run_id) AS apps,
               (SELECT count(*) FROM stored WHERE stored.etl_run_id = runs.etl_run_id) AS fetched_total,
               (SELECT count(*) FROM stored WHERE stored.etl_run_id = runs.etl_run_id) AS inserted_fact_total,
               (SELECT count(*) FROM stored WHERE stored.etl_run_id = runs.etl_run_id) AS inserted_content_total,
               0 AS skipped_missing, 0 AS failed_items, 0 AS malformed_pages
        FROM runs)
    SELECT 'fact_news' AS table_name, {_STORED['fact_news'].format(text='VARCHAR')} AS row_text FROM stored
    UNION ALL SELECT 'dim_update_content', {_STORED['dim_update_content'].format(text='VARCHAR')} FROM stored
    UNION ALL SELECT 'fact_steamspy_stats', {_STORED['fact_steamspy_stats'].format(text='VARCHAR')} FROM stats
    UNION ALL SELECT 'dim_app', {_STORED['dim_app'].format(text='VARCHAR')} FROM p WHERE good
    UNION ALL SELECT 'totals', {_STORED['totals'].format(text='VARCHAR')} FROM totals""",
          "S4 S5 S6 S7 M4 M5 M6 M7 P13 I1 I2 I5 I6 A10 A11")
def q_stored_warehouse(spark, sf_dir):
    """An initial load of the older news, an incremental load of all pages, an export and an import into a new
    store; returns the rows that the new store holds, and both runs' totals."""
    import uuid

    from tidemark.jobs import run_load
    from tidemark.session import checkpoint_dir
    from tidemark.sources.landing import news_pages_from_driver, snapshot_rows_from_driver, write_jsonl
    from tidemark.sources.store import Store, import_snapshot

    root = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-stored-{uuid.uuid4().hex}"
    snap = write_jsonl(snapshot_rows_from_driver(spark, sf_dir, None), f"{root}/landing/snapshot")
    old = write_jsonl(news_pages_from_driver(spark, sf_dir, INGEST_PAGE, until=SPLIT), f"{root}/landing/old")
    new = write_jsonl(news_pages_from_driver(spark, sf_dir, INGEST_PAGE), f"{root}/landing/new")
    run_load(spark, f"{root}/store", snap, old, "initial", run_ts=SPLIT)
    run_load(spark, f"{root}/store", snap, new, "incremental", run_ts=LATER)
    first = Store(spark, f"{root}/store")
    first.export(f"{root}/export")
    second = Store(spark, f"{root}/second")
    second.adopt(import_snapshot(spark, f"{root}/export"))
    tables = second.load().tables() | {"totals": first.read_side("totals")}
    parts = [tables[name].select(F.lit(name).alias("table_name"), F.expr(text.format(text="STRING")).alias("row_text"))
             for name, text in _STORED.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
