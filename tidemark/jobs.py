"""Load jobs: the initial and the incremental run.

A run reads the landed snapshot and news pages, validates, upserts the
dimensions, appends facts and writes a per-app report -- each step a
DataFrame plan, committed through ``Store`` (see its commit protocol).

    python -m tidemark.jobs initial --store /warehouse --snapshot /landing/snap --pages /landing/news
    python -m tidemark.jobs check --store /warehouse
    python -m tidemark.jobs export --store /warehouse --target /exports/2024-01-31 --format parquet
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parse import ntz_lit, ts_id
from tidemark.operators import dims, facts, pages
from tidemark.plans import appstate, rolling
from tidemark.sources import landing
from tidemark.sources.store import Store


@dataclass(frozen=True)
class LoadParams:
    """Job parameters (I7); 0 means "no limit" as for the reference's knobs."""
    page_size: int = 100      # of the fetcher; recorded, it decides nothing here
    max_pages: int = 0        # of the fetcher, likewise
    snapshot_limit: int = 0   # first N payload entries (initial run only)
    apps_limit: int = 0       # first N apps by id in the news phase (initial run only)
    skip_news: bool = False   # initial run only

    def limits(self) -> str:
        """The limits that cut this load, for the run's totals; empty when everything is loaded."""
        return ",".join(f"{k}={int(v)}" for k, v in [("snapshot_limit", self.snapshot_limit), ("apps_limit", self.apps_limit),
                                                     ("skip_news", self.skip_news)] if v)


@dataclass
class RunResult:
    etl_run_id: int
    status: str
    report: DataFrame | None = None
    rejected: DataFrame | None = None


def _utcnow() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_load(spark: SparkSession, store_root: str, snapshot_path: str, pages_path: str | None,
             run_type: str = "initial", params: LoadParams = LoadParams(),
             run_ts: datetime | None = None, snapshot_format: str = "jsonl") -> RunResult:
    # read the sources before the run exists: a missing landing leaves no run row (Q18)
    raw = (landing.read_snapshot(spark, snapshot_path) if snapshot_format == "jsonl"
           else landing.read_snapshot_object(spark, snapshot_path))
    news_src = landing.read_news_pages(spark, pages_path) if pages_path else None
    return load_frames(spark, store_root, raw, news_src, run_type, params, run_ts)


def load_frames(spark: SparkSession, store_root: str, raw: DataFrame, news_src: DataFrame | None,
                run_type: str = "incremental", params: LoadParams = LoadParams(),
                run_ts: datetime | None = None, load_key: str | None = None) -> RunResult:
    """One load run from already-read landing frames (snapshot rows with
    ``pos``; landed news pages or ``None``).

    ``load_key`` names the batch; the run log keeps it, so that a caller can tell a
    batch that is loaded from one that is not (see ``Store.loaded``).
    """
    if run_type not in ("initial", "incremental"):
        raise ValueError(run_type)
    incremental = run_type == "incremental"
    store = Store(spark, store_root)
    wh = store.load()
    run_id = store.next_run_id()
    started = run_ts or _utcnow()
    store.append_run_state(run_id, run_type, "running", started, None, started, None)
    status = "failed"
    version = None
    try:
        now = ntz_lit(started)
        # ---------------------------------------------------- snapshot phase
        if params.snapshot_limit > 0 and not incremental:
            raw = raw.orderBy("pos").limit(params.snapshot_limit)
        # parsed / prepared batches feed several sinks: compute them once
        parsed = facts.parse_snapshot(raw).persist()
        cached = [parsed]
        valid, rejected = facts.split_valid(parsed)
        valid = facts.with_unique_positions(valid)
        snap_ts = spark.range(1).select(now.alias("ts"))
        ts_rows = dims.new_timestamps(snap_ts, wh.dim_timestamp)
        new_apps = dims.upsert_apps(
            wh.dim_app, valid.select("app_id", "app_name", "developer", "publisher", "pos"), now)
        stats = facts.snapshot_facts(valid, ts_id(now), F.lit(run_id), now)
        new_typ = wh.dim_update_typ
        report = None
        news_rows = content_rows = prepared = meta = None

        # -------------------------------------------------------- news phase
        if news_src is not None and not (params.skip_news and not incremental):
            apps = new_apps.select("app_id")
            if params.apps_limit > 0 and not incremental:
                apps = apps.orderBy("app_id").limit(params.apps_limit)
            bad_pages = pages.malformed_pages(news_src)
            if not params.apps_limit:
                bad_pages = bad_pages.unionByName(pages.unknown_app_pages(news_src, new_apps))
            landed = news_src.join(apps, "app_id", "left_semi")
            cutoffs = (pages.cutoffs_from_watermark(appstate.watermark(store, wh))
                       if incremental else None)
            prepared = pages.prepare_items(pages.landed_items(landed, cutoffs)).persist()
            # counted on the held items: the landing is parsed for them once; a cut-off hides gids that count too
            named = prepared.filter(F.col("update_id") != "") if cutoffs is None else None
            meta = pages.fetch_counters(landed, prepared, named).persist()
            cached += [prepared, meta]
            new_ts, new_typ, content_rows, news_rows = _news_rows(prepared, wh, run_id, now)
            ts_rows = ts_rows.unionByName(new_ts).distinct()

        # ------------------------------------------------------------ commit
        # independent writes go to the scheduler together (it is thread-safe);
        # the run becomes visible only with its final run record below
        version = run_id
        writes = [
            lambda: store.write_append("fact_steamspy_stats", stats, run_id),
            lambda: store.write_append("dim_timestamp", ts_rows, run_id),
            lambda: store.write_dims(version, {"dim_app": new_apps, "dim_update_typ": new_typ}),
            lambda: store.write_side("quarantine", rejected, run_id),
        ]
        if news_rows is not None:
            bad_items = _bad_items(prepared)
            writes += [lambda: store.write_append("dim_update_content", content_rows, run_id),
                       lambda: store.write_append("fact_news", news_rows, run_id),
                       lambda: store.write_side("quarantine_items", bad_items, run_id),
                       lambda: store.write_side("quarantine_pages", bad_pages, run_id)]
        _run_together(writes)
        own_news = None if news_rows is None else store.partition("fact_news", run_id)
        _run_together([lambda: rolling.maintain(store, wh, run_id, started, own_news),
                       lambda: appstate.maintain(store, wh, run_id, started),
                       lambda: appstate.maintain_marks(store, wh, run_id, own_news)])
        if news_rows is not None:
            # count what was inserted from the partitions just written
            counters = pages.item_counters(prepared, store.partition("dim_update_content", run_id),
                                           store.partition("fact_news", run_id))
            zero = ["attempted", "inserted_fact_news", "inserted_dim_update_content", "conflict_fact_news",
                    "conflict_dim_update_content", "skipped_missing_fields", "failed"]
            report = (meta.join(counters, "app_id", "left").fillna(0, zero)
                      .withColumn("etl_run_id", F.lit(run_id).cast("long")))
            store.write_side("report", report, run_id)
            # totals of what was just written, so that neither is worked out again from the landing
            report = store.side_of("report", report, run_id)
            bad_pages = store.side_of("quarantine_pages", bad_pages, run_id)
        store.write_side("totals", run_totals(
            parsed, report, bad_pages if news_rows is not None else None, run_id, params.limits()), run_id)
        status = "success"
    finally:
        for df in locals().get("cached", []):
            df.unpersist()
        # the final state is written on its own, also after a failure (Q17)
        store.append_run_state(run_id, run_type, status, started, _utcnow(), _utcnow(),
                               version if status == "success" else store.current_dims_version(), load_key)
    return RunResult(run_id, status,
                     store.read_side("report").filter(F.col("etl_run_id") == run_id) if report is not None else None,
                     store.read_side("quarantine").filter(F.col("etl_run_id") == run_id))


def _news_rows(prepared: DataFrame, wh, run_id: int, now) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows that prepared items add: timestamps, all tags, content, facts."""
    ok = prepared.filter(F.col("outcome") == "ok")
    new_typ = dims.assign_type_ids(ok.select("type_name"), wh.dim_update_typ, now)
    content = ok.select(
        "app_id", "update_id", "content_raw", "author", "feedlabel", "feedname", "feedtype",
        "is_external_url", "tags_raw", now.cast("timestamp_ntz").alias("created_at"))
    facts_ = ok.join(new_typ.select("type_name", "update_type_id"), "type_name", "left").select(
        "app_id", "update_id", ts_id("ts").alias("timestamp_id"), F.lit(run_id).cast("long").alias("etl_run_id"),
        "update_type_id", "title", "url", now.cast("timestamp_ntz").alias("created_at"))
    key = ["app_id", "update_id"]
    return (dims.new_timestamps(ok.select("ts"), wh.dim_timestamp), new_typ,
            facts.insert_only(content, wh.dim_update_content, key)[0], facts.insert_only(facts_, wh.fact_news, key)[0])


def _bad_items(prepared: DataFrame) -> DataFrame:
    return prepared.filter(F.col("outcome") != "ok").select(
        "app_id", "page", "pos", "update_id", "title", "url", "reason")


def load_items(spark: SparkSession, store_root: str, items: DataFrame, bad_pages: DataFrame,
               run_ts: datetime | None = None, load_key: str | None = None) -> RunResult:
    """One incremental run of news items alone, each of which is handed over once (``streaming.news_stream``).

    ``items``: exploded landed items; of those with one (app, gid) the first by fetch, page and position stays, and
    those whose key the store has are left out.  There is no cut-off by date.  ``bad_pages``: what did
    not parse; pages of unknown apps join it.  Counters are those of the items.
    """
    store = Store(spark, store_root)
    wh = store.load()
    run_id, started = store.next_run_id(), run_ts or _utcnow()
    store.append_run_state(run_id, "incremental", "running", started, None, started, None)
    status, version, cached = "failed", None, []
    try:
        now = ntz_lit(started)
        bad_pages = bad_pages.unionByName(pages.unknown_app_pages(items, wh.dim_app).distinct())
        known = items.join(wh.dim_app.select("app_id"), "app_id", "left_semi")
        has_gid = F.coalesce(F.col("gid"), F.lit("")) != ""
        first = facts.dedupe_first(known.filter(has_gid), ["app_id", "gid"], ["fetch_id", "page", "pos", "title", "url", "contents"])
        prepared = pages.prepare_items(first.unionByName(known.filter(~has_gid))).persist()
        cached.append(prepared)
        ts_rows, new_typ, content_rows, news_rows = _news_rows(prepared, wh, run_id, now)
        version = run_id
        _run_together([
            lambda: store.write_append("dim_timestamp", ts_rows, run_id),
            lambda: store.write_dims(version, {"dim_app": wh.dim_app, "dim_update_typ": new_typ}),
            lambda: store.write_append("dim_update_content", content_rows, run_id),
            lambda: store.write_append("fact_news", news_rows, run_id),
            lambda: store.write_side("quarantine_items", _bad_items(prepared), run_id),
            lambda: store.write_side("quarantine_pages", bad_pages, run_id)])
        own_news = store.partition("fact_news", run_id)
        _run_together([lambda: rolling.maintain(store, wh, run_id, started, own_news),
                       lambda: appstate.maintain(store, wh, run_id, started),
                       lambda: appstate.maintain_marks(store, wh, run_id, own_news)])
        counters = pages.item_counters(prepared, store.partition("dim_update_content", run_id), store.partition("fact_news", run_id))
        store.write_side("stream_report", counters, run_id)
        status = "success"
    finally:
        for df in cached:
            df.unpersist()
        store.append_run_state(run_id, "incremental", status, started, _utcnow(), _utcnow(),
                               version if status == "success" else store.current_dims_version(), load_key)
    return RunResult(run_id, status, store.side("stream_report", STREAM_REPORT).filter(F.col("etl_run_id") == run_id))


STREAM_REPORT = ("app_id int, attempted long, inserted_fact_news long, inserted_dim_update_content long, conflict_fact_news long, "
                 "conflict_dim_update_content long, skipped_missing_fields long, failed long, etl_run_id long")


def _run_together(actions, workers: int = 4) -> None:
    """Run independent Spark actions from a few driver threads; re-raise the first error."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=workers) as pool:
        for fut in [pool.submit(a) for a in actions]:
            fut.result()


def run_totals(parsed: DataFrame, report: DataFrame | None, bad_pages: DataFrame | None, run_id: int,
               limits: str = "") -> DataFrame:
    """One row of totals of a run (A10, A11): snapshot rows ok and failed, and the news phase's sums."""
    snap = parsed.agg(F.count_if(F.col("reject_reason").isNull()).alias("snapshot_ok"),
                      F.count_if(F.col("reject_reason").isNotNull()).alias("snapshot_failed"))
    out = snap.crossJoin(run_summary(report)) if report is not None else snap
    if bad_pages is not None:
        unknown = F.col("reason") == "unknown_app"
        out = out.crossJoin(bad_pages.agg(F.count_if(~unknown).alias("malformed_pages"), F.count_if(unknown).alias("unknown_app_pages")))
    return out.withColumns({"limits": F.lit(limits), "etl_run_id": F.lit(run_id).cast("long")})


def run_summary(report: DataFrame) -> DataFrame:
    """Run totals of the news phase (A10) from a per-app report; every kept item of every app was tried."""
    return report.agg(
        F.count(F.lit(1)).alias("apps"),
        F.count_if(F.col("walk_status") == "failed").alias("failed_apps"),
        F.sum("fetched").alias("fetched_total"),
        F.sum("duplicates").alias("duplicates"),
        F.sum("inserted_fact_news").alias("inserted_fact_total"),
        F.sum("inserted_dim_update_content").alias("inserted_content_total"),
        F.count_if("forbidden").alias("forbidden_apps"),
        F.sum("rate_limited_hits").alias("rate_limited_hits"),
        F.sum("skipped_missing_fields").alias("skipped_missing"),
        F.sum("failed").alias("failed_items"),
    )


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark.jobs")
    ap.add_argument("command", choices=["initial", "incremental", "check", "export", "import", "reset"])
    ap.add_argument("--store", required=True)
    ap.add_argument("--snapshot", help="landed snapshot (initial / incremental)")
    ap.add_argument("--pages", help="landed news pages (initial / incremental)")
    ap.add_argument("--snapshot-format", default="jsonl", choices=["jsonl", "object"])
    ap.add_argument("--target", help="export target / import source")
    ap.add_argument("--format", default=None, help="export / import format (parquet, json, csv)")
    ap.add_argument("--snapshot-limit", type=int, default=0, help="initial run: first N payload entries (0: all)")
    ap.add_argument("--apps-limit", type=int, default=0, help="initial run: first N apps in the news phase (0: all)")
    ap.add_argument("--skip-news", action="store_true", help="initial run: no news phase")
    args = ap.parse_args(argv)
    from tidemark.session import build_session
    spark = build_session()
    store = Store(spark, args.store)
    if args.command in ("initial", "incremental"):
        params = LoadParams(snapshot_limit=args.snapshot_limit, apps_limit=args.apps_limit, skip_news=args.skip_news)
        res = run_load(spark, args.store, args.snapshot, args.pages, args.command, params,
                       snapshot_format=args.snapshot_format)
        print(f"run {res.etl_run_id}: {res.status}")
    elif args.command == "check":
        from tidemark.operators.checks import assert_clean, constraint_report, smoke_counts
        wh = store.load()
        smoke_counts(wh).show(truncate=False)
        report = constraint_report(wh)
        report.show(100, truncate=False)
        assert_clean(report)
    elif args.command == "export":
        store.export(args.target, args.format or "parquet")
    elif args.command == "reset":
        store.reset()
    else:
        from tidemark.sources.store import import_snapshot
        store.adopt(import_snapshot(spark, args.target, args.format, validate=True))
        print({name: df.count() for name, df in store.load().tables().items()})


if __name__ == "__main__":
    main()
