"""Store commit protocol, snapshot export / import and the availableNow stream."""

import tempfile
from datetime import datetime

import pytest

from tidemark.jobs import LoadParams, load_frames
from tidemark.sources import landing
from tidemark.sources.store import Store, import_snapshot
from tidemark.streaming.available_now import run_available_now

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def snap(spark):
    return landing.snapshot_rows_from_driver(spark, SF, 5)


def test_failed_run_stays_invisible(spark, snap):
    root = tempfile.mkdtemp(prefix="tidemark-store-")
    ok = load_frames(spark, root, snap, None, "initial", LoadParams(), run_ts=datetime(2024, 1, 3))
    assert ok.status == "success"
    st = Store(spark, root)
    n_stats = st.load().fact_steamspy_stats.count()
    bad_pages = spark.createDataFrame([], "app_id int")  # wrong shape -> the news phase fails
    with pytest.raises(Exception):
        load_frames(spark, root, snap, bad_pages, "incremental", LoadParams(), run_ts=datetime(2024, 1, 4))
    runs = {r.etl_run_id: r.status for r in st.load().dim_etl_run.collect()}
    assert runs == {1: "success", 2: "failed"}
    assert st.load().fact_steamspy_stats.count() == n_stats


def test_export_import_roundtrip(spark, snap, tmp_path):
    root = tempfile.mkdtemp(prefix="tidemark-store-")
    load_frames(spark, root, snap, None, "initial", LoadParams(), run_ts=datetime(2024, 1, 3))
    st = Store(spark, root)
    before = {n: df.count() for n, df in st.load().tables().items()}
    for fmt in ("parquet", "json"):
        target = str(tmp_path / fmt)
        st.export(target, fmt)
        back = import_snapshot(spark, target, validate=(fmt == "parquet"))
        assert {n: df.count() for n, df in back.tables().items()} == before
    with pytest.raises(ValueError):
        st.export(str(tmp_path / "x"), "avro")


def test_available_now_stream(spark, tmp_path):
    land = str(tmp_path / "landing")
    landing.snapshot_rows_from_driver(spark, SF, 5).write.mode("append").json(land)
    root = tempfile.mkdtemp(prefix="tidemark-store-")
    ckpt = str(tmp_path / "stream")
    first = run_available_now(spark, land, root, stream_checkpoint=ckpt)
    assert first == [1]
    landing.snapshot_rows_from_driver(spark, SF, 6).write.mode("append").json(land)
    second = run_available_now(spark, land, root, stream_checkpoint=ckpt)
    assert second == [2]
    assert run_available_now(spark, land, root, stream_checkpoint=ckpt) == []
    runs = Store(spark, root).load().dim_etl_run
    assert runs.count() == 2
