"""Every registered warehouse query against its DuckDB twin on the smoke data (sf0.001)."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

from tidemark.plans import catalog
from tidemark.sources.adapter import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).parents[1]

_spec = importlib.util.spec_from_file_location("spark_entry_oracle", ROOT / "__spark_entry__.py")
E = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(E)

_check_spec = importlib.util.spec_from_file_location("check_oracle_mod", ROOT / "check_oracle.py")
C = importlib.util.module_from_spec(_check_spec)
_check_spec.loader.exec_module(C)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert C.digest(df.columns, srows) == C.digest(dcols, drows)
