"""Unit tables for the value parsers (owners range, money, weekday, snapshot rows)."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.parse import iso_weekday, owners_range, parse_money
from tidemark.operators.facts import parse_snapshot

OWNERS = [
    (None, None, None), ("", None, None), ("abc", None, None), ("1..2..3", None, None),
    ("100 ... 200", None, None), ("x .. 5", None, None), ("0 .. 20,000", 0, 20000),
    ("100,000,000 .. 200,000,000", 100000000, 200000000), ("  7 ..  9 ", 7, 9), ("9 .. 5", 9, 5),
]


def test_owners_range(spark):
    df = spark.createDataFrame([(o,) for o, _, _ in OWNERS], "o string")
    lo, hi = owners_range("o")
    got = [(r[0], r[1]) for r in df.select(lo, hi).collect()]
    assert got == [(a, b) for _, a, b in OWNERS]


MONEY = [
    (None, 100, Decimal("0.00")), ("", 100, Decimal("0.00")), ("0", 100, Decimal("0.00")),
    ("1999", 100, Decimal("19.99")), ("1998.5", 100, Decimal("19.98")), ("1999.5", 100, Decimal("20.00")),
    ("abc", 100, None), ("25", 1, Decimal("25.00")), ("12.125", 1, Decimal("12.12")), ("12.135", 1, Decimal("12.14")),
]


@pytest.mark.parametrize("text,scale,expected", MONEY)
def test_parse_money_half_even(spark, text, scale, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(parse_money("v", scale).cast("decimal(12,2)")).first()[0] == expected


def test_iso_weekday(spark):
    days = [datetime(2024, 1, d) for d in range(1, 8)]  # Monday .. Sunday
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    assert [r[0] for r in df.select(iso_weekday("ts")).collect()] == [1, 2, 3, 4, 5, 6, 7]


def _row(**kw):
    base = {f: None for f in schemas.SNAPSHOT_FIELDS}
    base.update(appid="10", name="A", owners="1 .. 2", price="1999", initialprice="0", discount="10")
    base.update(kw)
    return tuple([kw.get("pos", 0)] + [base[f] for f in schemas.SNAPSHOT_FIELDS])


def test_snapshot_quarantine_reasons(spark):
    rows = [
        _row(pos=0),
        _row(pos=1, appid=None),
        _row(pos=2, appid="x1"),
        _row(pos=3, owners="9 .. 5"),
        _row(pos=4, owners="3000000000 .. 4000000000"),
        _row(pos=5, ccu="12.5"),
        _row(pos=6, ccu="99999999999"),
        _row(pos=7, price="NaN"),
        _row(pos=8, discount="2000"),
        _row(pos=9, price="abc", owners="abc"),
        _row(pos=10, price="9999999999999"),
    ]
    raw = spark.createDataFrame(rows, schemas.SNAPSHOT_LINE)
    got = {r.pos: r for r in parse_snapshot(raw).collect()}
    assert got[0].reject_reason is None and got[0].price == Decimal("19.99") and got[0].discount == Decimal("10.00")
    assert got[1].reject_reason == "appid" and got[2].reject_reason == "appid"
    assert got[3].reject_reason == "owners_check"
    assert got[4].reject_reason == "owners_range"
    assert got[5].reject_reason == "int:ccu" and got[6].reject_reason == "int:ccu"
    assert got[7].reject_reason == "nan:price"
    assert got[8].reject_reason == "range:discount"
    # unparsable money / owners are NULL, not a reject
    assert got[9].reject_reason is None and got[9].price is None and got[9].owners_min is None
    assert got[10].reject_reason == "range:price"


def test_snapshot_object_reader_keeps_last_value_first_position(spark, tmp_path):
    from tidemark.sources.landing import read_snapshot_object
    p = tmp_path / "snap.json"
    p.write_text('{"10": {"appid": 10, "name": "old", "ccu": 5}, "20": {"appid": 20, "name": "b"},'
                 ' "10": {"appid": 10, "name": "new", "ccu": 7}}')
    df = read_snapshot_object(spark, str(p))
    rows = sorted((r.pos, r.appid, r.name, r.ccu) for r in df.collect())
    assert rows == [(0, "10", "new", "7"), (1, "20", "b", None)]
