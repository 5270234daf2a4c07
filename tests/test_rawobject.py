"""The raw snapshot object in blocks against Python's JSON decoder."""

import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tidemark.sources import rawobject
from tidemark.sources.landing import read_snapshot_object

TEXTS = ["", "plain", "a } b", "{\"q\": 1}", "back\\slash", "tail\\", "quote \" }", "Ünï } 漢字", "[}", "},", "\\\"}", "line\nbreak"]


@pytest.fixture()
def small_blocks(spark):
    """Files are cut into blocks of 97 bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def payload(rng, n):
    """Members in order, repeated keys and odd values among them, as text."""
    out = []
    for _ in range(n):
        key = str(rng.randint(1, n))
        record = {"appid": int(key), "name": rng.choice(TEXTS), "ccu": rng.choice([None, 5, "7"]), "developer": rng.choice(TEXTS),
                  "tags": rng.choice([{}, {"x": 1, "y}": {"z": "{"}}, []]), "owners": rng.choice(TEXTS)}
        out.append((key, record if rng.random() > 0.1 else {}))
    gap = rng.choice(["", " ", "\n  "])
    ascii_only = rng.random() < 0.5
    body = f",{gap}".join(f"{json.dumps(k)}:{gap}{json.dumps(v, ensure_ascii=ascii_only, indent=rng.choice([None, 1]))}" for k, v in out)
    return f"{{{gap}{body}{gap}}}" + rng.choice(["", "\n", "  \n\n"]), out


def expected(members):
    first, value = {}, {}
    for i, (k, v) in enumerate(members):
        first.setdefault(k, i)
        value[k] = v
    text = lambda x: None if x is None else str(x)
    return sorted((first[k], k, *[text(v.get(f)) for f in ("appid", "name", "ccu", "developer", "owners")]) for k, v in value.items())


def found(spark, path):
    m = rawobject.members(spark, str(path), "struct<appid: string, name: string, ccu: string, developer: string, owners: string>")
    return sorted(tuple(r) for r in m.select("pos", "key", "v.*").collect())


@pytest.mark.parametrize("seed", range(4))
def test_blocks_equal_the_decoder(spark, small_blocks, tmp_path, seed):
    rng = random.Random(seed)
    text, members = payload(rng, rng.randint(1, 40))
    (tmp_path / "a.json").write_text(text)
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions() >= min(2, len(text.encode()) // 97)
    assert found(spark, tmp_path / "a.json") == expected(members)


def test_several_tasks_read_one_object(spark, small_blocks, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({str(k): {"appid": k, "name": "n" * 150} for k in range(30)}))
    blocks = rawobject.pieces(spark, str(tmp_path / "a.json")).select("block").distinct().count()
    assert blocks >= 20
    got = read_snapshot_object(spark, str(tmp_path / "a.json")).collect()
    assert sorted((r.pos, r.appid, len(r.name)) for r in got) == [(k, str(k), 150) for k in range(30)]


def test_odd_objects(spark, small_blocks, tmp_path):
    def rows(text):
        (tmp_path / "odd.json").write_text(text)
        return found(spark, tmp_path / "odd.json")
    none = (None,) * 5
    assert rows("{}") == rows(" { } \n") == rows("") == []
    assert rows('{"1": null, "2": {"appid": 2}, "3": 4}') == [(0, "1", *none), (0, "2", "2", None, None, None, None), (1, "3", *none)]
    assert rows('{"1": {}}') == [(0, "1", *none)]
    for text in ('{"1": {"appid": 1}', '{"1": {"appid": 1}, "2', '{"1": {"appid": 1}, "2": {"name": "x', '[{"appid": 1}]', '{"1": {}} x {}'):
        with pytest.raises((PySparkException, Py4JJavaError)):
            rows(text)


def test_a_key_in_two_files(spark, tmp_path):
    for name, value in (("a", 1), ("b", 2)):
        (tmp_path / f"{name}.json").write_text(json.dumps({"7": {"appid": 7, "ccu": value}, name: {"appid": 8}}))
    got = {r.key: r.v.ccu for r in rawobject.members(spark, str(tmp_path), "struct<ccu: string>").collect()}
    assert got == {"7": "2", "a": None, "b": None}
