"""Token store, whitening and Merkle manifest against the library, numpy and a plain Merkle tree; SQL twins of this part."""

import hashlib
import importlib.util
import zlib
from pathlib import Path
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import common, merkle, queries, tokenstore, whitening
from tidemark.sources.adapter import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_spec = importlib.util.spec_from_file_location("check_oracle_llm", Path(__file__).parents[2] / "check_oracle.py")
C = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(C)


def odd_rows():
    texts = [None, "", " ", "a", " b", "b ", "a  b", "a\n b", "a\n\n b c", "a \nb", "it's 'em", "x <|endoftext|> y<|endoftext|>", "é à ß.", "日本 語",
             "Word, word; (word) 12 3x", "tab\tand nbsp x  y", "word " * 30_000, "x" * 50_000, "don't... stop!", "ẞ ok", "A b C"]
    rows = [(k, t, ["en", None, "de", "é"][k % 4], "s" if k % 3 else None, k) for k, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, "no id", None, None, None), (None, None, None, None, None), (5, "another text", "en", None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).withColumn("ids", F.lit("clash")).withColumn("hash", F.lit("clash"))


# ------------------------------------------------------------------- token store
def test_token_store_equals_the_library(spark, docs):
    library = Tokenizer.from_file(queries.byte_vocabulary())
    store = tokenstore.write(docs, common.scratch(spark, "tokens"), queries.byte_vocabulary(), block_bytes=50)
    got = tokenstore.read(store).withColumn("n", tokenstore.integers(F.col("ids"))).orderBy("start").collect()
    assert [r["id"] for r in got] == sorted((r[0] for r in odd_rows()), key=lambda x: -1 if x is None else x)
    at, want = 0, {}
    for r in odd_rows():
        want.setdefault(r[0], []).append(library.encode(r[1] or "", add_special_tokens=False).ids + [0])
    for r in got:
        assert r["start"] == at and r["n"] in want[r["id"]] and r["n_tokens"] == len(r["n"])
        want[r["id"]].remove(r["n"])
        at += r["n_tokens"]
    assert not any(want.values()) and store.blocks.count() > 1
    assert {r["id"] for r in tokenstore.fetch(store, [5, 7, 999]).collect()} == {5, 7}
    assert tokenstore.fetch(store, []).count() == 0
    wrong = tokenstore.Store(store.blocks, b"another", store.width, 0)
    with pytest.raises(Exception, match="was written with dictionary"):
        tokenstore.read(wrong).collect()


def test_token_store_encodes_slices_and_asks_the_model_once_a_stem(monkeypatch):
    library = Tokenizer.from_file(queries.byte_vocabulary())
    with open(queries.byte_vocabulary(), encoding="utf-8") as f:
        encoder = tokenstore.Encoder(f.read())
    asked = []
    pieces = encoder.pieces
    monkeypatch.setattr(encoder, "pieces", lambda stems: asked.extend(stems) or pieces(stems))
    texts = ["first word word, word. WORD", "\0x word\0 \0", "", " ", "a  b word;", "other word!", "é word ßé, ßé"] + [r[1] or "" for r in odd_rows()]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(pa.array(texts).slice(0, 7)) == want[:7]
    assert sorted(asked) == sorted({"word", "WORD", "b", "ßé"})
    assert encoder.encode(pa.array(texts).slice(3)) == want[3:] and encoder.encode(texts) == want
    assert len(asked) == len(set(asked)) and encoder.encode([]) == []


def test_token_store_cuts_words_at_line_feeds_and_marks():
    library = Tokenizer.from_file(queries.byte_vocabulary())
    with open(queries.byte_vocabulary(), encoding="utf-8") as f:
        encoder = tokenstore.Encoder(f.read())
    asked = []
    real = encoder.library
    encoder.library = SimpleNamespace(
        model=real.model, encode_batch_fast=lambda texts, **how: asked.extend(texts) or real.encode_batch_fast(texts, **how))
    names = [a + b for a in ("Wer", "las", "Né") for b in ("on", "tis", "ére", "anth")]
    texts = [f"x {a}.\n{b}, y" for a in names for b in names]
    assert encoder.encode(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert sum(map(len, asked)) < 10 * len(names)       # each word once, not each pair of words around a line feed


@pytest.mark.parametrize("cache, size", [(300_000, 1 << 26), (20, 1 << 26), (300_000, 100)])
def test_token_store_cuts_anywhere_as_the_library(monkeypatch, cache, size):
    monkeypatch.setattr(tokenstore, "CACHE", cache)
    monkeypatch.setattr(tokenstore, "CACHE_BYTES", size)
    library = Tokenizer.from_file(queries.byte_vocabulary())
    with open(queries.byte_vocabulary(), encoding="utf-8") as f:
        encoder = tokenstore.Encoder(f.read())
    around = [chr(c) for c in [*range(0x300), 0x1680, 0x180E, *range(0x2000, 0x2060), 0x3000, 0x65E5, 0x1F600]]
    rng = np.random.default_rng(7)
    odd = ["", " ", "\n", "\t", "\xa0", "\u2003", "\u201c", "'s", "'", ".", "1", "a", "\u00d7", "\u00e9", "\u0250", " word"]
    texts = [f"a{c}b {c}c\n{c} x{c}.{c}{c}\n\n{c}1 {c}" for c in around] + ["".join(rng.choice(odd, 12)) for _ in range(1000)]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    got = [x for k in range(0, len(texts), 300) for x in encoder.encode(pa.array(texts).slice(k, 300))]
    assert got == want and encoder.encode(["", ""]) == [b"", b""]


def test_token_store_empty_table(spark, docs):
    store = tokenstore.write(docs.limit(0), common.scratch(spark, "tokens"), queries.byte_vocabulary())
    assert tokenstore.read(store).count() == 0


def test_query_reads_its_files_back(spark):
    library = Tokenizer.from_file(queries.byte_vocabulary())
    at, want = 0, []
    for r in common.table(spark, SF, "documents").orderBy("doc_id").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in queries.op11_token_store(spark, SF).collect()) == want


# --------------------------------------------------------------------- whitening
def test_rank_one_updates_and_merges_are_eigendecompositions():
    rng = np.random.default_rng(3)
    for dim, n in ((1, 5), (2, 3), (6, 4), (12, 200)):
        x = np.round(rng.normal(size=(n, dim)) * 5)
        x[: n // 2] = x[0]
        parts = []
        for part in np.array_split(x, 3):
            s = whitening.Spectrum.empty(dim)
            for v in part:
                s.add(v, 1.0)
            parts.append(s)
        s = parts[0].merge(parts[1]).merge(parts[2])
        y = x - x.mean(0)
        scale = max(1.0, np.abs(y.T @ y).max())
        assert np.allclose(s.basis * s.values @ s.basis.T, y.T @ y, atol=1e-10 * scale)
        assert np.allclose(s.basis.T @ s.basis, np.eye(dim), atol=1e-10) and np.allclose(s.mean, x.mean(0))


def brute(vectors, k):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors])
    n, total = len(x), x.sum(0)
    y = (n * x - total) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    return x, n, total, e[::-1], y @ (u[:, ::-1][:, :k] / np.sqrt(e[::-1][:k])), e.sum()


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(5)
    good = [[float(c) for c in v] for v in rng.normal(size=(300, 6)) * [3, 2, 1.5, 1, 0.7, 0.5]]
    good += [good[0]] * 150
    odd = [None, [], [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("inf")] * 6, [1.0] * 5, [1e30] * 6]
    rows = [(k, v, 0) for k, v in enumerate(good)] + [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(None, good[3], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").repartition(7)
    got = whitening.whiten(df, components=4).collect()
    assert len(got) == 451 * 4
    x, n, total, e, want, trace = brute([*good, good[3]], 4)
    by = {}
    for r in got:
        by.setdefault(r["id"], {})[r["component"]] = r
    signs = np.sign([by[0][c]["whitened"] * want[0][c - 1] for c in (1, 2, 3, 4)])
    for k in range(len(good)):
        assert np.allclose([by[k][c]["whitened"] for c in (1, 2, 3, 4)] * signs, want[k], atol=1e-9)
        assert by[k][1]["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[k], total, strict=True))
    assert all(r["n"] == n and r["identity_error"] < 1e-9 for r in got)
    assert np.allclose([by[0][c]["explained"] for c in (1, 2, 3, 4)], e[:4] / trace)
    assert whitening.whiten(df.limit(0)).count() == 0


def test_whitening_without_variance(spark):
    df = spark.createDataFrame([(k, [1.0, 2.0, float(k % 2)]) for k in range(6)], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert len(got) == 18 and all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    one = whitening.whiten(df.limit(1)).collect()
    assert len(one) == 3 and all(r["whitened"] is None and r["deviation"] == 0 for r in one)


# ------------------------------------------------------------------------ Merkle
def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def raised(nodes):
    return [h("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]


def plain_tree(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row."""
    def leaf(r, text):
        fields = [r[0], r[3], r[2], r[4], text]
        return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    groups, out = {}, []
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        levels = [[leaf(r, r[1]) for r in mine]]
        while len(levels[-1]) > 1:
            levels.append(raised(levels[-1]))
        trees[g] = mine, levels
    top = [[trees[g][1][-1][0] for g in order]]
    while len(top[-1]) > 1:
        top.append(raised(top[-1]))
    for t, g in enumerate(order):
        mine, levels = trees[g]
        for k, r in enumerate(mine):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            text = r[1].translate({i: i + 32 for i in range(65, 91)}) if hit else r[1]
            folded, proof = leaf(r, text), ""
            for at, nodes in [(k, levels[:-1]), (t, top[:-1])]:
                for level in nodes:
                    run, slot = level[at // 8 * 8: at // 8 * 8 + 8], at % 8
                    proof += "".join(run[:slot] + run[slot + 1:])
                    folded, at = h("".join([*run[:slot], folded, *run[slot + 1:]])), at // 8
            out.append((r[0], levels[0][k], levels[-1][0], top[-1][0], h(proof), folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("bound", [20_000, 0, 3])
def test_manifest_brute_force(spark, docs, tmp_path, monkeypatch, bound):
    more = [(100 + k, f"Text {k % 7}", "fr" if k % 5 else f"l{k}", "s", k) for k in range(300)]
    rows = odd_rows() + more
    spark.createDataFrame(rows, SCHEMA).withColumn("hash", F.lit("clash")).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    build = merkle.build
    monkeypatch.setattr(merkle, "build", lambda *a, **k: build(*a, broadcast_nodes=bound, **k))
    got = [tuple(r) for r in queries.op13_manifest(spark, str(tmp_path)).collect()]

    def key(r):
        return tuple("" if v is None else str(v) for v in r)
    assert sorted(got, key=key) == sorted(plain_tree(rows), key=key)


def test_manifest_leaves_bring_their_run(spark, docs):
    """The level above the leaves, seven of eight nodes, is joined by no shuffle, however few nodes are broadcast."""
    tree = merkle.build(docs.where("doc_id IS NOT NULL").select(*merkle.FIELDS)
                        .unionByName(spark.range(1000, 1120).selectExpr("id doc_id", "'s' source", "'fr' lang", "1 n_chars", "'t' text")),
                        broadcast_nodes=12)
    assert tree.lower is None                           # 15 nodes and more stand above the leaves
    climbed = merkle.climb(tree).collect()
    assert climbed and all(r["folded"] == tree.root for r in climbed)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_manifests(spark, tmp_path, n):
    rows = [(k, "T", f"l{k}", None, None) for k in range(n)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op13_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(plain_tree(rows) if n else [])


# --------------------------------------------------------------------- SQL twins
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(queries.SQL[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(got) == len(want)
    assert C.digest(df.columns, got) == C.digest(cols, want)


@pytest.mark.parametrize("name", ["op5_licenses", "op8_pii", "op9_decontamination", "op10_preferences"])
def test_native_queries_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("EvalPython", "PythonUDF", "InPandas", "InArrow"))
