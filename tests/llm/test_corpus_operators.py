"""Operators that compare documents with each other, against brute force and on odd input."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat, common, lm, queries, repeats, simhash
from tidemark.llm import components as components_module
from tidemark.llm.components import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def corpus(seed=2, n=120):
    """Documents with copies, near copies, shared passages, runs, odd rows and repeated rows."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["The", "é"]
    passage = [rng.choice(words) for _ in range(70)]
    rows = []
    for k in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        if k % 5 == 1:
            w = rows[-1][1].split() if rows[-1][1] else []
        if k % 5 == 2 and rows[-1][1]:
            w = rows[-1][1].split()
            if w:
                w[rng.randrange(len(w))] = "changed"
        if k % 9 == 4:
            w[3:3] = passage[rng.randrange(20):]
        if k % 13 == 6:
            w += ["ha"] * rng.randint(20, 90)
        rows.append((k, " ".join(w), "en", "s", len(w)))
    rows += [(500, None, None, None, None), (501, "", None, None, None), (502, " \n ", None, None, None), rows[7],
             (None, rows[9][1], None, None, None), (None, None, None, None, None), (503, "one", None, None, None),
             (504, "ab " * 400, None, None, None), (505, "x y " * 300, None, None, None), (506, "x y " * 300, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).withColumn("fp", F.lit("clash"))


# ------------------------------------------------------------------- SimHash
def fingerprint(text, size=4):
    w = SPACE.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(codes, limit):
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= limit:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {c: find(c) for c in codes}


@pytest.mark.parametrize("block", [100_000, 5])
def test_simhash_components(docs, block):
    got = simhash.near_duplicates(docs, block=block).select("doc_id", simhash.hex16(F.col("fp")).alias("f"), "component_id").collect()
    rows = corpus()
    codes = [fingerprint(r[1]) for r in rows]
    root = brute_components(set(codes), 4)
    smallest = {}
    for r, c in zip(rows, codes, strict=True):
        if r[0] is not None:
            smallest[root[c]] = min(smallest.get(root[c], r[0]), r[0])
    want = [(r[0], f"{c:016x}", smallest.get(root[c])) for r, c in zip(rows, codes, strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_hierarchy_finds_every_link():
    rng = np.random.default_rng(0)
    for _ in range(25):
        heads = rng.integers(0, 2**64, size=6, dtype=np.uint64)
        codes = heads[rng.integers(0, 6, 150)].copy()
        for k in range(150):
            for b in rng.integers(0, 64, rng.integers(0, 8)):
                codes[k] ^= np.uint64(1) << np.uint64(b)
        codes = np.unique(codes)
        a, b = simhash.bucket_edges(np.zeros(len(codes), int), codes, 4)
        want = brute_components([int(c) for c in codes], 4)
        got = brute_components([int(c) for c in codes], -1)
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = got[x], got[y]
            got = {k: (min(p, q) if v in (p, q) else v) for k, v in got.items()}
        assert len({frozenset(k for k in got if got[k] == v) for v in got.values()}
                   ^ {frozenset(k for k in want if want[k] == v) for v in want.values()}) == 0


def test_blocks_cannot_miss_a_pair():
    masks, rng = simhash.block_masks(4), random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_components_of_long_paths_and_empty(spark):
    path = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert {got[k] for k in range(61)} == {0} and got[101] == 100
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_stars_take_no_round_and_narrow_tables(spark, monkeypatch):
    from tidemark.llm import components as module

    tables = []
    write = module.written
    monkeypatch.setattr(module, "written", lambda df, label, narrow=False: tables.append(narrow) or write(df, label, narrow))
    stars = [(k, 0) for k in range(1, 150)] + [(7, 0), (300, 301), (5, 5), (None, 3)]
    got = sorted((r["node"], r["root"]) for r in components(spark.createDataFrame(stars, "a long, b long")).collect())
    assert got == [(k, 0) for k in range(150)] + [(300, 300), (301, 300)] and tables == [True]
    twice = [(5, 1), (5, 2), (9, 5), (12, 11)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(twice, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 9: 1, 11: 11, 12: 11} and all(tables)


def test_components_beyond_a_hundred_rounds_of_the_old_limit_and_of_hot_nodes(spark):
    """A long path, random edges, and a star whose centre has most of the edges."""
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(0, 900)] + [(5000, 6000 + k) for k in range(3000)] \
        + [(rng.randrange(20_000, 20_400), rng.randrange(20_000, 20_400)) for _ in range(250)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in {y for e in edges if e[0] != e[1] for y in e}}


def test_hot_nodes_are_not_shuffled(spark):
    star = spark.createDataFrame([(1, k) for k in range(2, 3000)], "a long, b long")
    plan = components_module._least(star, 2998)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "m" in components_module._least(star, 2998).columns
    assert {r["m"] for r in components_module._least(star, 2998).collect()} == {2}


def test_simhash_empty_table(docs):
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# --------------------------------------------------------------- recompression
def brute_repeats(rows, window):
    texts = [SPACE.findall(r[1] or "") for r in rows]
    count = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, texts, strict=True):
        gone = {p for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for p in range(i, i + window)}
        out.append((r[0], len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window,limit", [(35, 2_000_000), (35, 0), (12, 2_000_000)])
def test_repeats_brute_force(docs, window, limit):
    got = repeats.remove_repeats(docs, window=window, broadcast_bytes=limit).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == \
        sorted(brute_repeats(corpus(), window), key=str)
    for r in got:
        assert sum(s["stop"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_repeats_texts_of_one_id(spark):
    """Different texts without an id whose 32-bit hashes are equal keep their own windows."""
    made = spark.range(300_000).select(F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), "id") for k in range(6)]).alias("text"))
    pair = made.groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).where(F.size("t") > 1).first()["t"][:2]
    rows = [(None, pair[0]), (None, pair[1] + " tail"), (None, pair[1]), (7, pair[1]), (7, pair[0] + " " + pair[0])]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=3).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == \
        sorted(brute_repeats(rows, 3), key=str)


def test_repeats_empty_table(docs):
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_equal_substrings_get_equal_symbols():
    rng = random.Random(4)
    words = [f"v{k}".encode() for k in range(5)]
    for _ in range(40):
        shared = [rng.choice(words) for _ in range(40)]
        texts = [[rng.choice(words) for _ in range(rng.randint(0, 9))] + shared + [rng.choice(words) for _ in range(9)]
                 for _ in range(2)]
        p = repeats.parse(texts)
        at = [len(t) - 49 for t in texts]
        inside = []
        for d in range(2):
            off = p.first[d] + at[d]
            own = (p.doc == d) & (p.low >= off) & (p.high <= off + 40)
            inside.append({(int(n), int(s - off), int(e - off)) for n, s, e in
                           zip(p.name[own], p.start[own], p.stop[own], strict=True)})
        # whatever depends on the shared words only is in both parses
        assert inside[0] == inside[1]


# ------------------------------------------------------------------ LM scoring
def all_segmentations(word, vocab):
    arcs = {}
    codes = np.array([ord(c) for c in word])
    start, size, piece = vocab.arcs(codes, np.arange(len(word), 0, -1))
    for s, n, p in zip(start.tolist(), size.tolist(), piece.tolist(), strict=True):
        arcs.setdefault(s, []).append((s + n, sum(vocab.logp[x] for x in vocab.spelled(-1 - p)) if p < 0 else vocab.logp[p]))

    def total(i):
        return 1.0 if i == len(word) else sum(math.exp(lp) * total(j) for j, lp in arcs[i])
    return math.log(total(0))


def test_lattice_sums_all_segmentations():
    vocab = lm.Vocabulary.load(queries.piece_vocabulary())
    words = ["▁the", "▁thintion", "▁日本x", "▁a", "▁👍é", "▁onandthe"]
    got = lm.lattice(words, vocab)
    assert got == pytest.approx([all_segmentations(w, vocab) for w in words], abs=1e-9)
    gain = np.zeros(len(vocab.logp))
    lm.lattice(words, vocab, np.ones(len(words)), gain)
    # expected counts spell every character (or byte) of the words once
    assert gain.min() >= 0 and len(words) <= gain.sum() <= sum(len(w.encode()) for w in words)
    long = "▁" + "ab" * 5000
    assert np.isfinite(lm.lattice([long], vocab)[0])
    assert math.log(np.exp(vocab.logp[np.isfinite(vocab.logp)]).sum()) == pytest.approx(0, abs=1e-9)


@pytest.mark.parametrize("frequent", [200_000, 10])
def test_lm_query_brute_force(spark, docs, frequent):
    learn = ~common.in_fold(F.col("doc_id"), 7, 2)
    got = lm.score(docs, learn, lm.Vocabulary.load(queries.piece_vocabulary()), frequent=frequent).collect()
    rows = corpus()
    assert len(got) == len(rows)

    def tokens(t):
        return [*SPACE.findall((t or "").translate(LOWER)), None]
    known = Counter(w for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2 for w in tokens(r[1]))
    n, v = sum(known.values()), len(known)
    want = sorted(((r[0], len(tokens(r[1])), sum(known[w] > 0 for w in tokens(r[1])), n,
                    round(sum(math.log10((known[w] + 1) / (n + v + 1)) for w in tokens(r[1])), 6)) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got),
                  key=str) == want
    assert all(r["score"] < 0 for r in got)
    by_text = {}
    for r, g in zip(sorted(rows, key=lambda r: str(r[0])), sorted(got, key=lambda g: str(g["doc_id"])), strict=True):
        if r[0] is not None:
            by_text.setdefault(" ".join(SPACE.findall(r[1] or "")), set()).add(round(g["score"], 6))
    assert all(len(s) == 1 for s in by_text.values())


def test_lm_learns(spark):
    vocab = lm.Vocabulary.load(queries.piece_vocabulary())
    docs = common.table(spark, SF, "documents")
    learn = ~common.in_fold(F.col("doc_id"), 7, 2)
    total = [lm.score(docs, learn, vocab, em_steps=k).where("not learned").agg(F.sum("score")).first()[0] for k in (0, 2)]
    assert total[1] > 0.8 * total[0] and total[1] > total[0]
    assert lm.score(docs.limit(0), learn, vocab).count() == 0
    alone = lm.score(docs, F.lit(False), vocab).first()
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0


# ------------------------------------------------------------------------ chat
def turns(*pairs):
    return [{"role": r, "text": t} for r, t in pairs]


def test_preferences(spark):
    u, a, b = ("user", "hi"), ("assistant", "yes é"), ("assistant", "no")
    rows = [(1, turns(u, a), turns(u, b)), (2, turns(u, a), turns(u, a)), (3, turns(u, a, u, b), turns(u, a)), (4, None, turns(u)),
            (5, turns(), turns()), (6, turns(a, u), turns(b, u)), (1, turns(u, a), turns(u, b)), (7, turns((None, None)), turns(u))]
    pairs = spark.createDataFrame(rows, f"id long, chosen {chat.TURNS}, rejected {chat.TURNS}")
    got = chat.format_preferences(pairs).collect()
    by = {r["id"]: r for r in got}
    assert len(got) == len(rows)
    assert by[1]["prompt"] == "<|user|>\nhi<|end|>\n" and by[1]["chosen"] == "<|assistant|>\nyes é<|end|>\n"
    for r in got:
        for side in ("chosen", "rejected"):
            for m in r[f"{side}_mask"]:
                assert r[side][m["start"]:m["stop"]].endswith("<|end|>") and not r[side][m["start"]:].startswith("<|")
            assert len(r[f"{side}_mask"]) == r[side].count("<|assistant|>")
    assert (by[2]["n_prompt_turns"], by[2]["chosen"], by[2]["rejected"]) == (2, "", "")
    assert (by[3]["n_prompt_turns"], by[3]["rejected"]) == (2, "")
    assert (by[4]["prompt"], by[4]["chosen"], by[4]["n_prompt_turns"]) == ("", "", 0)
    assert by[6]["n_prompt_turns"] == 0


def test_pairs_from_turns(spark):
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "r"), (3, 1, "assistant", "s"), (3, 0, "user", "p"), (3, 2, "user", "t"),
            (4, 0, "user", "alone"), (6, 0, "assistant", None), (None, 0, "user", "x"), (2, 1, "assistant", "r")]
    convs = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["id"]: ([t["text"] for t in r["chosen"]], [t["text"] for t in r["rejected"]])
           for r in chat.swapped_pairs(convs).collect()}
    assert got == {2: (["q", "r"], ["q", "s", "t"]), 3: (["p", "s", "t"], ["p", "r"]), 4: (["alone"], ["alone"]), 6: ([""], [])}
    alone = chat.format_preferences(chat.swapped_pairs(convs)).where("id = 4").first()
    assert (alone["n_prompt_turns"], alone["prompt"], alone["chosen"], alone["rejected"]) == (1, "<|user|>\nalone<|end|>\n", "", "")
    assert chat.format_preferences(chat.swapped_pairs(convs.limit(0))).count() == 0


def test_every_conversation_has_a_row(spark):
    turns = common.table(spark, SF, "conversations")
    assert queries.op10_preferences(spark, SF).count() == turns.select("conv_id").distinct().count()


# -------------------------------------------------------------------- pipeline
def test_pipeline_stages_on_odd_rows(spark, docs):
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = common.written(stage(spark, now, SF), name)
        if name != "encoding":
            assert now.columns == docs.columns, name
        if name in ("personal_data", "encoding"):
            assert now.count() == before.count()
    rows = now.collect()
    assert all(r["exact"] for r in rows) and all(r["n_tokens"] == len(r["ids"]) for r in rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    codes = {fingerprint(r[1]) for r in corpus()}
    assert len(kept) == len(set(brute_components(codes, 4).values()))       # one row for each component
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_pipeline_run_and_entry(spark):
    import __spark_entry__ as entry

    out = entry.queries()["pipeline"](spark, SF)
    assert {"doc_id", "text", "ids", "n_tokens"} <= set(out.columns) and 0 < out.count() < 200
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
