"""Operators that work row by row, against brute force and on odd input."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, decontaminate, licenses, pii, quality, queries, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def odd_rows():
    rng = random.Random(5)
    pieces = ["a", "The", "é", "日本", " ", "  ", "\n", "\t", "<|endoftext|>", "1", "23", "mit license", "!", "'s", "\x85", "👍",
              "general public license", "a@b.co", "1.2.3.4", "+49 30 1234567", "4111 1111 1111 1111", "|", "###"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += [None, "", " \n\t ", "word " * 30_000, "x" * 40_000, "same line\n" * 50, "ha " * 60]
    rows = [(k, t, None if k % 7 == 0 else "en", "s", None) for k, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, "no id here", None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def model():
    return bpe.Model.load(queries.byte_vocabulary())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.byte_vocabulary())


def test_bpe_equals_the_library(odd, model, library):
    got = bpe.decode(bpe.encode(odd, model), model).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_bpe_coded_and_decoded_in_one_worker(spark, odd, model, library):
    """op3_bpe runs one Python evaluation a task; two at a time took an executor beyond its memory."""
    both = bpe.decode(bpe.encode(odd, model, together=True), model)
    got = both.collect()
    assert both.columns == [*odd.columns, "ids", "decoded"] and len(got) == len(odd_rows())
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    plan = queries.op3_bpe(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    clash = bpe.decode(bpe.encode(spark.createDataFrame([("keep", "ab cd")], "ids string, text string"), model, together=True), model)
    assert clash.columns == ["ids", "text", "ids_", "decoded"] and clash.first()["decoded"] == "ab cd"


def test_bpe_columns_that_clash_and_empty_table(spark, model):
    df = spark.createDataFrame([("keep", "ab cd")], "ids string, text string")
    out = bpe.encode(df, model)
    assert out.columns == ["ids", "text", "ids_"] and out.first()["ids"] == "keep"
    assert bpe.encode(df.limit(0), model).count() == 0
    broken = spark.createDataFrame([([65, 999_999, -1],), (None,)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(broken, model).collect()] == [model.token[65].decode(), ""]


def test_bpe_speculation_is_verified(model):
    rng = random.Random(1)
    pieces = ["".join(rng.choice("aabtheionsngr ") for _ in range(rng.randint(1, 14))).encode() for _ in range(3000)]
    ids, exact = model.encode_pieces(pieces)
    assert ids == [model.merge(p) for p in pieces]
    assert 0 < exact < len(pieces)                       # some proposals stand, some are merged exactly


def test_fingerprint_of_query_digests(spark):
    row = queries.op3_bpe(spark, SF).orderBy("doc_id").first()
    text = common.table(spark, SF, "documents").where("doc_id = 0").first()["text"]
    assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_decontamination_brute_force(spark, odd):
    words = [f"w{k}" for k in range(40)]
    docs = odd.unionByName(spark.createDataFrame(
        [(1000, " ".join(words), None, None, None), (1001, "x " + " ".join(words[5:16]) + " y W5 w6", None, None, None),
         (1002, "Ab. ha! ha", None, None, None)], SCHEMA))
    items = spark.createDataFrame(
        [(1, " ".join(words[:14])), (2, " ".join(words[3:14])), (3, "ab ha"), (4, None), (5, ""), (6, " ".join(["ha"] * 12)),
         (2, " ".join(words[3:14])), (None, "no id here"), (7, "word")], "item_id long, text string")
    window = {}
    for r in items.collect():
        w = WORD.findall((r["text"] or "").translate(LOWER))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            window.setdefault(tuple(w[i:i + n]), set()).add(str(r["item_id"]) if r["item_id"] is not None else None)
    for limit in (200_000, 0):                           # broadcast windows, shuffled windows
        got = decontaminate.contamination(docs, items, broadcast_windows=limit).collect()
        want = []
        for r in docs.collect():
            w, hit, ids = WORD.findall((r["text"] or "").translate(LOWER)), set(), set()
            for n in {len(k) for k in window}:
                for i in range(len(w) - n + 1):
                    if tuple(w[i:i + n]) in window:
                        hit.update(range(i, i + n))
                        ids |= window[tuple(w[i:i + n])]
            want.append((r["doc_id"], len(w), len(hit), sorted(x for x in ids if x is not None)))
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=str) == sorted(want, key=str)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}


def test_decontamination_result_has_few_parts(spark, odd):
    """Each part is a file, and each file makes an executor fork: the result takes no part for each shuffle partition."""
    settings = {"spark.sql.shuffle.partitions": "80", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        items = spark.createDataFrame([(1, "ab ha")], "item_id long, text string")
        assert decontaminate.contamination(odd, items).rdd.getNumPartitions() <= 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_decontamination_long_texts_and_ties(spark):
    """Long texts of few distinct words, whose windows are full of equal hashes, against all windows."""
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(list("ab"), 4000)), " ".join(rng.choice(list("abc"), 30_000)), "a " * 5000,
             " ".join(rng.choice(["x", "y y"], 2000))]
    items = [" ".join(texts[0].split()[k:k + 13]) for k in (0, 1700, 3987)] + [" ".join(rng.choice(list("abc"), 12)) for _ in range(40)] + ["a " * 11]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for limit in (200_000, 0):
        got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench, broadcast_windows=limit).collect()}
        for k, t in enumerate(texts):
            w, hit, ids = t.split(), set(), set()
            have = {}
            for i in range(len(w) - 9):
                have.setdefault(tuple(w[i:i + 10]), []).append(i)
            for n, item in enumerate(items):
                v = item.split()
                for i in range(len(v) - 9):
                    for at in have.get(tuple(v[i:i + 10]), []):
                        hit.update(range(at, at + 10))
                        ids.add(str(n))
            assert (got[k]["n_words"], got[k]["n_hit"], got[k]["items"]) == (len(w), len(hit), sorted(ids))


def test_decontamination_shuffles_no_text(spark):
    """Beyond the broadcast, the exchange below the join has the words around a fingerprint, not the text's arrays."""
    docs = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(3000)))], "_id long, _text string")
    bench = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(100, 130))), (2, "w5 w6")], "item_id long, text string")
    windows = common.written(decontaminate.item_windows(bench, 10, 4, "item_id", "text"), "windows")
    out = decontaminate.hits(docs, windows, ["_id"], broadcast_windows=0)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark._jvm.PythonSQLUtils.explainString(out.select("*")._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((_?key)#", plan)
    assert exchanges and not [x for x, _ in exchanges if re.search(r"\b_(h|g|text)#", x)]
    assert [r["n"] for r in out.selectExpr("size(wins) as n").collect()] == [22]


def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def test_pii_base_spans_brute_force(spark, odd):
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@x", "x.y", "1", "25", "256", "00", "4", "4111111111111111", " ", "-", ".", "+1", "(", "é", "_", "%"]
    more = [(5000 + k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14))), None, None, None) for k in range(600)]
    more += [(9000, "a" * 30_000 + "@b.c", None, None, None), (9001, "1 " * 9_000, None, None, None)]
    docs = odd.unionByName(spark.createDataFrame(more, SCHEMA)).withColumn("pii", F.lit("clash"))
    out = pii.sanitise(docs)
    rows = out.select("doc_id", "text", "pii", pii.joined_spans("pii_").alias("s"), "clean_text").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["s"] == base_spans(r["text"] or "") and r["pii"] == "clash"
        if not r["s"]:
            assert r["clean_text"] == r["text"]
        else:
            assert r["clean_text"] != r["text"] and re.search("<(EMAIL|IP|CARD|PHONE)>", r["clean_text"])
    assert pii.sanitise(docs.limit(0)).count() == 0


def test_pii_terms_that_give_an_entity_away(spark):
    plain = [(k, f"plain words of document {k} and nothing more", None, None, None) for k in range(40)]
    told = [(100 + k, f"number {k}: ask kowalski at kk@ex.org and so on {k}", None, None, None) for k in range(5)]
    common_word = [(200 + k, f"and so on {k * 7} they ask", None, None, None) for k in range(30)]
    out = pii.sanitise(spark.createDataFrame(plain + told + common_word, SCHEMA)).where("doc_id between 100 and 104").collect()
    for r in out:
        gone = {r["text"][t["start"]:t["stop"]] for t in r["terms"]}
        assert "kowalski" in gone and "and" not in gone and "ask" not in gone
        assert "kowalski" not in r["clean_text"] and "<EMAIL>" in r["clean_text"]


def test_pii_entity_of_a_single_text(spark):
    """One text is little evidence: only the base value goes, no rare word of its text."""
    plain = [(k, f"plain words of document {k} and so on, they ask", None, None, None) for k in range(40)]
    told = [(100, "words: ask kowalski at kk@ex.org and so on", None, None, None)]
    docs = spark.createDataFrame(plain + told, SCHEMA)
    r = pii.sanitise(docs).where("doc_id = 100").first()
    assert r["terms"] == [] and r["clean_text"] == "words: ask kowalski at <EMAIL> and so on"
    assert {x["term"]: round(x["share"], 6) for x in pii.score(docs).shares.collect()}["kowalski"] == 0.25


def test_pii_shares_brute_force(spark):
    """All shares of a small corpus, entities of one and of several texts, copies counted once."""
    rng = random.Random(12)
    words = [f"w{k}" for k in range(25)]
    texts = [" ".join(rng.choice(words) for _ in range(8)) + rng.choice(["", "", " a@b.co", " Kim k.k@x.org", " kim K.K@x.org and a@b.co"])
             for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(texts + texts[:20])], SCHEMA)
    scores = pii.score(docs)
    got = {}
    for r in scores.entities.join(scores.shares, pii.UNIT).collect():
        got[r["value"], r["term"]] = (r["n_e"], r["n_t"], r["n_te"], r["share"])
    own, of = {}, {}
    for t in {t or "" for t in texts} | {None}:
        low = (t or "").lower()
        mails = set(re.findall(r"[a-z.]+@[a-z]+\.[a-z]+", low))
        of[t] = (set(WORD.findall(low)), set(WORD.findall(re.sub(r"[a-z.]+@[a-z]+\.[a-z]+", " ", low))), mails)
    total = len(of)
    for mail in {m for _, _, ms in of.values() for m in ms}:
        for term in {w for _, rest, ms in of.values() if mail in ms for w in rest}:
            n_e = sum(mail in ms for _, _, ms in of.values())
            n_t = sum(term in every for every, _, _ in of.values())
            n_te = sum(mail in ms and term in rest for _, rest, ms in of.values())
            low = min(n_t, n_e)
            own[mail, term] = (n_e, n_t, n_te, np.log(n_te * total / (n_t * n_e)) / np.log(total / n_e) * n_te / (n_te + 1) * low / (low + 1))
    assert set(got) == set(own) and len(got) > 40
    for k, v in own.items():
        assert got[k][:3] == v[:3] and abs(got[k][3] - v[3]) < 1e-9, k


def test_pii_terms_far_from_the_entity_and_in_texts_without_it(spark):
    filler = "plain words and so on, they ask. " * 40
    plain = [(k, f"{filler} {k}", None, None, None) for k in range(60)]
    told = [(100 + k, f"Kowalski {filler} kk@ex.org {filler} KOWALSKI {k}", None, None, None) for k in range(10)]
    alone = [(200, "They ask Kowalski.", None, None, None), (None, "They ask Kowalski.", None, None, None)]
    rows = pii.sanitise(spark.createDataFrame(plain + told + alone, SCHEMA)).collect()
    assert len(rows) == 72
    for r in rows:
        assert "kowalski" not in r["clean_text"].lower()
        if r["doc_id"] is None or r["doc_id"] == 200:
            assert r["clean_text"] == "They ask ." and [tuple(t) for t in r["terms"]] == [(9, 17, "remove")]
        elif r["doc_id"] >= 100:
            assert "<EMAIL>" in r["clean_text"] and "they ask" in r["clean_text"]
        else:
            assert r["clean_text"] == r["text"]


def test_license_places_and_spans(spark, odd):
    notice = "Licensed under the Apache License, Version 2.0."
    docs = odd.unionByName(spark.createDataFrame(
        [(1000, "x " + notice + " y", None, None, None), (1001, "Licensed under CC BY-NC 4.0.", None, None, None),
         (1002, "This program is free software; you can now redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation", None, None, None)], SCHEMA))
    got = {}
    rows = licenses.scan(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        got.setdefault(r["doc_id"], r)
    for d in docs.collect():
        w = WORD.findall((d["text"] or "").translate(LOWER))
        want = sorted((i, label) for label, p in licenses.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
        if d["doc_id"] is not None:
            assert [(p["start"], p["label"]) for p in got[d["doc_id"]]["places"]] == want
            assert got[d["doc_id"]]["n_words"] == len(w)
    assert {s["label"] for s in got[1000]["spans"]} == {"apache"}
    assert {s["label"] for s in got[1001]["spans"]} == {"cc-by-nc"}
    assert any(s["label"] == "gpl" and s["cover"] < 1 for s in got[1002]["spans"])   # one word more than the template
    assert licenses.scan(docs.limit(0)).count() == 0


def test_quality_base_counts(odd, spark):
    chain = quality.train(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"), lambda c: F.lit(True))
    rows = quality.judge(odd, chain).collect()
    assert len(rows) == odd.count()
    texts = {r[0]: r[1] for r in odd_rows()}
    for r in rows:
        if r["doc_id"] is None:
            continue
        t = texts[r["doc_id"]] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines, seen, dup = t.split("\n"), set(), 0
        for x in lines:
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in seen
                seen.add(x)
        count, hit = {}, set()
        for i in range(len(w) - 4):
            count.setdefault(tuple(w[i:i + 5]), []).append(i)
        for at in count.values():
            if len(at) > 1:
                hit.update(p for i in at for p in range(i, i + 5))
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(0)
    for _ in range(20):
        chain = quality.Chain(np.zeros(1), rng.normal(size=2), rng.normal(size=(2, 2)))
        gain = rng.normal(size=6)

        def score(s):
            return chain.first[s[0]] + sum(chain.change[a, b] for a, b in zip(s, s[1:], strict=False)) + (gain * np.array(s)).sum()
        best = max((tuple((k >> i) & 1 for i in range(6)) for k in range(64)), key=score)
        assert tuple(chain.viterbi(gain)) == best


def mixed_text(rng, good):
    """Lines with their states: mostly content in a good document, mostly boilerplate in a bad one."""
    vocabulary = [f"{a}{b}" for a in ("ban", "cor", "del", "mir", "sol", "tev") for b in ("a", "en", "ist", "or", "um")]
    lines, states = [], []
    for _ in range(rng.integers(3, 6)):
        state = int(rng.random() < (0.7 if good else 0.2))
        for _ in range(rng.integers(2, 5)):
            w = rng.choice(vocabulary, rng.integers(6, 15)).tolist()
            lines.append(" ".join(w) + "." if state else "!! ".join(w).upper() + " | ##")
            states.append(state)
    share = np.mean(states)
    return ("\n".join(lines), states) if (share >= 0.6) == good and (share <= 0.4) != good else mixed_text(rng, good)


def test_quality_labels_lines_inside_a_document(spark):
    """Trained from documents' labels only, the chain tells content from boilerplate lines of one document."""
    rng = np.random.default_rng(4)
    made = [(k, *mixed_text(rng, k % 2 == 1)) for k in range(160)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in made], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _, _ in made], "doc_id long, quality int")
    chain = quality.train(docs, labels, lambda c: c < 100)
    right = total = mixed = 0
    for r in quality.judge(docs.where("doc_id >= 100"), chain).collect():
        want = {k for k, s in enumerate(made[r["doc_id"]][2]) if not s}
        n = len(made[r["doc_id"]][2])
        right += n - len(want ^ set(r["boilerplate"]))
        total += n
        mixed += 0 < len(r["boilerplate"]) < n
    assert right >= 0.95 * total and mixed >= 30


def test_latent_states_keep_the_document_label():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, label = int(rng.integers(1, 9)), int(rng.integers(0, 2))
        gain, size = rng.normal(size=n), rng.integers(1, 20, n)
        state = quality.latent_states([gain], [size], [label])[0]
        assert ((size * state).sum() >= 0.5 * size.sum()) == (label == 1)
        changed = state != (gain >= 0)                   # only lines against the label, nearest to the boundary first
        assert (state[changed] == label).all()
        against = (gain >= 0) != label
        assert not changed.any() or np.abs(gain[changed]).max() <= np.abs(gain[against & ~changed]).min(initial=np.inf)


def test_quality_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    chain = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"), lambda c: F.lit(True))
    assert quality.judge(docs, chain).count() == 0


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = common.table(spark, sf, "labels").select("doc_id", "quality")
    rows = queries.op4_quality(spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    good = [r for r in held if r["quality"] == 1 and not r["base_failed"]]
    bad = [r for r in held if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.95 * len(good) and sum(r["kept"] for r in bad) <= 0.1 * len(bad)


def test_toxicity_held_out_and_odd_input(spark, odd):
    sf = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    model = queries.toxicity_model(spark, sf, docs)
    out = toxicity.score_toxicity(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    clean = [r for r in out if r["toxic"] == 0]
    known = [r for r in out if r["toxic"] == 1]
    assert sum(r["toxicity"]["score"] >= 0.5 for r in clean) <= 0.01 * len(clean)
    assert sum(r["toxicity"]["score"] >= 0.5 for r in known) >= 0.8 * len(known)
    for r in known:
        for s in r["toxicity"]["sentences"]:
            assert r["text"][s["start"]:s["stop"] if "stop" in s else s["end"]].strip()
    scored = toxicity.score_toxicity(odd.withColumn("toxicity", F.lit(1)), model)
    assert scored.count() == odd.count() and "toxicity_" in scored.columns
    assert all(0 <= r["toxicity_"]["score"] <= 1 for r in scored.collect())
    one_class = toxicity.train(docs, labels.where("toxic = 0"), lambda c: F.lit(True))
    assert len(one_class.index) == 0
    none = toxicity.train(docs, labels.limit(0), lambda c: F.lit(True))
    assert {r["toxicity"]["score"] for r in toxicity.score_toxicity(odd, none).collect()} == {0.0}
    assert max(r["toxicity"]["score"] for r in toxicity.score_toxicity(odd, one_class).collect()) < 0.05
