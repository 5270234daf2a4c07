"""The registered queries of this subpackage: one per operator, and the SQL of those that SQL can express.

A query applies its operator to the whole table and reduces the operator's real
outputs (ids, spans, texts) to the digest columns of its contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, chat, decontaminate, licenses, lm, merkle, pii, quality, repeats, simhash, tokenstore, toxicity, whitening,
)
from tidemark.llm.common import in_fold, lower_ascii, scratch, table


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = bpe.Model.load(byte_vocabulary())
    coded = bpe.decode(bpe.encode(docs, model, together=True), model)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = quality.train(docs, table(spark, sf_dir, "labels"), lambda doc_id: ~in_fold(doc_id, 5, 0))
    return quality.judge(docs, chain)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").cast("long").alias("first_word"),
        F.array_max("places.start").cast("long").alias("last_word"),
        licenses.label_text(F.col("places.label")).alias("base_labels"),
        licenses.label_text(F.concat("places.label", "spans.label")).alias("labels"),
        F.col("best").alias("score"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    """Learned from the labelled rows outside the held-out fold."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.train(docs, labels, lambda doc_id: ~in_fold(doc_id, 5, 0))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, sf_dir, docs)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"),
                         F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
                         F.col("toxicity.sentences").alias("sentences"))


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 7, 2)
    out = lm.score(docs, ~held_out, lm.Vocabulary.load(piece_vocabulary()))
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = simhash.near_duplicates(docs, size=4, max_bits=4)
    return out.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [(F.size("pii") - F.size(F.array_remove("pii.kind", k))).cast("long").alias(f"n_{kind}")
              for k, kind in enumerate(pii.PATTERNS)]
    return out.select("doc_id", *counts, F.sha2(pii.joined_spans("pii").cast("binary"), 256).alias("base_sha256"),
                      pii.joined_spans("pii", "terms").alias("spans"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), span=10)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat.swapped_pairs(chat.conversations(table(spark, sf_dir, "conversations")))
    return chat.format_preferences(pairs).withColumnRenamed("id", "conv_id") \
        .withColumns({m: chat.mask_text(m) for m in ("chosen_mask", "rejected_mask")})


def op11_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = tokenstore.write(table(spark, sf_dir, "documents"), scratch(spark, "tokens"), byte_vocabulary(), end_id=0)
    return tokenstore.read(store).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32).withColumnRenamed("id", "vec_id")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    other = F.when(F.col("text").isNotNull(), lower_ascii(F.col("text")))
    tree = merkle.build(docs, changed={"text": other}, where=in_fold(F.col("doc_id"), 3, 0))

    def digest(c: str) -> Column:
        return F.lower(F.hex(c))
    return merkle.climb(tree).select(
        F.col("id").alias("doc_id"), digest("leaf").alias("leaf"), digest("subroot").alias("subroot"),
        F.lit(tree.root.hex() if tree.root else None).cast("string").alias("root"),
        F.sha2(digest("proof").cast("binary"), 256).alias("proof_sha256"), digest("folded").alias("folded_root"),
        (F.col("folded") == F.lit(tree.root).cast("binary")).alias("verified"))


QUERIES = {
    "op1_lm": op1_lm,
    "op2_simhash": op2_simhash,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_repeats": op6_repeats,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_decontamination": op9_decontamination,
    "op10_preferences": op10_preferences,
    "op11_token_store": op11_token_store,
    "op12_whitening": op12_whitening,
    "op13_manifest": op13_manifest,
}

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, w[i + 1 : i + least(len(w), 10)] AS win
  FROM (SELECT item, w, unnest(range(len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT rid, n, i, w[i + 1 : i + n] AS win
  FROM (SELECT rid, w, n, unnest(range(len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT rid, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hw AS (SELECT rid, count(DISTINCT i + k) AS n_hit
       FROM (SELECT rid, i, unnest(range(n)) AS k FROM hit) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""

_TEMPLATES = ", ".join(
    f"({t}, '{label}', {'true' if t < len(licenses.PHRASES) else 'false'}, '{text}')"
    for t, (label, text) in enumerate(licenses.PHRASES + licenses.NOTICES))

OP5_SQL = rf"""
WITH tp AS (SELECT t, label, exact, string_split(body, ' ') AS w FROM (VALUES {_TEMPLATES}) AS v(t, label, exact, body)),
g AS (SELECT t, label, exact, len(w) AS size, least(len(w), 3) AS k, i, w[i + 1 : i + least(len(w), 3)] AS gram
      FROM (SELECT *, unnest(range(len(w) - least(len(w), 3) + 1)) AS i FROM tp)),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
dg AS (SELECT rid, k, p, w[p + 1 : p + k] AS gram
       FROM (SELECT rid, w, k, unnest(range(len(w) - k + 1)) AS p FROM d, (VALUES (2), (3)) AS ks(k) WHERE len(w) >= k)),
votes AS (SELECT rid, t, label, exact, size, g.k, p - i AS diagonal, count(DISTINCT i) AS votes, min(p) AS start, max(p) AS last
          FROM dg JOIN g ON dg.k = g.k AND dg.gram = g.gram GROUP BY ALL),
parts AS (SELECT *, CASE WHEN NOT exact AND diagonal - lag(diagonal) OVER o <= 3 THEN 0 ELSE 1 END AS fresh
          FROM votes WINDOW o AS (PARTITION BY rid, t ORDER BY diagonal)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY rid, t ORDER BY diagonal) AS span FROM parts),
spans AS (SELECT rid, t, label, exact, min(start) AS start, max(last) + k AS stop, size,
                 least(1.0, CAST(sum(votes) AS DOUBLE) / (size - k + 1)) AS cover
          FROM numbered GROUP BY rid, t, label, exact, size, k, span),
per AS (SELECT rid, count(*) FILTER (exact) AS n_base, min(start) FILTER (exact) AS first_word, max(start) FILTER (exact) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label)
                 FILTER (exact OR (cover >= 0.75 AND stop - start <= 2 * size)) AS labels,
               max(cover) AS score
        FROM spans GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN per USING (rid)
"""

_RENDER = "'<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)"
_MASK = """array_to_string(list_transform(list_filter(range(1, len({0}) + 1), lambda i: {0}[i].role = 'assistant'), lambda i:
    CAST(coalesce(list_sum(list_transform({0}r[1 : i - 1], lambda z: length(z))), 0) + length({0}[i].role) + 5 AS BIGINT) || ':' ||
    CAST(list_sum(list_transform({0}r[1 : i], lambda z: length(z))) - 1 AS BIGINT)), ',')"""

OP10_SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, text) AS a
      FROM t GROUP BY conv_id),
f AS (SELECT conv_id, a, coalesce(list_position(list_transform(a, lambda x: x.role), 'assistant'), 0) AS fa FROM c),
p AS (SELECT x.conv_id, x.a AS a, CASE WHEN x.fa = 0 THEN x.a ELSE list_concat(x.a[1 : x.fa - 1], coalesce(y.a[y.fa :], [])) END AS b
      FROM f x LEFT JOIN f y ON y.conv_id = xor(x.conv_id, 1) AND y.fa > 0),
n AS (SELECT *, least(len(a), len(b)) AS m,
             coalesce(list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i]), false), 0) AS d FROM p),
q AS (SELECT conv_id, CASE WHEN d > 0 THEN d - 1 ELSE m END AS k, a, b FROM n),
s AS (SELECT conv_id, k, a[1 : k] AS pre, a[k + 1 :] AS ca, b[k + 1 :] AS cb FROM q),
r AS (SELECT *, list_transform(pre, lambda t: {_RENDER}) AS prer, list_transform(ca, lambda t: {_RENDER}) AS car,
             list_transform(cb, lambda t: {_RENDER}) AS cbr FROM s)
SELECT conv_id, CAST(k AS BIGINT) AS n_prompt_turns, array_to_string(prer, '') AS prompt, array_to_string(car, '') AS chosen,
       array_to_string(cbr, '') AS rejected, {_MASK.format('ca')} AS chosen_mask, {_MASK.format('cb')} AS rejected_mask
FROM r
"""

OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
win AS (SELECT rid, i, array_to_string(w[i + 1 : i + 35], ' ') AS win
        FROM (SELECT rid, w, unnest(range(len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY win) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT rid, i + k AS p FROM (SELECT rid, i, unnest(range(35)) AS k FROM twice)),
per AS (SELECT rid, count(*) AS n_removed FROM gone GROUP BY rid),
kept AS (SELECT x.rid, string_agg(word, ' ' ORDER BY x.p) AS kept
         FROM (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS p FROM d) x LEFT JOIN gone ON x.rid = gone.rid AND x.p = gone.p
         WHERE gone.p IS NULL GROUP BY x.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN per USING (rid) LEFT JOIN kept USING (rid)
"""

#: crc32 of a list of bytes: the table of its polynomial, then a byte at a time.
_CRC = """(xor(list_reduce(list_concat([4294967295::BIGINT], {0}),
    lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1])), 4294967295::BIGINT))"""

OP13_SQL = f"""
WITH RECURSIVE polynomial AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS crc),
f AS (SELECT row_number() OVER () AS rid, doc_id, lang, text,
        {_CRC.format("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 3 = 0 AS hit,
        [doc_id::VARCHAR, source, lang, n_chars::VARCHAR] AS a FROM documents, polynomial),
h AS (SELECT rid, doc_id, lang, coalesce(hit, false) AS hit,
        array_to_string(list_transform(a, lambda x: coalesce(strlen(x) || ':' || x, '-')), '') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS body,
        coalesce(strlen(text) || ':' || translate(text, {LETTERS}), '-') AS low FROM f),
l AS (SELECT rid, doc_id, lang, sha256(head || body) AS leaf,
        CASE WHEN hit THEN sha256(head || low) ELSE sha256(head || body) END AS other FROM h),
n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos FROM l),
tree(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY pos) FROM n GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1 : i + 8], '')))
  FROM tree WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS t
             FROM tree WHERE len(nodes) = 1),
top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY t) FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1 : i + 8], '')))
  FROM top WHERE len(nodes) > 1),
levels AS (SELECT s.t, level, nodes FROM tree JOIN subroots s ON tree.lang IS NOT DISTINCT FROM s.lang WHERE len(nodes) > 1
           UNION ALL SELECT s.t, s.height + level, nodes FROM top, subroots s WHERE len(nodes) > 1),
climb(rid, t, level, pos, folded, proof) AS (
  SELECT n.rid, s.t, 0, n.pos, n.other, '' FROM n JOIN subroots s ON n.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT c.rid, c.t, c.level + 1, c.k // 8, sha256(c.front || c.folded || c.back), c.proof || c.front || c.back
  FROM (SELECT *, array_to_string(nodes[k // 8 * 8 + 1 : k], '') AS front, array_to_string(nodes[k + 2 : k // 8 * 8 + 8], '') AS back
        FROM (SELECT x.*, y.nodes, CASE WHEN x.level = s.height THEN x.t ELSE x.pos END AS k
              FROM climb x JOIN levels y ON x.t = y.t AND x.level = y.level JOIN subroots s ON x.t = s.t)) c)
SELECT n.doc_id, n.leaf, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS verified
FROM n JOIN subroots s ON n.lang IS NOT DISTINCT FROM s.lang
JOIN climb c ON c.rid = n.rid AND c.level = s.height + (SELECT max(level) FROM top)
"""

SQL: dict[str, str] = {
    "op13_manifest": OP13_SQL,
    "op6_repeats": OP6_SQL,
    "op5_licenses": OP5_SQL,
    "op10_preferences": OP10_SQL,
    "op9_decontamination": OP9_SQL,
}
