"""From raw documents to token ids: five stages, each one operator over all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next one's ``docs``.
All stages but the last return the columns of ``docs``.

1. toxicity: documents that the classifier scores at one half or more go.  It is
   trained on ``labels`` outside the held-out fold.
2. near_duplicates: of each SimHash component the row with the smallest doc_id stays
   (of rows that share it, the smallest by text hash and then by all columns).
3. decontamination: documents with a window of a benchmark item go.
4. personal_data: base values and disclosing terms are replaced in the text;
   ``n_chars`` follows the new text.  No document goes.
5. encoding: token ids, their number, and whether decoding gives the text back.

Defined cases: null and empty texts pass every filter that their content does not
concern (without words they are copies of one another, so stage 2 keeps one);
a null doc_id is kept as such; empty tables give empty tables; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, pii, queries, simhash, toxicity
from tidemark.llm.common import fresh, table, written

#: No SQL: the first stage is a trained model.  The stages are tested against brute force.
ORACLE_SQL = None


def _keys(doc_id: Column, text: Column) -> list[Column]:
    """Keys of a row that compare without nulls: the id as text, and the text's hash."""
    return [F.coalesce(doc_id.cast("string"), F.lit("")), F.xxhash64(text)]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.toxicity_model(spark, sf_dir, docs)
    (name,) = fresh(docs, "toxicity")
    return toxicity.score_toxicity(docs, model).where(F.col(f"{name}.score") < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    a, b, row = fresh(docs, "_id_key", "_text_key", "_row")
    keys = _keys(F.col("doc_id"), F.col("text"))
    narrow = docs.select("doc_id", "text")
    found = simhash.near_duplicates(narrow, size=4, max_bits=4)
    heads = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("h")) \
        .select(F.coalesce(F.col("h.doc_id").cast("string"), F.lit("")).alias(a), F.col("h.row").alias(b))
    # the join leaves equal keys together, so choosing among repeated rows needs no further shuffle
    return docs.withColumns({a: keys[0], b: keys[1]}).join(heads, [a, b], "left_semi") \
        .groupBy(a, b).agg(F.min(F.struct(*docs.columns)).alias(row)).select(f"{row}.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    a, b = fresh(docs, "_id_key", "_text_key")
    found = decontaminate.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"), span=10)
    hit = found.where(F.col("n_hit") > 0).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(a), F.col("row").alias(b)).distinct()
    keys = _keys(F.col("doc_id"), F.col("text"))
    return docs.withColumns({a: keys[0], b: keys[1]}).join(hit, [a, b], "left_anti").select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (clean,) = fresh(docs, "clean_text")
    out = pii.sanitise(docs)
    new = {"text": F.col(clean)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("text").eqNullSafe(F.col(clean)), F.col("n_chars")) \
            .otherwise(F.length(clean).cast(docs.schema["n_chars"].dataType))
    return out.withColumns(new).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = bpe.Model.load(queries.byte_vocabulary())
    ids, decoded, n, exact = fresh(docs, "ids", "decoded", "n_tokens", "exact")
    out = bpe.decode(bpe.encode(docs, model), model, ids_col=ids)
    return out.withColumns({n: F.size(ids).cast("long"), exact: F.col(decoded) == F.coalesce("text", F.lit(""))}) \
        .select(*docs.columns, ids, n, exact)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
