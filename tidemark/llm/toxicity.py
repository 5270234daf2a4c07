"""Toxicity by multiple-instance learning.

A document is a bag of sentences; it is toxic if at least one sentence is.  A
logistic model gives each sentence a probability, noisy-or combines them
(``1 - prod(1 - p)``), and the model is trained from document labels alone.  The
sentences with a probability of at least one half are the offending ones.

Features of a sentence: the set of its words (lower-cased A-Z, runs of ASCII
letters, digits and non-ASCII characters) and of their first letters (a stem),
hashed.  A proximal step keeps weights of uninformative features at exactly zero.

Training reads a bounded sample of the labelled rows (``max_rows``, those with
the smallest hash of their id); scoring reads every whole text.

Defined cases: null or empty text is one empty sentence, so it gets the prior's
score; a null label or a label without a document is not used; repeated rows each
train and each get a score; with labels of one class only every score is the smoothed
share of positive labels, and zero without any usable label.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, small_batches

BITS = 20
STEM_BYTES = 6
CACHE = 200_000
_BREAK = b".!?\n"
_TABLE = bytes(
    10 if c in _BREAK else c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_SENTENCE = re.compile(rb"[^.!?\n]+")


def features(word: bytes) -> tuple[int, ...]:
    """Hashed features of one word: itself, and its stem if it is longer than that."""
    mask = (1 << BITS) - 1
    own = zlib.crc32(word) & mask
    if len(word) <= STEM_BYTES:
        return (own, zlib.crc32(b"^" + word) & mask)
    return (own, zlib.crc32(b"^" + word[:STEM_BYTES]) & mask)


def sentences(text: bytes) -> list[list[bytes]]:
    """Words of each sentence that has any; one empty sentence if none has."""
    return [w for s in text.translate(_TABLE).split(b"\n") if (w := s.split())] or [[]]


def bags(text: pa.Array) -> pa.Array:
    """Hashed features of every sentence of every text."""
    out = []
    for t in text.cast(pa.binary()).to_pylist():
        out.append([sorted({f for w in s for f in features(w)}) for s in sentences(t or b"")])
    return pa.array(out, pa.list_(pa.list_(pa.int32())))


@dataclass
class Model:
    bias: float
    index: np.ndarray   # features with a weight
    weight: np.ndarray
    always: float | None = None   # the score of every text, if the labels could not train a model

    def table(self) -> dict[int, float]:
        return dict(zip(self.index.tolist(), self.weight.tolist(), strict=True))


def fit(bags: pa.ListArray, labels: np.ndarray, epochs: int = 20, rate: float = 0.3,
        l1: float = 5e-4, batch: int = 64, seed: int = 7) -> Model:
    """Noisy-or maximum likelihood by proximal AdaGrad over mini-batches of documents.

    ``bags`` holds the features of the sentences of the documents; it is read as flat arrays.
    """
    y = np.asarray(labels, np.float64)
    share = float((y.sum() + 1) / (len(y) + 2))
    if len(np.unique(y)) < 2:
        return Model(0.0, np.zeros(0, np.int64), np.zeros(0), share if len(y) else 0.0)
    per_doc = pc.list_value_length(bags).to_numpy(zero_copy_only=False).astype(np.int64)
    inner = bags.flatten()
    per_sentence = pc.list_value_length(inner).to_numpy(zero_copy_only=False).astype(np.int64)
    col = inner.flatten().to_numpy(zero_copy_only=False)     # a feature is its own place: the hash is bounded
    size = 1 << BITS
    row_at, sent_at = np.r_[0, np.cumsum(per_sentence)], np.r_[0, np.cumsum(per_doc)]
    typical = max(1.0, float(np.median(per_doc)))
    bias = math.log(share / typical)
    w, g2, b2 = np.zeros(size), np.full(size, 1e-4), 1.0
    order_of = np.random.default_rng(seed)
    for _ in range(epochs):
        order = order_of.permutation(len(y))
        for start in range(0, len(order), batch):
            docs = order[start:start + batch]
            n_sent = per_doc[docs]
            sent = np.concatenate([np.arange(sent_at[d], sent_at[d + 1]) for d in docs])
            n_row = per_sentence[sent]
            at = np.repeat(row_at[sent] - np.r_[0, np.cumsum(n_row)[:-1]], n_row) + np.arange(n_row.sum())
            feats, of_sent = col[at], np.repeat(np.arange(len(sent)), n_row)
            of_doc = np.repeat(np.arange(len(docs)), n_sent)
            z = np.clip(np.bincount(of_sent, w[feats], len(sent)) + bias, -30, 30)
            p = 1 / (1 + np.exp(-z))
            none = np.bincount(of_doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(docs))
            some = -np.expm1(none)
            pull = np.where(y[docs] == 1, -np.exp(none) / np.maximum(some, 1e-12), 1.0)
            g_sent = pull[of_doc] * p / len(docs)
            touched, where = np.unique(feats, return_inverse=True)
            g = np.bincount(where, g_sent[of_sent], len(touched))
            g2[touched] += g * g
            step = rate / np.sqrt(g2[touched])
            moved = w[touched] - step * g
            w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
            gb = float(g_sent.sum())
            b2 += gb * gb
            bias = min(bias - rate * 0.2 / math.sqrt(b2) * gb, -1.0)
    keep = np.flatnonzero(np.abs(w) > 1e-9)
    return Model(bias, keep, w[keep])


def train(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int = 8000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Model from at most ``max_rows`` labelled rows of ``docs`` for which ``learn`` (over the id) holds."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")) \
        .where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull()) \
        .where(learn_on(learn, id_col, "_id")) \
        .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows)
    rows = small_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(marks), "_id") \
        .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows) \
        .select("_y", F.arrow_udf(bags, "array<array<int>>")("_t").alias("_bags")).toArrow()
    # the driver holds one copy of the sample, and no longer than the training takes
    labels_of, bags_of = rows.column("_y").to_numpy(), rows.column("_bags").combine_chunks()
    del rows
    model = fit(bags_of, labels_of)
    del bags_of
    pa.default_memory_pool().release_unused()
    return model


def learn_on(learn, id_col: str, name: str) -> Column:
    """``learn`` is a function of the id column, or a ready condition over ``_id``."""
    return learn(F.col(name)) if callable(learn) else learn


def scorer(df: DataFrame, model: Model):
    """A column function text -> struct<score, sentences: array<struct<start, end, score>>>.

    ``score`` is the document's probability; ``sentences`` holds the code point
    spans of sentences with a probability of at least one half.
    """
    held = small_batches(df).sparkSession.sparkContext.broadcast((model.bias, model.table(), model.always))
    kind = "struct<score: double, sentences: array<struct<start: long, end: long, score: double>>>"
    arrow = pa.struct([("score", pa.float64()), ("sentences", pa.list_(pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])

    @F.arrow_udf(kind)
    def score(text: pa.Array) -> pa.Array:
        bias, weights, always = held.value
        if always is not None:
            return pa.array([{"score": always, "sentences": []}] * len(text), arrow)
        known: dict[bytes, tuple[tuple[int, float], ...]] = {}
        quiet = 1 / (1 + math.exp(-bias))
        out = []
        for t in text.cast(pa.binary()).to_pylist():
            t = t or b""
            if len(known) > CACHE:
                known.clear()
            log_none, loud = 0.0, []
            for k, s in enumerate(sentences(t)):
                z: dict[int, float] = {}
                for w in s:
                    hit = known.get(w)
                    if hit is None:
                        hit = known[w] = tuple((f, weights[f]) for f in features(w) if f in weights)
                    if hit:
                        z.update(hit)
                p = 1 / (1 + math.exp(-min(bias + sum(z.values()), 30.0))) if z else quiet
                log_none += math.log1p(-min(p, 1 - 1e-12))
                if p >= 0.5:
                    loud.append((k, p))
            spans = []
            if loud:
                found = [m for m in _SENTENCE.finditer(t) if m.group().translate(_TABLE).split()]
                for k, p in loud:
                    a, b = found[k].span() if found else (0, 0)
                    spans.append({"start": len(t[:a].decode()), "end": len(t[:b].decode()), "score": p})
            out.append({"score": min(1.0, max(0.0, -math.expm1(log_none))), "sentences": spans})
        return pa.array(out, arrow)

    return score


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``toxicity`` (renamed if taken): score and offending sentences."""
    (name,) = fresh(docs, "toxicity")
    return docs.withColumn(name, scorer(docs, model)(F.col(text_col)))
