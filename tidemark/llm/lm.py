"""Subword lattice likelihood: the probability of a text, summed over all of its segmentations.

A text is a sequence of words (A-Z lower-cased, cut at ASCII white space), each with
a word-start mark, and one end symbol.  A unigram model over an existing subword
vocabulary gives every piece a probability; the probability of a word is the sum
over all ways to cut it into pieces, by a forward recursion in log space over the
lattice of its pieces.  Words do not share pieces, so a text's log probability is
the sum of its words' and the end's, a proper distribution over texts.

The vocabulary and its scores exist (a public model file).  The scores there are
ranks; they start expectation maximisation (pieces' expected counts, from forward
and backward sums, weighted by the word counts of the learning rows), which turns
them into log probabilities.  The vocabulary itself is not trained.  Characters
without a piece are spelled by the vocabulary's byte pieces.

Spark's part: words are counted over the whole corpus with pre-aggregation, so the
table of distinct words grows with it; both EM and the final forward recursion run
once for each distinct word, in tasks over that table, and only expected counts of
pieces (bounded by the vocabulary) reach the driver.  The ``frequent`` most common
words travel to the tasks that read the documents; all other words of a document
are joined with the table.  No word outside the most common ones has more than
``tokens / frequent`` occurrences, so no key of that join is hot.

Defined cases: null text counts as empty and has the end symbol only; repeated rows
each count and each get a row; with no learning rows the counts are zero and the
pieces keep their initial probabilities; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, written

MARK = "▁"
LONG = 64           # characters above which a word is handled alone
BATCH = 20_000      # words whose lattices are computed together
FLUSH = 300_000     # distinct words a task counts before it passes them on
PRIOR = 0.01        # added to a piece's expected count
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LN10 = math.log(10)


@dataclass
class Vocabulary:
    """A prefix tree over the pieces, byte pieces, and natural log probabilities (the last is the end symbol's)."""

    edge: np.ndarray    # sorted keys: tree node * 2^21 + code point
    to: np.ndarray      # the node that an edge leads to
    ends: np.ndarray    # the piece that ends at a node, or -1
    byte: list[int]
    logp: np.ndarray

    @staticmethod
    def load(path: str, rank_offset: int = 10) -> Vocabulary:
        """Pieces of a sentencepiece model; probabilities fall with the rank that its scores give, as in Zipf's law."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        byte, score, edges, ends = [-1] * 256, np.zeros(size), {}, {}
        for i in range(size):
            name = model.id_to_piece(i)
            score[i] = model.get_score(i)
            if model.is_byte(i):
                byte[int(name[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                node = 0
                for c in name:
                    node = edges.setdefault((node << 21) + ord(c), len(edges) + 1)
                ends[node] = i
        if -1 in byte:
            raise ValueError("the vocabulary has no byte pieces")
        usable = np.zeros(size, bool)
        usable[list(ends.values()) + byte] = True
        rank = np.empty(size)
        rank[np.argsort(-score, kind="stable")] = np.arange(size)
        weight = np.where(usable, 1 / (rank + rank_offset), 0.0)
        weight[byte] = weight[usable].min() / 256
        weight = np.r_[weight / weight.sum() * 0.999, 0.001]
        keys = np.array(sorted(edges), np.int64)
        with np.errstate(divide="ignore"):
            return Vocabulary(keys, np.array([edges[k] for k in keys.tolist()], np.int64),
                              np.array([ends.get(k, -1) for k in range(len(edges) + 1)], np.int64), byte, np.log(weight))

    def updated(self, expected: np.ndarray) -> Vocabulary:
        """Probabilities from expected counts, the end's included."""
        w = np.where(np.isfinite(self.logp), expected + PRIOR, 0.0)
        with np.errstate(divide="ignore"):
            return replace(self, logp=np.log(w / w.sum()))

    def arcs(self, code: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every piece inside the words, whose code points are ``code``.

        ``left`` counts the characters from each position to its word's end.  A
        character that is no piece gets an arc for its bytes, with piece ``-1 - code``.
        """
        at, node, parts = np.arange(len(code)), np.zeros(len(code), np.int64), []
        n = 0
        while len(at):
            key = (node << 21) + code[at + n]
            where = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            found = self.edge[where] == key
            piece = np.where(found, self.ends[self.to[where]], -1)
            if n == 0:
                piece = np.where(piece < 0, -1 - code, piece)
            some = (piece >= 0) | (n == 0)
            n += 1
            parts.append((at[some], np.full(int(some.sum()), n), piece[some]))
            go = found & (left[at] > n)
            at, node = at[go], self.to[where[go]]
        start, size, piece = (np.concatenate(x) for x in zip(*parts, strict=True))
        return start, size, piece

    def spelled(self, code: int) -> list[int]:
        return [self.byte[b] for b in chr(code).encode()]


def _logsum(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(values, start)
    return top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, size)), start))


def lattice(words: list[str], vocab: Vocabulary, counts: np.ndarray | None = None,
            expected: np.ndarray | None = None) -> np.ndarray:
    """Log probability of each marked word, over all segmentations; adds expected piece counts to ``expected``."""
    out = np.zeros(len(words))
    long = [k for k, w in enumerate(words) if len(w) > LONG]
    short = [k for k, w in enumerate(words) if len(w) <= LONG]
    for ks in ([[k] for k in long] + [short[i:i + BATCH] for i in range(0, len(short), BATCH)]):
        n = np.fromiter((len(words[k]) for k in ks), np.int64, len(ks))
        code = np.frombuffer("".join([words[k] for k in ks]).encode("utf-32-le"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(ks)), n)
        ends = np.cumsum(n)
        begin, size, piece = vocab.arcs(code, ends[owner] - np.arange(len(code)))
        owner = owner[begin]
        heads = ends - n + np.arange(len(ks))            # a word of n characters has n + 1 nodes
        tails, at = heads + n, int(ends[-1]) + len(ks)
        start = begin + owner
        stop = start + size
        level, first = stop - heads[owner], start - heads[owner]
        spelled = {int(p): vocab.spelled(-1 - int(p)) for p in np.unique(piece[piece < 0])}
        logp = vocab.logp[np.maximum(piece, 0)]
        for p, parts in spelled.items():
            logp[piece == p] = vocab.logp[parts].sum()
        def sweep(target: np.ndarray, source: np.ndarray, by: np.ndarray, seeds: np.ndarray,
                  logp: np.ndarray = logp, at: int = at) -> np.ndarray:
            value = np.full(at, -np.inf)
            value[seeds] = 0.0
            order = np.argsort(by * at + target, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(by[order]) != 0, True])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                arc = order[lo:hi]
                group = np.flatnonzero(np.r_[True, np.diff(target[arc]) != 0])
                size = np.diff(np.r_[group, len(arc)])
                value[target[arc][group]] = _logsum(value[source[arc]] + logp[arc], group, size)
            return value

        alpha = sweep(stop, start, level, heads)
        out[ks] = alpha[tails]
        if expected is not None:
            beta = sweep(start, stop, first.max() - first, tails)
            weight = np.asarray(counts, np.float64)[np.array(ks)[owner]]
            gain = np.exp(alpha[start] + logp + beta[stop] - alpha[tails][owner]) * weight
            expected += np.bincount(np.maximum(piece, 0), np.where(piece >= 0, gain, 0), len(expected))
            for p, parts in spelled.items():
                np.add.at(expected, parts, gain[piece == p].sum())
    return out


def _tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LOWER).split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (_text, _learn) -> (word, c, n): occurrences in learning rows and in all rows."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            words = list(set(learn) | set(rest))
            c = [learn[w] for w in words]
            n = [learn[w] + rest[w] for w in words]
            learn.clear()
            rest.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array(n, pa.int64())],
                                              ["word", "c", "n"])
        learn, rest = Counter(), Counter()
        for batch in it:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                for text, use in zip(part.column(0).cast(pa.binary()).to_pylist(), part.column(1).to_pylist(), strict=True):
                    (learn if use else rest).update(_tokens(text))
                if len(learn) + len(rest) > FLUSH:
                    yield flush()
        yield flush()

    rows = docs.select("_text", "_learn").mapInArrow(count, "word binary, c long, n long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def regrouped(it: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``rows``."""
    held: list[pa.RecordBatch] = []
    for batch in it:
        held.append(batch)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if sum(x.num_rows for x in held):
        yield pa.concat_batches(held)


def _marked(words: pa.Array) -> list[str]:
    return [MARK + w.decode() for w in words.to_pylist()]


def expect(counts: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Expected count of every piece over the learning rows' words."""
    spark = counts.sparkSession
    held = spark.sparkContext.broadcast(vocab)

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = held.value
        total = np.zeros(len(v.logp))
        for part in regrouped(it, BATCH):
            lattice(_marked(part.column(0)), v, part.column(1).to_numpy(), total)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["piece", "gain"])

    rows = counts.where("c > 0").select("word", "c").mapInArrow(step, "piece int, gain double") \
        .groupBy("piece").agg(F.sum("gain").alias("gain")).toArrow()        # at most one row for each piece
    out = np.zeros(len(vocab.logp))
    out[rows.column("piece").to_numpy()] = rows.column("gain").to_numpy()
    return out


def word_scores(counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``counts`` with ``logp``, the natural log probability of the word."""
    held = counts.sparkSession.sparkContext.broadcast(vocab)

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(it, BATCH):
            score = lattice(_marked(part.column(0)), held.value)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], ["word", "c", "n", "logp"])

    return counts.select("word", "c", "n").mapInArrow(step, "word binary, c long, n long, logp double")


def score(docs: DataFrame, learn: Column, vocab: Vocabulary, em_steps: int = 2, frequent: int = 200_000,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, learned, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``learn`` says which rows train (null: not).  Scores are log10; ``base_score`` is
    the add-one word unigram's, ``score`` the lattice model's.
    """
    spark = docs.sparkSession
    rows = small_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       F.coalesce(learn, F.lit(False)).alias("_learn"))
    counts = written(word_counts(rows), "words")
    ends = rows.where("_learn").count()
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    total, distinct = total + ends, distinct + (ends > 0)
    for _ in range(em_steps if ends else 0):
        gain = expect(counts, vocab)
        gain[-1] = ends
        vocab = vocab.updated(gain)
    scored = written(word_scores(counts, vocab), "scored")
    top = scored.orderBy(F.desc("n"), "word").limit(frequent).toArrow()      # bounded by ``frequent``
    common = spark.sparkContext.broadcast(
        (top.column("word").to_pylist(), top.column("c").to_numpy(), top.column("logp").to_numpy()))

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, c, logp = common.value
        at = {w: k for k, w in enumerate(words)}
        logc = np.log10(c + 1.0)
        for batch in it:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                n_tokens, known, base, own, rare, times = [], [], [], [], [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    tokens = Counter(_tokens(text))
                    near = [(at[w], n) for w, n in tokens.items() if w in at]
                    i = np.fromiter((x for x, _ in near), np.int64, len(near))
                    n = np.fromiter((x for _, x in near), np.int64, len(near))
                    far = [w for w in tokens if w not in at]
                    n_tokens.append(sum(tokens.values()))
                    known.append(int(n[c[i] > 0].sum()))
                    base.append(float((logc[i] * n).sum()))
                    own.append(float((logp[i] * n).sum()))
                    rare.append(far)
                    times.append([tokens[w] for w in far])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(own, pa.float64()), pa.array(rare, pa.list_(pa.binary())),
                     pa.array(times, pa.list_(pa.int32()))],
                    ["_id", "_learn", "n_tokens", "known", "base", "own", "rare", "times"])

    kind = dict(rows.dtypes)["_id"]
    seen = written(rows.mapInArrow(read, f"_id {kind}, _learn boolean, n_tokens long, known long, base double, own double, "
                                         "rare array<binary>, times array<int>")
                   .withColumn("_rid", F.monotonically_increasing_id()), "read")
    pairs = seen.where(F.size("rare") > 0).select("_rid", F.explode(F.arrays_zip("rare", "times")).alias("p")) \
        .select("_rid", F.col("p.rare").alias("word"), F.col("p.times").alias("times"))
    rest = pairs.join(scored.select("word", "c", "logp"), "word").groupBy("_rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("r_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("r_base"),
        F.sum(F.col("times") * F.col("logp")).alias("r_own"))
    zero = F.lit(0)
    n = F.col("n_tokens") + 1
    return seen.drop("rare", "times").join(rest, "_rid", "left").select(
        F.col("_id").alias(id_col), F.col("_learn").alias("learned"), n.alias("n_tokens"),
        (F.col("known") + F.coalesce("r_known", zero) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", zero) + F.lit(math.log10(ends + 1))
         - n * F.lit(math.log10(total + distinct + 1))).alias("base_score"),
        ((F.col("own") + F.coalesce("r_own", zero) + F.lit(float(vocab.logp[-1]))) / F.lit(LN10)).alias("score"))
