"""Quality rules and line labelling with a linear-chain conditional random field.

Base rules count words, symbols, repeated lines and words in repeated windows.  The
method labels every line that has a word as content or boilerplate: a two-state
chain scores each line's features and each change of state, Viterbi decoding takes
the best sequence, and a document is kept if the content lines hold at least
``min_share`` of its words (and no base rule fails).

Training takes a bounded sample of labelled documents, ``max_rows`` with the smallest
hash of their id.  Labels are of documents, so the lines' states are latent: lines
are first scored alone, each for its document's label, and take the likelier state; a
document's verdict holds as a constraint, so lines nearest to the boundary change
state until content lines hold half the words of a good document, and less of a bad
one.  Scores and states are renewed ``ROUNDS`` times.  Then the chain is trained on
these states by maximum conditional likelihood (forward and backward sums), so changes of
state inside a document have scores of their own, and a line's evidence and its
neighbours' decide together.  Every document is labelled, whole.

Defined cases: null text has no words and fails the base rules; a text without a
word has no line and no content; a very long text is one sequence, in memory of some
hundred bytes a line; ties of scores go to content; repeated rows each get a row; a
null label or one without a document is not used; without labels of both classes all lines
are content.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SPACE = " \t\n\r\x0b\x0c"
N_FEATURES = 14
ROUNDS = 3      # of the latent line states


def line_features(line: str, words: list[str], repeated: bool) -> list[float]:
    """Features of one line with its words, all between zero and about one."""
    n, chars = len(words), len(line)
    symbols = sum(map(line.count, SYMBOLS))
    upper = sum(map(str.isupper, line))
    letters = sum(map(str.isalpha, line)) or 1
    top = max(Counter(words).values())
    return [
        1.0,
        min(n, 64) / 64,
        float(n <= 2),
        min(1.0, 4 * symbols / chars),
        line.count("|") / n,
        min(1.0, symbols / n),
        upper / letters,
        min(1.0, line.count("!") / n),
        min(1.0, 4 * sum(map(str.isdigit, line)) / chars),
        min(1.0, letters / n / 12),
        (top - 1) / n,
        1 - len(set(words)) / n,
        float(repeated),
        float(line.rstrip(SPACE)[-1] in ".!?"),
    ]


def ascii_words(text: str) -> list[str]:
    """Words between ASCII white space; ``str.split`` alone would also cut at other white space."""
    return [w.decode() for w in text.encode().split()]


def described(text: str) -> tuple[list[list[float]], list[int], list[int]]:
    """Features, number of words and line number of every line with a word."""
    seen: set[str] = set()
    features, sizes, numbers = [], [], []
    for k, line in enumerate(text.split("\n")):
        words = ascii_words(line)
        if words:
            features.append(line_features(line, words, line in seen))
            sizes.append(len(words))
            numbers.append(k)
            seen.add(line)
    return features, sizes, numbers


def repeat_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    may = np.unique(np.r_[order[1:][same], order[:-1][same]]).tolist()
    found: dict[tuple, list[int]] = {}
    for i in may:                                        # equal hashes are compared word by word
        found.setdefault(tuple(words[i:i + WINDOW]), []).append(i)
    step = np.zeros(len(words) + 1, np.int64)
    for at in found.values():
        if len(at) > 1:
            np.add.at(step, at, 1)
            np.add.at(step, np.array(at) + WINDOW, -1)
    return int((np.cumsum(step) > 0).sum())


def base_counts(text: str) -> dict[str, int]:
    raw = text.encode()
    words = raw.split()
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            duplicates += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, SPACE)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeat_words(words),
    }


@dataclass
class Chain:
    """State 1 is content: weights of a line's features for it, scores of the first state and of the changes."""

    weight: np.ndarray
    first: np.ndarray       # 2
    change: np.ndarray      # 2 x 2, from row to column

    def viterbi(self, gain: np.ndarray) -> np.ndarray:
        """Best state sequence, given each line's score for content; ties go to content."""
        score, back = self.first.tolist(), []
        (a, b), (c, d) = self.change.tolist()
        for t, g in enumerate(gain.tolist()):
            if t:
                to0, to1 = (score[0] + a, score[1] + c), (score[0] + b, score[1] + d)
                back.append((int(to0[1] >= to0[0]), int(to1[1] >= to1[0])))
                score = [max(to0), max(to1)]
            score[1] += g
        state = int(score[1] >= score[0])
        out = [state] if len(gain) else []
        for choice in reversed(back):
            state = choice[state]
            out.append(state)
        return np.array(out[::-1], np.int64)


def latent_states(gains: list[np.ndarray], sizes: list[np.ndarray], labels: list[int],
                  min_share: float = 0.5) -> list[np.ndarray]:
    """States of each document's lines: the sign of their gain, held to the document's label.

    Lines change state, nearest to the boundary first, until content lines hold at
    least ``min_share`` of the words of a document of label 1, and less than that of one of label 0.
    """
    out = []
    for gain, n, label in zip(gains, sizes, labels, strict=True):
        state = (gain >= 0).astype(np.int64)
        for k in np.argsort(np.abs(gain), kind="stable").tolist():
            if ((n * state).sum() >= min_share * n.sum()) == (label == 1):
                break
            if state[k] != label:
                state[k] = label
        out.append(state)
    return out


def fit(features: list[list[list[float]]], sizes: list[list[int]], labels: list[int], min_share: float = 0.5) -> Chain:
    """Chain from documents' labels: lines alone, then their latent states, then the chain on these."""
    keep = [k for k, f in enumerate(features) if f]
    label = [labels[k] for k in keep]
    if len(set(label)) < 2:
        return Chain(np.r_[1.0, np.zeros(N_FEATURES - 1)], np.zeros(2), np.zeros((2, 2)))
    lines = [np.array(features[k]) for k in keep]
    words = [np.array(sizes[k]) for k in keep]
    states = [np.full(len(x), y) for x, y in zip(lines, label, strict=True)]
    for _ in range(ROUNDS):
        weight = fit_alone(lines, states, label)
        states = latent_states([x @ weight for x in lines], words, label, min_share)
    return fit_states(lines, states, label)


def shares(labels: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Weight of a line in each document: both labels weigh the same, and so do all documents of one."""
    return np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / size / len(labels)


class Adam:
    """Steps down a gradient."""

    def __init__(self, n: int, rate: float):
        self.theta, self.rate, self.steps = np.zeros(n), rate, 0
        self.m, self.v = np.zeros(n), np.zeros(n)

    def step(self, g: np.ndarray) -> None:
        self.steps += 1
        self.m, self.v = 0.9 * self.m + 0.1 * g, 0.999 * self.v + 0.001 * g * g
        self.theta = self.theta - self.rate * (self.m / (1 - 0.9 ** self.steps)) / (
            np.sqrt(self.v / (1 - 0.999 ** self.steps)) + 1e-9)


def fit_alone(lines: list[np.ndarray], states: list[np.ndarray], labels: list[int], steps: int = 200, rate: float = 0.1,
              ridge: float = 1e-4) -> np.ndarray:
    """Weights of the features when every line stands alone."""
    size = np.array([len(x) for x in lines])
    x, state = np.concatenate(lines), np.concatenate(states)
    each = np.repeat(shares(np.array(labels), size), size)
    model = Adam(N_FEATURES, rate)
    for _ in range(steps):
        p = np.exp(-np.logaddexp(0, -(x @ model.theta)))
        model.step(x.T @ (each * (p - state)) + ridge * model.theta)
    return model.theta


def fit_states(lines: list[np.ndarray], states: list[np.ndarray], labels: list[int], steps: int = 200, rate: float = 0.1,
               ridge: float = 1e-4) -> Chain:
    """Conditional likelihood of the sequences of states."""
    size = np.array([len(x) for x in lines])
    order = np.argsort(-size, kind="stable")
    y, size = np.array(labels)[order], size[order]
    x = np.concatenate([lines[k] for k in order])
    state = np.concatenate([states[k] for k in order])
    at = np.r_[0, np.cumsum(size)[:-1]]
    longest = int(size[0])
    live = [int((size > t).sum()) for t in range(longest)]       # sequences are sorted by length, longest first
    balance = shares(y, size)
    model = Adam(N_FEATURES + 6, rate)
    for _ in range(steps):
        theta = model.theta
        w, first, change = theta[:N_FEATURES], theta[N_FEATURES:N_FEATURES + 2], theta[N_FEATURES + 2:].reshape(2, 2)
        gain = x @ w
        alpha, beta = [], [None] * longest
        for t in range(longest):
            k = live[t]
            own = np.stack([np.zeros(k), gain[at[:k] + t]], 1)
            alpha.append(own + (first if t == 0 else np.logaddexp.reduce(alpha[-1][:k, :, None] + change, axis=1)))
        for t in range(longest - 1, -1, -1):
            beta[t] = np.zeros((live[t], 2))
            if t + 1 < longest and live[t + 1]:
                k = live[t + 1]
                own = np.stack([np.zeros(k), gain[at[:k] + t + 1]], 1)
                beta[t][:k] = np.logaddexp.reduce(change + (own + beta[t + 1])[:, None, :], axis=2)
        total = np.logaddexp.reduce(first + np.stack([np.zeros(len(y)), gain[at]], 1) + beta[0], axis=1)
        g_line, g_first, g_change = np.zeros(len(x)), np.zeros(2), np.zeros((2, 2))
        for t in range(longest):
            k = live[t]
            p = np.exp(alpha[t] + beta[t] - total[:k, None])
            here = state[at[:k] + t]
            g_line[at[:k] + t] = balance[:k] * (p[:, 1] - here)
            if t == 0:
                g_first = (balance[:, None] * (p - np.eye(2)[here])).sum(0)
            else:
                own = np.stack([np.zeros(k), gain[at[:k] + t]], 1)
                both = np.exp(alpha[t - 1][:k, :, None] + change + (own + beta[t])[:, None, :] - total[:k, None, None])
                g_change += (balance[:k, None, None] * (
                    both - np.eye(2)[state[at[:k] + t - 1]][:, :, None] * np.eye(2)[here][:, None, :])).sum(0)
        model.step(np.r_[x.T @ g_line, g_first, g_change.ravel()] + ridge * theta)
    theta = model.theta
    return Chain(theta[:N_FEATURES], theta[N_FEATURES:N_FEATURES + 2], theta[N_FEATURES + 2:].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, learn, max_rows: int = 4000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Chain:
    """Chain from at most ``max_rows`` labelled rows whose id ``learn`` accepts."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")) \
        .where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & learn(F.col("_id"))) \
        .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows)

    kind = pa.struct([("x", pa.list_(pa.list_(pa.float64()))), ("n", pa.list_(pa.int64()))])

    def lines(text: pa.Array) -> pa.Array:
        return pa.array([dict(zip("xn", described(t or ""), strict=False)) for t in text.to_pylist()], kind)

    rows = small_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(marks), "_id") \
        .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows) \
        .select("_y", F.arrow_udf(lines, "struct<x: array<array<double>>, n: array<long>>")("_t").alias("_x")) \
        .select("_y", "_x.x", "_x.n").toArrow()
    return fit(rows.column("x").to_pylist(), rows.column("n").to_pylist(), rows.column("_y").to_pylist())


def judge(docs: DataFrame, chain: Chain, min_share: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base counts, base_failed, content_share, boilerplate, kept) for every row of ``docs``.

    ``boilerplate`` lists the numbers (from 0) of the lines so labelled.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    arrow = pa.struct([*((c, pa.int64()) for c in counts), ("content_share", pa.float64()), ("boilerplate", pa.list_(pa.int32()))])

    def rate(text: pa.Array) -> pa.Array:
        out = []
        for k in range(0, len(text), 512):
            for t in text.slice(k, 512).to_pylist():
                t = t or ""
                row = base_counts(t)
                features, sizes, numbers = described(t)
                state = chain.viterbi(np.array(features).reshape(-1, N_FEATURES) @ chain.weight)
                share = float((np.array(sizes) * state).sum() / max(1, sum(sizes)))
                out.append(row | {"content_share": share, "boilerplate": [n for n, s in zip(numbers, state, strict=True) if not s]})
        return pa.array(out, arrow)

    kind = ", ".join(f"{c}: long" for c in counts)
    udf = F.arrow_udf(rate, f"struct<{kind}, content_share: double, boilerplate: array<int>>")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return small_batches(docs).select(F.col(id_col), udf(F.col(text_col)).alias("_r")).select(id_col, "_r.*") \
        .select(id_col, *counts, failed.alias("base_failed"), "content_share", "boilerplate",
                (~failed & (F.col("content_share") >= min_share)).alias("kept"))
