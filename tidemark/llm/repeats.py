"""Removal of repeated substrings by recompression.

Words are renamed in rounds.  A round first names maximal runs of one symbol, then
pairs of neighbours: a hash of a symbol's name puts it on the left or the right side,
and a left symbol followed by a right one becomes one symbol.  Names are hashes of what they stand
for, so every task of the cluster gives equal phrases equal names without a
dictionary to share, and equal substrings get the same symbols inside.

How far inside is recorded: each symbol carries the range of words that its shape
depends on, its own and those neighbours that decided it was not joined.  If that
range lies in a window, every occurrence of the window has this symbol there.  So a
window that contains the range of a symbol that occurs once cannot occur twice.

1. All symbols of ``min_words`` words or more are counted.  Those that occur once
   come back with their place (a minimum, so nothing is collected by symbol and a
   symbol that is everywhere costs one row for each task).
2. A document's windows without such a symbol remain.  These are verified: the hash of
   the window's very words (96 bits) is counted in the same way, and those that
   occur once come back.
3. All that remain after that repeat; their words are removed.

Documents whose windows all contain a symbol that occurs once leave the plan after
step 1; only their number of words and their text are still written.  The ids of the
others select texts by broadcast if they take at most ``broadcast_bytes``, summed
first, and by a shuffle beyond.  A row's key is its id with the XXH64 of its text, so
different texts of one id (or of none) stay apart.

Defined cases: null text has no words; a text shorter than a window loses nothing;
a very long text is parsed alone, in memory of some hundred bytes a word; repeated rows
are occurrences of each other, and each gets a row; a null id is an id like any
other; among symbols that tie nothing is chosen, as only those that occur once count; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, small_batches, words, written

ROUNDS = 4
CHUNK = 1 << 20     # bytes of text parsed together
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit names."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Parse:
    """Symbols of several documents: name, words [start, stop), range [low, high) they depend on, document.

    Word numbers run through all documents; ``first`` and ``end`` bound each document.  A
    range that depends on a document's edge reaches one word beyond it, so that no window holds it.
    """

    def __init__(self, name: np.ndarray, doc: np.ndarray, first: np.ndarray, end: np.ndarray):
        n = len(name)
        self.word, self.first, self.end = name, first, end
        self.name, self.doc = name, doc
        self.start = np.arange(n)
        self.stop = self.start + 1
        self.low, self.high = self.start.copy(), self.stop.copy()

    def _take(self, at: np.ndarray) -> None:
        for k in ("name", "doc", "start", "stop", "low", "high"):
            setattr(self, k, getattr(self, k)[at])

    def _neighbours(self) -> np.ndarray:
        """Whether each symbol and the next one belong to one document."""
        return self.doc[1:] == self.doc[:-1]

    def runs(self) -> None:
        """Names maximal runs of equal symbols."""
        n = len(self.name)
        if n < 2:
            return
        joined = self._neighbours()
        equal = joined & (self.name[1:] == self.name[:-1])
        # that neighbours differ shows in the words at the boundary, or else in the whole neighbour
        word = self.word
        right_word = joined & (word[self.start[1:]] != word[self.start[:-1]])
        left_word = joined & (word[self.stop[1:] - 1] != word[self.stop[:-1] - 1])
        high, low = self.high.copy(), self.low.copy()
        high[:-1] = np.where(joined, np.where(right_word, np.maximum(high[:-1], self.stop[:-1] + 1),
                                              np.maximum(high[:-1], self.high[1:])), self.end[self.doc[:-1]] + 1)
        low[:-1] = np.where(joined & ~right_word, np.minimum(low[:-1], self.low[1:]), low[:-1])
        low[1:] = np.where(joined, np.where(left_word, np.minimum(low[1:], self.start[1:] - 1),
                                            np.minimum(low[1:], self.low[:-1])), self.first[self.doc[1:]] - 1)
        high[1:] = np.where(joined & ~left_word, np.maximum(high[1:], self.high[:-1]), high[1:])
        low[0], high[-1] = self.first[self.doc[0]] - 1, self.end[self.doc[-1]] + 1
        head = np.flatnonzero(np.r_[True, ~equal])
        size = np.diff(np.r_[head, n])
        low, high = np.minimum.reduceat(low, head), np.maximum.reduceat(high, head)
        stop = self.stop[np.r_[head[1:], n] - 1]
        self._take(head)
        self.low, self.high, self.stop = low, high, stop
        long = size > 1
        self.name = np.where(long, mix(self.name * _A + size.astype(np.uint64)), self.name)

    def pairs(self, number: int) -> None:
        """Names pairs of a left symbol and the right symbol after it."""
        n = len(self.name)
        if n < 2:
            return
        right = (mix(self.name + np.uint64(number * int(_A) % 2**64)) >> np.uint64(63)).astype(bool)
        joined = self._neighbours()
        pair = joined & ~right[:-1] & right[1:]
        # a left symbol that stays alone depends on the next symbol, a right one on the one before
        alone = ~np.r_[pair, False] & ~np.r_[False, pair]
        low, high = self.low.copy(), self.high.copy()
        near = np.r_[joined, False]
        on_next = alone & ~right
        k = np.flatnonzero(on_next & near)
        low[k], high[k] = np.minimum(low[k], self.low[k + 1]), np.maximum(high[k], self.high[k + 1])
        k = np.flatnonzero(on_next & ~near)
        high[k] = self.end[self.doc[k]] + 1
        near = np.r_[False, joined]
        k = np.flatnonzero(alone & right & near)
        low[k], high[k] = np.minimum(low[k], self.low[k - 1]), np.maximum(high[k], self.high[k - 1])
        k = np.flatnonzero(alone & right & ~near)
        low[k] = self.first[self.doc[k]] - 1
        a = np.flatnonzero(pair)
        self.name = self.name.copy()
        self.name[a] = mix(self.name[a] * _A ^ mix(self.name[a + 1] + _B))
        low[a], high[a] = np.minimum(low[a], low[a + 1]), np.maximum(high[a], high[a + 1])
        stop = self.stop.copy()
        stop[a] = stop[a + 1]
        self.low, self.high, self.stop = low, high, stop
        keep = np.ones(n, bool)
        keep[a + 1] = False
        self._take(keep)


def parse(texts: list[list[bytes]], rounds: int = ROUNDS) -> Parse:
    """Symbols of the documents' words after all rounds."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = [w for t in texts for w in t]
    one = xxhash.xxh64_intdigest
    known = {w: one(w) for w in set(flat)}
    name = np.fromiter(map(known.__getitem__, flat), np.uint64, len(flat))
    end = np.cumsum(n)
    out = Parse(name, np.repeat(np.arange(len(texts)), n), end - n, end)
    for k in range(1, rounds + 1):
        out.runs()
        out.pairs(k)
    return out


def grouped(texts: list[bytes | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Runs of documents of about CHUNK bytes: first index, words of each."""
    at, held, size = 0, [], 0
    for k, t in enumerate(texts):
        held.append((t or b"").split())
        size += len(t or b"")
        if size > CHUNK:
            yield at, held
            at, held, size = k + 1, [], 0
    if held:
        yield at, held


def windows_left(n_words: int, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that contain none of the ranges [low, high)."""
    n = n_words - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    step = np.zeros(n + 1, np.int64)
    first, last = np.maximum(high - window, 0), np.minimum(low, n - 1)
    fits = first <= last
    np.add.at(step, first[fits], 1)
    np.add.at(step, last[fits] + 1, -1)
    return np.flatnonzero(np.cumsum(step)[:n] == 0)


def as_ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Sorted numbers as [from, to) ranges."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + 1).tolist(), strict=True))


def unfold(ranges: list[dict]) -> np.ndarray:
    return np.concatenate([np.arange(r["lo"], r["hi"]) for r in ranges]) if ranges else np.zeros(0, np.int64)


def _columns(**named) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(named.values()), list(named))


def symbol_rows(docs: DataFrame, window: int, min_words: int) -> DataFrame:
    """Symbols of ``docs`` (_id, _row, _text): name, id, text hash, start of their range, its width; and one marker for each row.

    A marker has the row's id in ``marker`` and minus the number of words, less one, as width.
    """
    kind = dict(docs.dtypes)["_id"]

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, row = batch.column(0), batch.column(1).to_numpy()
            for k in range(0, batch.num_rows, 512):
                for at, texts in grouped(batch.column(2).slice(k, 512).cast(pa.binary()).to_pylist()):
                    p = parse(texts)
                    some = (p.stop - p.start >= min_words) & (p.high - p.low <= window) \
                        & (p.low >= p.first[p.doc]) & (p.high <= p.end[p.doc])
                    doc = p.doc[some]
                    at_doc = doc + at + k
                    nulls = pa.nulls(len(doc), ids.type)
                    yield _columns(name=pa.array(p.name[some].view(np.int64)), marker=nulls, id=ids.take(pa.array(at_doc)),
                                   row=pa.array(row[at_doc]), at=pa.array((p.low[some] - p.first[doc]).astype(np.int32)),
                                   width=pa.array((p.high - p.low)[some].astype(np.int32)))
                    here = np.arange(at + k, at + k + len(texts))
                    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
                    own = ids.take(pa.array(here))
                    yield _columns(name=pa.array(row[here]), marker=own, id=own, row=pa.array(row[here]),
                                   at=pa.array(np.zeros(len(here), np.int32)),
                                   width=pa.array((-1 - sizes).astype(np.int32)))

    return docs.select("_id", "_row", "_text").mapInArrow(
        rows, f"name long, marker {kind}, id {kind}, row long, at int, width int")


def once(rows: DataFrame, *by: str, keep: str = "false") -> DataFrame:
    """(id, row, at, width) of the rows whose key occurs once, and of those for which ``keep`` holds."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("id", "row", "at", "width")]) \
        .where(f"n = 1 or {keep}").select("id", "row", "at", "width")


def possible_windows(docs: DataFrame, window: int, min_words: int) -> DataFrame:
    """Documents with windows that may repeat: (id, row, ranges of starts)."""
    single = once(symbol_rows(docs, window, min_words), "name", "marker", keep="width < 0")

    def left(at: pa.Array, width: pa.Array) -> pa.Array:
        out = []
        for a, w in zip(at, width, strict=True):
            low, size = a.values.to_numpy(), w.values.to_numpy()
            marker = size < 0
            n = int(-1 - size[marker][0]) if marker.any() else 0
            low, size = low[~marker], size[~marker]
            out.append([{"lo": x, "hi": y} for x, y in as_ranges(windows_left(n, low, low + size, window))])
        return pa.array(out, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))

    udf = F.arrow_udf(left, "array<struct<lo: long, hi: long>>")
    lists = single.groupBy("id", "row").agg(F.collect_list(F.struct("at", "width")).alias("s"))
    return lists.select("id", "row", udf("s.at", "s.width").alias("ranges")).where(F.size("ranges") > 0)


def window_rows(texts: DataFrame, window: int) -> DataFrame:
    """Hashes of the words of every remaining window, with id and place."""
    kind = dict(texts.dtypes)["_id"]

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = xxhash.xxh3_128_digest
        for batch in it:
            for k in range(batch.num_rows):
                w = (batch.column(2)[k].as_py() or "").encode().split()
                starts = unfold(batch.column(3)[k].as_py())
                ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
                begins = np.r_[0, ends[:-1] + 1]
                joined = b" ".join(w)
                for i in range(0, len(starts), CHUNK):
                    part = starts[i:i + CHUNK]
                    h = np.frombuffer(b"".join([one(joined[a:b]) for a, b in zip(
                        begins[part].tolist(), ends[part + window - 1].tolist(), strict=True)]), "<i8").reshape(-1, 2)
                    n = len(part)
                    row = np.full(n, batch.column(1)[k].as_py(), np.int64)
                    yield _columns(h1=pa.array(h[:, 0].copy()), h2=pa.array(h[:, 1].astype(np.int32)),
                                   id=batch.column(0).take(pa.array(np.full(n, k))), row=pa.array(row),
                                   at=pa.array(part.astype(np.int32)), width=pa.array(np.zeros(n, np.int32)))

    return texts.select("_id", "_row", "_text", "ranges").mapInArrow(
        rows, f"h1 long, h2 int, id {kind}, row long, at int, width int")


def remove_repeats(docs: DataFrame, window: int = 35, min_words: int = 3, broadcast_bytes: int = 64 << 20,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept, removed) for every row of ``docs``.

    ``kept`` holds the words that stay, joined by single spaces; ``removed`` the word
    spans (start, stop) covered by windows whose words also start anywhere else.
    """
    narrow = small_batches(docs).select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_row"),
                         F.col(text_col).alias("_text"))
    possible = written(possible_windows(narrow, window, min_words), "possible")
    keys = possible.select(F.col("id").alias("_k_id"), F.col("row").alias("_k_row"))
    # an id's own bytes, the text's hash and what a row of a hash table costs
    size = keys.agg(F.sum(F.coalesce(F.octet_length(F.col("_k_id").cast("string")), F.lit(0)) + 48)).first()[0] or 0
    hint = F.broadcast if size <= broadcast_bytes else (lambda x: x)
    same = F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_row") == F.col("_k_row"))
    ranges = possible.select(F.col("id").alias("_r_id"), F.col("row").alias("_r_row"), "ranges")
    texts = written(
        narrow.join(hint(keys), same, "left_semi")
        .join(ranges, F.col("_id").eqNullSafe(F.col("_r_id")) & (F.col("_row") == F.col("_r_row")))
        .select("_id", "_row", "_text", "ranges"), "texts")
    single = once(window_rows(texts, window), "h1", "h2").groupBy("id", "row") \
        .agg(F.collect_list("at").alias("single")).select(F.col("id").alias("_s_id"), F.col("row").alias("_s_row"), "single")
    arrow = pa.struct([("n_words", pa.int64()), ("kept", pa.string()),
                       ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])

    def cut(text: pa.Array, ranges: pa.Array, single: pa.Array) -> pa.Array:
        out = []
        for k in range(len(text)):
            w = (text[k].as_py() or "").encode().split()
            repeated = np.setdiff1d(unfold(ranges[k].as_py()), np.array(single[k].as_py() or [], np.int64))
            gone = np.zeros(len(w) + 1, np.int64)
            np.add.at(gone, repeated, 1)
            np.add.at(gone, repeated + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            spans = [{"start": a, "stop": b} for a, b in as_ranges(np.flatnonzero(gone))]
            kept = b" ".join([x for x, g in zip(w, gone.tolist(), strict=True) if not g]).decode()
            out.append({"n_words": len(w), "kept": kept, "removed": spans})
        return pa.array(out, arrow)

    udf = F.arrow_udf(cut, "struct<n_words: long, kept: string, removed: array<struct<start: long, stop: long>>>")
    changed = texts.join(single, F.col("_id").eqNullSafe(F.col("_s_id")) & (F.col("_row") == F.col("_s_row")), "left") \
        .select("_id", udf("_text", "ranges", "single").alias("c")).select("_id", "c.n_words", "c.kept", "c.removed")
    split = words(F.col("_text"), SPACES)
    same_text = narrow.join(hint(keys), same, "left_anti").select(
        "_id", split.alias("w")).select("_id", F.size("w").cast("long").alias("n_words"), F.array_join("w", " ").alias("kept"),
                                        F.array().cast("array<struct<start: long, stop: long>>").alias("removed"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return changed.unionByName(same_text).select(
        F.col("_id").alias(id_col), "n_words", n_removed.alias("n_removed"), "kept", "removed")
