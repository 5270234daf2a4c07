"""Benchmark decontamination by winnowing, with DataFrame functions only.

Every ``span`` consecutive words of a benchmark item are a window (an item of
fewer words is one window).  Each sliding window keeps the smallest of its k-gram
hashes, the first of equal ones; the places kept by any window are a text's
fingerprints, about two in ``span - k + 2`` words.  Two equal windows keep the same
hash at the same place inside them, so joining a document's fingerprints with the
benchmark's windows finds every shared span of ``span`` words or more.  A hit is
extended to both sides to the whole window and compared word by word, so hash
collisions and windows that share one k-gram only drop out.  Windows shorter than
``span`` words have no such guarantee; their lengths (fewer than ``span`` values) are
looked up by the hash of the whole window.

One pass over the documents: words are exploded, fingerprints selected and joined in
the scan's own stage, and only hits and one marker for each document are shuffled.
Equal benchmark windows are grouped first, so a window costs the same whether one
item or a third of all have it.  The windows are broadcast if there are at most
``broadcast_windows`` of them, counted first; more are joined by a shuffle on the
fingerprint, for which a document's fingerprint takes along the words around it that
a window can hold, never its text.

Defined cases: null text has no words and is never hit, a null item neither;
a very long text is rows of words like any other; equal hashes in a window tie, and
the first counts; repeated rows of documents each get a row; repeated items count once by
their id; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NON_WORDS, lower_ascii, narrow_parts, words, written


def _hash_at(hashes: str, start: Column, n: int) -> Column:
    """Hash of ``n`` words from ``start``, from the array of word hashes."""
    return F.xxhash64(*[F.get(hashes, start + F.lit(k)) for k in range(n)])


def _grams(hashes: str, k: int) -> Column:
    """Hashes of all k-grams of the words, in their order; empty for fewer than ``k`` words."""
    starts = F.when(F.size(hashes) >= k, F.sequence(F.lit(0), F.size(hashes) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda p: F.xxhash64(*[F.get(hashes, p + F.lit(i)) for i in range(k)]))


def _smallest(grams: str, start: Column, n: int) -> tuple[Column, Column]:
    """The smallest of ``n`` hashes from ``start``, and how far from there the first such is.

    The lowest bits of each hash give way to its place, so one minimum yields both; a deeper
    expression would outgrow what the JVM compiles.
    """
    bits = (n - 1).bit_length()
    low = F.least(*[F.shiftleft(F.shiftright(F.get(grams, start + F.lit(i)), bits), bits).bitwiseOR(F.lit(i)) for i in range(n)]) \
        if n > 1 else F.get(grams, start)
    return F.shiftright(low, bits), low.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _word_rows(df: DataFrame, text: str) -> DataFrame:
    """``_w`` the words of the text and ``_h`` their hashes."""
    return df.withColumn("_w", words(lower_ascii(F.col(text)), NON_WORDS)) \
        .withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))


def item_windows(benchmark: DataFrame, span: int, k: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct windows: number, length, fingerprint, its place in the window, words, ids of the items that have them (as text)."""
    rows = _word_rows(benchmark.select(F.col(item_col).cast("string").alias("_item"), F.col(text_col).alias("_text")),
                      "_text").where(F.size("_w") > 0)
    n = F.least(F.size("_w"), F.lit(span))
    rows = rows.select("_item", "_w", "_h", n.alias("len"),
                       F.explode(F.sequence(F.lit(0), F.size("_w") - n)).alias("_p"))
    rows = rows.withColumn("_g", _grams("_h", k))
    low, offset = _smallest("_g", F.col("_p"), span - k + 1)
    key = F.when(F.col("len") == span, low)
    for short in range(1, span):
        key = key.when(F.col("len") == short, _hash_at("_h", F.col("_p"), short))
    return rows.select("len", key.alias("key"), F.when(F.col("len") == span, offset).otherwise(0).alias("offset"),
                       F.slice("_w", F.col("_p") + 1, F.col("len")).alias("window"), "_item") \
        .groupBy("len", "key", "offset", "window").agg(F.collect_set("_item").alias("items")) \
        .withColumn("win", F.monotonically_increasing_id())


def hits(docs: DataFrame, windows: DataFrame, keep: list[str], span: int = 10, k: int = 4,
         broadcast_windows: int = 200_000) -> DataFrame:
    """Per distinct row of ``keep``: n_rows, n_words, starts of hit windows with their length, window numbers.

    ``docs`` has the columns ``keep`` and ``_text``; ``windows`` is a written table.
    """
    lengths = {r["len"]: r["count"] for r in windows.groupBy("len").count().collect()}   # at most ``span`` rows
    small = sum(lengths.values()) <= broadcast_windows
    around = span - k                   # words of a window on either side of its fingerprint's first word, at most
    rows = _word_rows(docs, "_text").withColumn("_n", F.size("_w"))
    starts = F.sequence(F.lit(0), F.greatest(F.col("_n") - span, F.lit(0)))       # at least one, for the document's marker

    def joined(left: DataFrame, length: int, begin: Column, end: Column, keep_all: bool) -> DataFrame:
        """Rows (_key, _at, _w, _n) with the windows whose words stand ``offset`` words before ``_at``.

        ``begin`` and ``end`` bound the words that any such window can hold.
        """
        right = windows.where(F.col("len") == length).select("key", "offset", "window", "win")
        low = F.greatest(begin, F.lit(0))
        if small:                            # the words stay where they are, in the scan's stage
            right, left = F.broadcast(right), left.withColumn("_from", F.lit(0))
        else:
            part = F.when(F.col("_key").isNotNull(), F.slice("_w", low + 1, F.greatest(F.least(end, F.col("_n")) - low, F.lit(0))))
            left = left.withColumn("_from", low).withColumn("_w", part)
        left = left.select(*keep, "_key", "_at", "_from", "_w", "_n", "_mark")
        start = F.col("_at") - F.col("offset")
        # a slice cannot begin before the array: those windows reach beyond the text
        inside = F.slice("_w", F.greatest(start - F.col("_from"), F.lit(0)) + 1, length) == F.col("window")
        same = (F.col("_key") == F.col("key")) & (start >= 0) & inside
        out = left.join(right, same, "left" if keep_all else "inner")
        return out.select(*keep, F.col("_n").alias("n_words"), F.col("_mark").alias("marker"), start.alias("start"),
                          F.lit(length).alias("len"), "win")

    # a row for each window: it counts if it is the first to keep its fingerprint
    full = rows.withColumn("_g", _grams("_h", k)).select(*keep, "_w", "_n", "_g", F.explode(starts).alias("_p"))
    low, offset = _smallest("_g", F.col("_p"), around + 1)
    _, offset_before = _smallest("_g", F.col("_p") - 1, around + 1)
    fits = F.col("_p") <= F.col("_n") - span
    full = full.select(*keep, "_w", "_n", (F.col("_p") == 0).alias("_mark"), F.when(fits, low).alias("_key"),
                       (F.col("_p") + offset).alias("_at"),
                       (fits & ((F.col("_p") == 0) | (offset_before != offset + 1))).alias("_new")) \
        .where(F.col("_mark") | F.col("_new"))
    out = joined(full, span, F.col("_at") - around, F.col("_at") + span, True)
    for length in sorted(x for x in lengths if x < span):
        key = _hash_at("_h", F.col("_p"), length)
        short = rows.select(*keep, "_w", "_n", "_h", F.posexplode("_h").alias("_p", "_one")) \
            .where(F.col("_p") <= F.col("_n") - length) \
            .select(*keep, "_w", "_n", key.alias("_key"), F.col("_p").alias("_at"), F.lit(False).alias("_mark"))
        out = out.unionByName(joined(short, length, F.col("_at"), F.col("_at") + length, False))
    # one window may be hit by several rows of the join, and equal rows of documents meet here
    out = out.groupBy(*keep, "start", "len", "win").agg(F.max("n_words").alias("n_words"),
                                                      F.count_if("marker").alias("n_rows"))
    at = F.when(F.col("win").isNotNull(), F.struct("start", (F.col("start") + F.col("len")).alias("stop")))
    return out.groupBy(*keep).agg(
        F.max("n_words").alias("n_words"), F.max("n_rows").alias("n_rows"),
        F.array_sort(F.collect_set(at)).alias("spans"), F.collect_set("win").alias("wins"))


def covered(spans: str) -> Column:
    """Number of words inside any of the sorted spans."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    return F.aggregate(spans, zero, lambda acc, s: F.struct(
        F.greatest(acc["upto"], s["stop"]).alias("upto"),
        (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(acc["upto"], s["start"]))).alias("n")),
        lambda acc: acc["n"].cast("long"))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 4,
                  broadcast_windows: int = 200_000, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, row, n_words, n_hit, spans, items) for every row of ``docs``.

    ``row`` is the XXH64 of the text, ``spans`` are the hit windows as word positions (stop exclusive, sorted),
    ``items`` the ids of the items that have an occurring window, as sorted text.
    """
    windows = written(item_windows(benchmark, span, k, item_col, item_text_col), "windows", narrow=True)
    keep = ["_id", "_row"]
    # the text's hash keeps rows apart that share an id but not the text
    narrow = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_row"), F.col(text_col).alias("_text"))
    # read twice below, by different columns: written, so that the pass over the texts runs once
    per_doc = written(hits(narrow, windows, keep, span, k, broadcast_windows), "hits", narrow=True)
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    hit = per_doc.where(F.size("wins") > 0)
    # few rows: documents with hits; equal windows were grouped, so each brings its items once
    named = hit.select(*keep, "n_words", "n_rows", "spans", F.explode("wins").alias("win")) \
        .join(windows.select("win", "items"), "win") \
        .groupBy(*keep, "n_words", "n_rows", "spans").agg(items.alias("items")) \
        .coalesce(narrow_parts(docs.sparkSession))
    none = per_doc.where(F.size("wins") == 0).select(*keep, "n_words", "n_rows", "spans",
                                                     F.array().cast("array<string>").alias("items"))
    return named.unionByName(none) \
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))) \
        .select(F.col("_id").alias(id_col), F.col("_row").alias("row"), F.col("n_words").cast("long").alias("n_words"),
                covered("spans").alias("n_hit"), "spans", "items")
