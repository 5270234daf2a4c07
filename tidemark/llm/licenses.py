"""License scan by diagonal voting, with DataFrame functions only.

Templates are phrases and notices, as words.  All rolling word k-gram hashes of a
document (k is 3, or 2 for templates of two words) are joined to the positions
where templates have them, and the words are compared, so a collision is no hit.
A hit votes for the diagonal ``document position - template position``.  Votes are
added up per (document, template, diagonal); diagonals up to ``shift`` apart, as
inserted or left out words make them, are merged into one span.  A span is
verified if it covers at least ``min_cover`` of the template's k-grams within at
most twice its length.

One pass: words are exploded, hashed and joined with the broadcast templates (a
fixed list, hundreds of k-grams; larger lists are joined by a shuffle) in the scan's
stage; only hits and one marker for each document are shuffled, and votes are
pre-aggregated.

Defined cases: null text counts as empty; repeated rows each get a row; a template
without two words is an error; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import NON_WORDS, lower_ascii, words

#: The contract's phrases and labels.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
#: Opening words of public license notices, and the one-line forms of them.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("mit", "released under the mit license"),
]
BROADCAST_GRAMS = 50_000


def gram_rows(templates: list[tuple[str, str, bool]]) -> list[tuple]:
    """(k, words, template number, position) of every k-gram of every template."""
    out = []
    for t, (_, text, _) in enumerate(templates):
        w = text.split()
        if len(w) < 2:
            raise ValueError("a template needs two words")
        k = min(3, len(w))
        out += [(k, w[i:i + k], t, i) for i in range(len(w) - k + 1)]
    return out


def scan(docs: DataFrame, phrases: list[tuple[str, str]] | None = None, notices: list[tuple[str, str]] | None = None,
         shift: int = 3, min_cover: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, places, spans) for every row of ``docs``.

    ``places``: (label, start) where a phrase stands, sorted by start.  ``spans``: (label,
    start, stop, cover) of verified spans of templates, in words, sorted; ``best`` is
    the largest cover of any span, verified or not.
    """
    spark = docs.sparkSession
    templates = [(a, b, True) for a, b in (PHRASES if phrases is None else phrases)] \
        + [(a, b, False) for a, b in (NOTICES if notices is None else notices)]
    if any(not exact and len(text.split()) < 4 for _, text, exact in templates) or \
            any(exact and len(text.split()) > 3 for _, text, exact in templates):
        raise ValueError("phrases have two or three words, notices at least four")
    grams = gram_rows(templates)
    # as a view of literals: no Python process reads it
    table = _literals(spark, grams).withColumn("h", F.transform("gram", lambda w: F.xxhash64(w)))
    hint = F.broadcast if len(grams) <= BROADCAST_GRAMS else (lambda x: x)

    keep = ["_id", "_row"]
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_row"),
                       words(lower_ascii(F.col(text_col)), NON_WORDS).alias("_w")) \
        .withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w))) \
        .select(*keep, "_w", "_h", F.posexplode_outer("_h").alias("_p", "_one"))
    for k in (2, 3):
        right = table.where(F.col("k") == k).groupBy(F.xxhash64(*[F.get("h", F.lit(i)) for i in range(k)]).alias(f"_key{k}"), "gram") \
            .agg(F.collect_list(F.struct("t", "i")).alias(f"_hit{k}")).withColumnRenamed("gram", f"_gram{k}")
        key = F.when(F.col("_p") <= F.size("_w") - k, F.xxhash64(*[F.get("_h", F.col("_p") + i) for i in range(k)]))
        same = (key == F.col(f"_key{k}")) & (F.slice("_w", F.col("_p") + 1, k) == F.col(f"_gram{k}"))
        rows = rows.join(hint(right), same, "left")
    none = F.array().cast("array<struct<t: int, i: int>>")
    first = F.coalesce("_p", F.lit(0)) == 0
    seen = rows.where(first | F.col("_hit2").isNotNull() | F.col("_hit3").isNotNull()).select(
        *keep, F.size("_w").alias("n_words"), first.alias("first"), F.col("_p").alias("p"),
        F.explode_outer(F.concat(F.coalesce("_hit2", none), F.coalesce("_hit3", none))).alias("hit"))
    # a position with several template positions repeats its marker, so a marker is the first hit's
    votes = seen.groupBy(*keep, F.col("hit.t").alias("t"), (F.col("p") - F.col("hit.i")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"), F.count_if("first").alias("firsts"),
        F.count_distinct("hit.i").alias("votes"), F.min("p").alias("start"), F.max("p").alias("last"))
    sizes = F.create_map(*[F.lit(x) for t, (_, text, _) in enumerate(templates) for x in (t, len(text.split()))])
    labels = F.array(*[F.lit(label) for label, _, _ in templates])
    n_phrases = sum(exact for _, _, exact in templates)
    size = F.element_at(sizes, F.col("t"))
    order = W.partitionBy(*keep, "t").orderBy("diagonal")
    jump = F.col("diagonal") - F.lag("diagonal").over(order)
    part = F.when((F.col("t") >= n_phrases) & (jump <= shift), 0).otherwise(1)
    merged = votes.withColumn("_new", part).withColumn("_span", F.sum("_new").over(order)) \
        .groupBy(*keep, "t", "_span").agg(F.max("n_words").alias("n_words"), F.max("firsts").alias("firsts"),
                                          F.sum("votes").alias("votes"), F.min("start").alias("start"),
                                          F.max("last").alias("last"))
    k = F.least(size, F.lit(3))
    cover = F.least(F.lit(1.0), F.col("votes") / (size - k + 1))
    stop = F.col("last") + k
    good = F.col("t").isNotNull() & (cover >= min_cover) & (stop - F.col("start") <= 2 * size)
    label = F.get(labels, F.col("t"))
    place = F.when(F.col("t") < n_phrases, F.struct(F.col("start").alias("start"), label.alias("label")))
    span = F.when(good, F.struct(F.col("start").alias("start"), stop.alias("stop"), label.alias("label"), cover.alias("cover")))
    return merged.groupBy(*keep).agg(
        F.max("n_words").cast("long").alias("n_words"), F.max("firsts").alias("_n"),
        F.array_sort(F.collect_list(place)).alias("places"), F.array_sort(F.collect_list(span)).alias("spans"),
        F.coalesce(F.max(F.when(F.col("t").isNotNull(), cover)), F.lit(0.0)).alias("best")) \
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(F.col("_n"), F.lit(1)).cast("int")))) \
        .select(F.col("_id").alias(id_col), "n_words", "places", "spans", "best")


def _literals(spark: SparkSession, grams: list[tuple]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.array(*map(F.lit, gram)).alias("gram"), F.lit(t).alias("t"),
                              F.lit(i).alias("i")) for k, gram, t, i in grams])
    return spark.range(1).select(F.explode(rows).alias("g")).select("g.*")


def label_text(arrays: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(arrays)), ",")
