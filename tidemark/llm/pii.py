"""Information-theoretic sanitisation of personal data, with DataFrame functions only.

Base spans: e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone
numbers, leftmost and non-overlapping per kind.  Every distinct base value is a
protected entity.

The method adds the words that give an entity away.  Over all distinct texts,
``n(e)`` counts those with entity e, ``n(t)`` those with term t and ``n(t, e)`` those
with e and, outside the base values, t, at any distance.  The term discloses the share
``PMI(t; e) / IC(e)`` of the entity, with ``PMI = log(n(t,e) N / (n(t) n(e)))`` and
``IC = log(N / n(e))``, times a discount for little evidence, ``n(t,e) / (n(t,e) + 1) * m / (m + 1)`` with
m the lesser of n(t) and n(e).  Without it every rare word of a text would identify the values of that one text.  At
``generalise`` or more the term is replaced by its general form wherever it stands in a text with the
entity; at ``remove`` or more it is removed there.  It is removed in every other text as well if it also
identifies the entity without the base value: if, with 95 % confidence, at least the share ``certain`` of its texts has it.  Every entity is scored, also one seen in a single text:
there no share passes a quarter.

Statistics are sums over the whole corpus with pre-aggregation; copies of a text
count once.  Entities that stand in the same set of texts have the same shares and are
scored once: the set is known by its size and two sums (xor) of hashes.  The terms in
question and those to remove outside the entity's texts are broadcast if there are at
most ``broadcast_terms``, counted first; otherwise all terms are counted, or all words
joined.  A term that no text without the entity has is not looked for outside.

Every pattern is written so that matching takes linear time: a match can only start
at the start of a run of its first character class or where the last match ended.

Defined cases: null text counts as empty and stays null; very long texts are cut into pieces of words for matching, never shortened; texts without base values and
without terms to remove stay as they are; an entity that is in every text has no information content and
discloses nothing; repeated rows each get a row; extra columns are ignored here and
kept by ``sanitise``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NON_WORDS, fresh, lower_ascii, written

KINDS = ["email", "ip", "card", "phone", "term"]
#: The contract's patterns.  ``(?:\G|(?<!..))`` and the possessive ``++`` change no
#: match, since what follows a run is never part of its class; they keep long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to have a match of the kind.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.", "card": r"(?:[0-9][\x20-]?){15}[0-9]", "phone": r"\+[0-9]"}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Pieces of lowered text that end where a word ends or between words; ``matches`` is for short strings.
PIECE = r"(?s).{1,512}[^\x00-\x2F\x3A-\x60\x7B-\x7F]*+"
SPAN = "array<struct<kind: int, start: int, stop: int, value: string>>"


def matches(text: Column, pattern: str | Column) -> Column:
    """Code point spans and strings of all matches: what lies between them gives their places."""
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, stop: int, value: string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), stop.alias("stop"), x["hit"].alias("value"))
        return F.when(x["hit"].isNull(), acc) \
            .otherwise(F.struct(stop.alias("at"), F.array_append(acc["out"], span).alias("out")))

    return F.aggregate(both, zero, add, lambda acc: acc["out"])


def luhn(digits: Column) -> Column:
    """Whether the digit string passes the Luhn check."""
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)"
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: value.rlike(rf"^(?!.*(?:^|\.)(?:\.|$)){part}\.{part}\.{part}\.{part}$"),
        "card": lambda: F.length(digits).between(16, 19) & luhn(digits),
        "phone": lambda: F.length(digits).between(8, 15),
    }[kind]()


def _valid_match(kind: str):
    return lambda m: valid(kind, m["value"])


def _of_kind(k: int):
    return lambda m: F.struct(F.lit(k).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop"),
                              m["value"].alias("value"))


def base_spans(text: Column) -> Column:
    """All base spans by kind and start; an empty array for texts without."""
    none = F.array().cast(SPAN)
    parts = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        found = F.filter(matches(text, pattern), _valid_match(kind))
        found = F.transform(found, _of_kind(k))
        parts.append(F.when(text.rlike(HINTS[kind]), found).otherwise(none))
    return F.concat(*parts)


def places(rows: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Every word of ``_text`` (in lower case) that meets no span of ``base``: (_id, _row, term, start, stop).

    ``only`` is a broadcast table of terms: pieces are searched for those of them that they have.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at: int, piece: string>>").alias("out"))
    cut = F.aggregate(
        F.regexp_extract_all(lower_ascii(F.col("_text")), F.lit(PIECE), F.lit(0)), zero,
        lambda acc, x: F.struct((acc["at"] + F.length(x)).alias("at"),
                                F.array_append(acc["out"], F.struct(acc["at"].alias("at"), x.alias("piece"))).alias("out")),
        lambda acc: acc["out"])
    pieces = rows.select("_id", "_row", "base", F.explode(cut).alias("p")).select("_id", "_row", "base", "p.at", "p.piece")
    pattern = WORD
    if only is not None:
        pieces = pieces.withColumn("term", F.explode(F.array_distinct(F.split("piece", NON_WORDS)))).join(only, "term", "left_semi")
        pattern = F.concat(F.lit(f"(?<!{WORD[:-1]})"), F.col("term"), F.lit(f"(?!{WORD[:-1]})"))   # words have no special characters
    found = F.transform(matches(F.col("piece"), pattern), lambda m: F.struct(
        m["value"].alias("term"), (m["start"] + F.col("at")).alias("start"), (m["stop"] + F.col("at")).alias("stop")))
    beside = F.filter("base", lambda b: (b["start"] < F.col("at") + F.length("piece")) & (F.col("at") < b["stop"]))
    return pieces.withColumn("base", beside).select("_id", "_row", "base", F.explode(found).alias("w")) \
        .where((F.size("base") == 0) | ~_meets(F.col("w"), "base")).select("_id", "_row", "w.term", "w.start", "w.stop")


def _meets(span: Column, base: str) -> Column:
    return F.exists(base, lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))


def evidence(n_te: Column, n_t: Column, n_e: Column) -> Column:
    """Discount for few texts: 1/4 for a single one, 9/16 for three, towards one for many."""
    low = F.least(n_t, n_e)
    return n_te / (n_te + 1) * low / (low + 1)


def certainty(n_te: Column, n_t: Column) -> Column:
    """Lower bound of the share of the term's texts that have the entity, at 95 % (Wilson)."""
    z, p = F.lit(1.96), n_te / n_t
    return (p + z * z / (2 * n_t) - z * F.sqrt(p * (1 - p) / n_t + z * z / (4 * n_t * n_t))) / (1 + z * z / n_t)


@dataclass
class Scores:
    """What the corpus says.  ``units`` (_row, n_e, x, y) has the entities of each text, those of the same texts as one; ``shares`` has
    every pair (n_e, x, y, term, n_te, n_t, share); ``entities`` (kind, value, n_e, x, y) names the units' values."""

    found: DataFrame
    joint: DataFrame
    entities: DataFrame
    shares: DataFrame


UNIT = ["n_e", "x", "y"]


def score(docs: DataFrame, broadcast_terms: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> Scores:
    """Shares of all terms of all entities; nothing is left out for having few texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_row"), text.alias("_text"))
    found = written(rows.withColumn("base", base_spans(F.col("_text"))).where(F.size("base") > 0)
                    .dropDuplicates(["_id", "_row"]), "pii")
    pairs = found.select("_row", F.explode("base").alias("b")) \
        .select("_row", "b.kind", lower_ascii(F.col("b.value")).alias("value")).distinct()
    entities = pairs.groupBy("kind", "value").agg(
        F.count("*").alias("n_e"), F.bit_xor(F.xxhash64("_row")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "_row")).alias("y"))
    units = pairs.join(entities, ["kind", "value"]).select("_row", *UNIT).distinct()
    joint = written(units.join(places(found).select("_row", "term").distinct(), "_row"), "joint")
    texts = written(rows.groupBy("_row").agg(F.count("*").alias("copies")), "texts")
    total, n_copied = texts.agg(F.count("*"), F.count_if(F.col("copies") > 1)).first()
    terms = joint.select("term").distinct()

    # the copies of a text share a count of one; the sum of shares is off by far less than a half
    copied = texts.where(F.col("copies") > 1)
    seen = rows.join(F.broadcast(copied) if n_copied <= broadcast_terms else copied, "_row", "left").select(
        F.explode(F.array_distinct(F.split(lower_ascii(F.col("_text")), NON_WORDS))).alias("term"),
        (F.lit(1.0) / F.coalesce("copies", F.lit(1))).alias("part"))
    if terms.count() <= broadcast_terms:
        seen = seen.join(F.broadcast(terms), "term", "left_semi")
    df = seen.groupBy("term").agg(F.round(F.sum("part")).cast("long").alias("n_t"))
    n_te, n_t, n_e = F.col("n_te"), F.col("n_t"), F.col("n_e")
    pmi, ic = F.log(n_te * F.lit(float(total)) / (n_t * n_e)), F.log(F.lit(float(total)) / n_e)
    shares = joint.groupBy(*UNIT, "term").agg(F.count("*").alias("n_te")).join(df, "term") \
        .where(n_e < F.lit(total)).withColumn("share", pmi / ic * evidence(n_te, n_t, n_e))
    return Scores(found, joint, entities, shares)


def find(docs: DataFrame, generalise: float = 0.5, remove: float = 0.75, certain: float = 0.6, broadcast_terms: int = 200_000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with base values or terms: (_id, _row, base, terms), one row for each distinct pair of id and text.

    ``terms`` has (start, stop, action), sorted, with action ``remove`` or ``generalise``.
    """
    scores = score(docs, broadcast_terms, id_col, text_col)
    found = scores.found
    disclosed = written(scores.shares.where(F.col("share") >= generalise).select(
        *UNIT, "term", (F.col("share") >= remove).alias("gone"),
        ((F.col("n_t") > F.col("n_te")) & (certainty(F.col("n_te"), F.col("n_t")) >= certain)).alias("elsewhere")), "disclosed")
    beside = scores.joint.join(disclosed, [*UNIT, "term"]).groupBy("_row", "term").agg(F.max("gone").alias("gone"))
    marked = places(found.join(beside.select("_row").distinct(), "_row", "left_semi")).join(beside, ["_row", "term"]).drop("term")
    outside = disclosed.where(F.col("gone") & F.col("elsewhere")).select("term").distinct()
    n_outside = outside.count()
    if n_outside:
        text = F.coalesce(F.col(text_col), F.lit(""))
        every = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_row"), text.alias("_text")) \
            .withColumn("base", F.array().cast(SPAN))
        every = places(every, F.broadcast(outside)) if n_outside <= broadcast_terms else places(every).join(outside, "term")
        marked = marked.unionByName(every.drop("term").withColumn("gone", F.lit(True)))
    action = F.when(F.col("gone"), "remove").otherwise("generalise").alias("action")
    spans = marked.groupBy("_id", "_row", "start", "stop").agg(F.max("gone").alias("gone")) \
        .select("_id", "_row", F.lit(None).cast(SPAN).alias("base"), F.struct("start", "stop", action).alias("term"))
    bases = found.select("_id", "_row", "base", F.lit(None).cast("struct<start: int, stop: int, action: string>").alias("term"))
    merged = bases.unionByName(spans).groupBy("_id", "_row").agg(
        F.coalesce(F.first("base", ignorenulls=True), F.array().cast(SPAN)).alias("base"),
        F.array_sort(F.collect_list("term")).alias("terms"))
    return merged.withColumn("terms", F.filter("terms", lambda t: ~_meets(t, "base"))) \
        .where((F.size("base") > 0) | (F.size("terms") > 0))


def masked(text: Column, base: Column, terms: Column) -> Column:
    """The text with base values and generalised terms replaced by their kind and removed terms left out."""
    labels = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS[:-1]])
    every = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"),
                                             F.get(labels, s["kind"]).alias("by"))),
        F.transform(terms, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"),
                                              F.when(s["action"] == "remove", "").otherwise("<TERM>").alias("by")))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        by = F.when(s["start"] >= acc["at"], s["by"]).otherwise("")      # overlapping spans: one replacement
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.concat(acc["out"], kept, by).alias("out"))

    return F.aggregate(every, zero, add, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with three more columns (renamed if taken): ``pii`` (base spans), ``terms`` and ``clean_text``."""
    pii, terms, clean, row = fresh(docs, "pii", "terms", "clean_text", "_row")
    found = find(docs, id_col=id_col, text_col=text_col, **settings)
    left = docs.withColumn(row, F.xxhash64(F.col(text_col))).alias("d")
    right = found.select(F.col("_id").alias("_f_id"), F.col("_row").alias("_f_row"), F.col("base").alias("_f_base"),
                         F.col("terms").alias("_f_terms")).alias("f")
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("f._f_id")) & F.col(f"d.`{row}`").eqNullSafe(F.col("f._f_row"))
    text = F.col(f"d.`{text_col}`")
    new = F.when(F.col("f._f_row").isNull(), text).otherwise(masked(text, F.col("f._f_base"), F.col("f._f_terms")))
    return left.join(right, same, "left").select(
        *[F.col(f"d.`{c}`") for c in docs.columns], F.coalesce("f._f_base", F.array().cast(SPAN)).alias(pii),
        F.coalesce("f._f_terms", F.array().cast("array<struct<start: int, stop: int, action: string>>")).alias(terms),
        new.alias(clean))


def joined_spans(base: str, terms: str | None = None) -> Column:
    """``kind:start:end`` of all spans by kind, then start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(base, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    if terms is not None:
        text = F.concat(text, F.transform(terms, lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"),
                                                                       s["stop"].cast("string"))))
    return F.concat_ws(",", text)
