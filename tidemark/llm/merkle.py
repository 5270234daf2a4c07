"""Merkle manifest of a table of documents: built levels as parent-linked nodes, proofs by a recursive query.

Every row is a leaf, the hash of its fields.  Within a group (here a language) the
leaves ascend by id, and every ``fan`` consecutive nodes become their parent, until one
is left: the group's subroot.  The subroots, ordered by group (null first, then
bytewise), are the leaves of the top tree, whose last node is the root.

``build`` stores the tree: a table of leaves and one of inner nodes, whose rows have
their own name, their parent's, their place among its children, and the hashes of
their own children; the nodes just above the leaves, seven of eight, stand with their leaves.
``climb`` is a recursive query over these tables: for each leaf it
ascends parent by parent, appends a step with its siblings and folds the hash that it
was given, true or tampered.  Its result is the proof, the steps' siblings in order, and the hash at the root.

Scale: leaves are numbered without a shuffle beyond one range partition of short rows
(``numbered``); a level is one aggregate with at most ``fan`` rows a group, and an eighth
of the one before.  The aggregate of the first level gives each leaf its run, so that the climb
begins with a step that joins nothing.  It meets the lower levels by a shuffled join, where a node
has at most ``fan ** level`` leaves below it, and the upper levels, at most ``broadcast_nodes`` nodes
of which the number is known before, by a broadcast: the few nodes that all leaves pass
never become one task's key.  Every level and each part of the climb is a written table.

Defined cases: a null field is ``-``; a null group is a group of its own and comes first;
null ids come first; rows of one id are ordered by their leaf; repeated rows have
equal leaves and each has its own place and proof; very long texts are hashed where they are
read and never shuffled; one leaf is its own subroot and, alone, the root, its proof
empty; an empty table has no leaves and no root (null); other columns are not hashed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: Column) -> Column:
    """The digest of the text as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def sha_of(digests: Column) -> Column:
    """The digest of digests that stand one after another, each taken as hex text."""
    return sha(F.lower(F.hex(digests)))


def leaf(fields: list[Column]) -> Column:
    """The digest of the fields: ``-`` if null, else byte count, colon, value."""
    texts = [f.cast("string") for f in fields]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


@dataclass
class Manifest:
    """A stored tree.

    ``leaves``: id, group, name, parent, slot, low, leaf, folded (the hash to climb with), subroot, run: the hashes of the
    leaves below the leaf's own parent, and that parent's own parent, slot and low; null for the one leaf of a group.
    ``lower`` and ``upper``: the other inner nodes (name, parent, slot, low, kids) with their children's hashes;
    ``upper`` is short enough to broadcast.  ``low``: whether the parent is in ``lower``.  ``root``: its digest, None for an empty table.
    """

    leaves: DataFrame
    lower: DataFrame | None
    upper: DataFrame
    root: bytes | None


def _name(tree: Column, level: int, at: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), F.lit(level).cast("string"), at.cast("string"))


def _runs(rows: DataFrame, fan: int) -> DataFrame:
    """The first level as ``_levels`` has it, and ``run``: the leaves below each node."""
    run = F.array_sort(F.collect_list(F.struct("at", "hash", "id", "group", "folded")))
    kids = F.aggregate("run", F.lit(b""), lambda acc, k: F.concat(acc, k["hash"]))
    runs = rows.where(F.col("n") > 1).groupBy("tree", F.floor(F.col("at") / fan).cast("long").alias("above")) \
        .agg(run.alias("run"), F.max("n").alias("n")).withColumn("kids", kids)
    return written(runs.select("tree", F.col("above").alias("at"), F.ceil(F.col("n") / fan).cast("long").alias("n"), "kids",
                               sha_of(F.col("kids")).alias("hash"), F.col("n").alias("leaves"), "run"), "runs")


def _levels(nodes: DataFrame, size: int, fan: int, label: str) -> list[DataFrame]:
    """Written levels 1, 2, ... over ``nodes`` (tree, at, hash, n: nodes of its tree); a tree stops when one node is left.

    ``size`` is the largest n.  Columns: tree, at, n, kids, hash; ``n`` of the level itself.
    """
    out: list[DataFrame] = []
    while size > 1:
        run = F.array_sort(F.collect_list(F.struct("at", "hash")))
        kids = F.aggregate(run, F.lit(b""), lambda acc, k: F.concat(acc, k["hash"]))
        nodes = nodes.where(F.col("n") > 1).groupBy("tree", F.floor(F.col("at") / fan).cast("long").alias("at")) \
            .agg(kids.alias("kids"), F.ceil(F.max("n") / fan).cast("long").alias("n")).withColumn("hash", sha_of(F.col("kids")))
        nodes = written(nodes, label, narrow=True)
        out.append(nodes)
        size = -(-size // fan)
    return out


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
          fan: int = 8, broadcast_nodes: int = 20_000, changed: dict[str, Column] | None = None,
          where: Column | None = None) -> Manifest:
    """The stored tree over ``docs``.

    ``changed`` has other values for some fields; the leaves ``where`` it holds climb with the hash of these.
    """
    folded = true = leaf([F.col(f) for f in fields])
    if changed:
        other = leaf([changed.get(f, F.col(f)) for f in fields])
        folded = F.when(where if where is not None else F.lit(True), other).otherwise(true)
    short = written(docs.select(F.col(id_col).alias("id"), F.col(group_col).cast("string").alias("group"),
                                true.alias("hash"), folded.alias("folded")), "hashes")
    rows = numbered(short, "group", ["id", "hash"], "at", "leaves")
    groups = written(rows.groupBy("group").agg(F.count("*").alias("n")), "groups", narrow=True)
    total, largest = groups.agg(F.count("*"), F.max("n")).first()
    if not total:
        name = F.lit("")
        none = F.lit(None).cast("struct<kids: binary, parent: string, slot: int, low: boolean>")
        leaves = rows.select("id", "group", name.alias("name"), name.alias("parent"), F.lit(0).alias("slot"), F.lit(False).alias("low"),
                             F.col("hash").alias("leaf"), "folded", F.col("hash").alias("subroot"), none.alias("run"))
        return Manifest(leaves, None, leaves.select("name", "parent", "slot", "low", F.col("leaf").alias("kids")), None)
    trees = written(numbered(groups, None, ["group"], "tree", "trees"), "trees", narrow=True)
    few = total <= broadcast_nodes
    same = F.col("l.group").eqNullSafe(F.col("t.group"))
    rows = written(rows.alias("l").join((F.broadcast(trees) if few else trees).alias("t"), same)
                   .select("l.*", "t.tree", "t.n"), "leaves")
    runs = _runs(rows, fan)
    first = runs.select("tree", "at", "n", "kids", "hash")
    inner = [first, *_levels(first, -(-largest // fan), fan, "level")] if largest > 1 else []
    tops = rows.where("n = 1").select("tree", "hash")
    for level in inner:
        tops = tops.unionAll(level.where("n = 1").select("tree", "hash"))
    tops = written(tops, "subroots", narrow=True)
    crown = _levels(tops.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("at"), "hash",
                                F.lit(total).cast("long").alias("n")), total, fan, "crown")
    root = (crown[-1] if crown else tops).first()["hash"]

    # whole levels go to the table that is broadcast, from the root down, as long as it stays short
    below: set[tuple[bool, int]] = set()
    room = broadcast_nodes
    for top, levels in ((True, crown), (False, inner)):
        for k in range(len(levels), 0 if top else 1, -1):
            room = room - levels[k - 1].count() if not below else -1
            if room < 0:
                below.add((top, k))

    def linked(level: DataFrame, top: bool, k: int) -> DataFrame:
        """Names, parents and slots of a level's nodes; a subroot's parent is in the top tree, the root has none."""
        alone = F.col("n") == 1
        across = alone & F.lit(not top and total > 1)
        over = alone & F.lit(top or total == 1)
        return level.withColumns({
            "name": _name(F.col("tree"), k, F.col("at")),
            "parent": F.when(over, None).when(across, _name(F.lit(-1), 1, F.floor(F.col("tree") / fan).cast("long")))
            .otherwise(_name(F.col("tree"), k + 1, F.floor(F.col("at") / fan).cast("long"))),
            "slot": (F.when(across, F.col("tree")).otherwise(F.col("at")) % fan).cast("int"),
            "low": ~over & F.when(across, F.lit((True, 1) in below)).otherwise(F.lit((top, k + 1) in below))})

    links = ["name", "parent", "slot", "low", "kids"]
    named = {(top, k): linked(level, top, k).select(*links)
             for top, levels in ((True, crown), (False, inner)) for k, level in enumerate(levels, 1) if top or k > 1}
    lower, upper = ([df for at, df in named.items() if (at in below) == low] for low in (True, False))
    nothing = rows.limit(0).select(F.lit("").alias("name"), F.lit("").alias("parent"), F.lit(0).alias("slot"),
                                   F.lit(False).alias("low"), F.lit(b"").alias("kids"))
    above = F.struct("kids", "parent", "slot", "low")
    many = linked(runs, False, 1).select("tree", F.col("leaves").alias("n"), above.alias("run"), F.explode("run").alias("of")) \
        .select("tree", "n", "run", "of.*")
    alone = rows.where("n = 1").withColumn("run", F.lit(None).cast(many.schema["run"].dataType))
    leaves = linked(many.unionByName(alone), False, 0) \
        .join((F.broadcast(tops) if few else tops).withColumnRenamed("hash", "subroot"), "tree") \
        .select("id", "group", *links[:4], F.col("hash").alias("leaf"), "folded", "subroot", "run")
    return Manifest(leaves, written(reduce(DataFrame.unionAll, lower), "lower") if lower else None,
                    written(reduce(DataFrame.unionAll, upper), "upper", narrow=True) if upper else nothing, bytes(root))


CLIMB = """
WITH RECURSIVE climb(start, step, parent, slot, low, folded) AS (
  SELECT start, step, parent, slot, low, folded FROM {begin}
  UNION ALL
  SELECT c.start, c.step + 1, n.parent, n.slot, n.low,
         unhex(sha2(cast(lower(hex(concat(substring(n.kids, 1, 32 * c.slot), c.folded,
                                          substring(n.kids, 32 * c.slot + 33)))) AS binary), 256))
  FROM (SELECT * FROM climb WHERE {goes_on}) c JOIN (SELECT {hint} name, parent, slot, low, kids FROM {nodes}) n ON c.parent = n.name
)
SELECT start, step, parent, slot, low, folded FROM climb
"""


def _ascend(state: DataFrame, nodes: DataFrame, goes_on: str, broadcast: bool) -> DataFrame:
    """The climb from ``state`` through ``nodes``: a row for each leaf and step, the last one that for which ``goes_on`` no longer holds."""
    spark = state.sparkSession
    names = [f"merkle_{uuid.uuid4().hex}" for _ in range(2)]
    for name, df in zip(names, (state, nodes), strict=True):
        df.createOrReplaceTempView(name)
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")       # a climb has a row for each leaf and level: no fixed number bounds it
    try:
        return written(spark.sql(CLIMB.format(begin=names[0], nodes=names[1], goes_on=goes_on,
                                              hint="/*+ BROADCAST */" if broadcast else "")), "climb")
    finally:
        spark.conf.set(limit, before)
        for name in names:
            spark.catalog.dropTempView(name)


def climb(tree: Manifest) -> DataFrame:
    """For each leaf: id, leaf, subroot, proof (siblings, 32 bytes each, from the leaf to the root), folded (the root reached).

    A step of the climb appends a row that points at the siblings: the children of its parent but one.  Spark shuffles
    every round of a recursive query, so the digests themselves join the steps once, after it.
    """
    before, after = F.substring("kids", F.lit(1), 32 * F.col("slot")), F.expr("substring(kids, 32 * slot + 33)")
    # the first step: a leaf has its parent's children and that parent's place at hand
    runs = tree.leaves.where("run IS NOT NULL").select(F.col("name").alias("start"), "slot", "folded", "run.kids",
                                                       F.struct("run.parent", "run.slot", "run.low").alias("above"))
    state = runs.select("start", F.lit(1).alias("step"), "above.parent", "above.slot", "above.low",
                        sha_of(F.concat(before, F.col("folded"), after)).alias("folded")) \
        .unionByName(tree.leaves.where("run IS NULL")
                     .select(F.col("name").alias("start"), F.lit(0).alias("step"), "parent", "slot", "low", "folded"))
    passed = [runs.select("start", F.struct(F.lit(0).alias("step"), F.concat(before, after).alias("siblings")).alias("passed"))]

    def siblings(rows: DataFrame, nodes: DataFrame) -> DataFrame:
        return rows.join(nodes.select(F.col("name").alias("parent"), "kids"), "parent") \
            .select("start", F.struct("step", F.concat(before, after).alias("siblings")).alias("passed"))

    if tree.lower is not None:
        rows = _ascend(state, tree.lower, "low", False)
        passed.append(siblings(rows.where("low"), tree.lower))
        state = rows.where("NOT low")
    rows = _ascend(state, tree.upper, "parent IS NOT NULL", True)
    passed.append(siblings(rows.where("parent IS NOT NULL"), F.broadcast(tree.upper)))
    first = tree.leaves.select(F.col("name").alias("start"), F.struct("id", "leaf", "subroot").alias("of"))
    last = rows.where("parent IS NULL").select("start", "folded")
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [first, last, *passed])
    ends = every.groupBy("start").agg(F.first("of", ignorenulls=True).alias("of"), F.first("folded", ignorenulls=True).alias("folded"),
                                      F.array_sort(F.collect_list("passed")).alias("passed"))
    return ends.select("of.*", F.aggregate("passed", F.lit(b""), lambda acc, p: F.concat(acc, p["siblings"])).alias("proof"), "folded")
