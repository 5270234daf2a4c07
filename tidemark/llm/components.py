"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import narrow_parts, written


def _least(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` (a, b) with ``m``, the smallest b of the row's a.

    Nodes with more than a ten thousandth of the rows (100 at least) are joined by a broadcast of fewer
    than 10,000 of them, so the edges of a hot node stay where they are; the rest is shuffled by node.
    """
    limit = max(100, total // 10_000)
    low = rows.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    few = narrow_parts(rows.sparkSession)
    hot = F.broadcast(low.where(F.col("n") > limit).select("a", "m").coalesce(few))
    return rows.join(hot, "a").unionByName(
        rows.join(hot.select("a"), "a", "left_anti").join(low.where(F.col("n") <= limit).select("a", "m"), "a"))


def _stars(edges: DataFrame) -> bool:
    """Whether every larger node has one edge, to a node that is no larger one: then that is its component's smallest."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")) \
        .unionAll(edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return nodes.where((F.col("up") > 0) & (F.col("n") > 1)).coalesce(narrow_parts(edges.sparkSession)).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): the smallest node of each node's component.

    Large-star points every larger neighbour of a node at the node's minimum,
    small-star every smaller one, until the edges are stars, which neither changes; the number of rounds is
    logarithmic in the longest path and not limited.  Minima are pre-aggregated, and hot nodes
    are joined without a shuffle (``_least``).  Each half round is a written table, so a lost executor costs that only;
    edges are short rows, so the tables are narrow: the driver keeps something for each task and file of every round.
    Nulls, self edges and repeated edges are ignored; without edges there are no rows.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "edges", narrow=True)
    while not _stars(now):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = written(_least(both, 2 * now.count()).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct(),
                        "edges", narrow=True)
        small = _least(large, large.count()).select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*") \
            .where("a <> b").distinct()
        now = written(small, "edges", narrow=True)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
