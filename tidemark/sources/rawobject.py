"""One JSON object of records, ``{"<key>": {...}, ...}``, read by several tasks.

The file is scanned as text cut at every ``}``, which Spark splits into blocks like any other text.  A cut ends a
record of the object only where it lies outside strings and closes the second level of braces.  Whether it does
depends on all text before it, so each block counts its quotes and braces twice, for either case of beginning inside
a string or not; a small frame (one row for each block) adds the blocks of a file up in their order and says which
case holds.  Records are then numbered by the cuts before them, put together from their pieces, and parsed one by one.

The text is read once for the states, once for the numbers and once for the records, and shuffled whole by block and by record.
Groups are bounded: a block by ``spark.sql.files.maxPartitionBytes``, a record by its own text.  Offsets are joined by
(file, block), which Spark broadcasts only while they are small.

Defined cases: records may stand in any layout, with braces, quotes and escapes in their strings and objects inside
them; an object without records gives no rows; a record that is no object (a number, null) has the position of the next
object; a key that repeats keeps its first position and its last value, over several files in the order of their paths;
compressed files are read by one task each, as their codec says; a file that ends inside the object, or is no object,
is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLOCK = ["file", "block"]


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, block, seq, text) of every piece between two closing braces; ``seq`` rises inside a block."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("text"))


def _braces(parts: Column, inside: int) -> Column:
    """Opening braces of the parts between quotes that lie outside strings, if the piece begins inside one or not."""
    plain = F.array_join(F.filter(parts, lambda _, i: i % 2 == inside), "")
    return F.length(plain) - F.length(F.replace(plain, F.lit("{"), F.lit("")))


def scanned(read: DataFrame) -> DataFrame:
    """Pieces with what they and the pieces before them in the block add, for a block that begins outside (0) or inside (1) a string.

    ``s``: in a string after the piece; ``d``: depth after it and its brace, from the block's beginning; ``e``: records ended.
    """
    # an escape is two characters and never a cut: without them a quote begins or ends a string
    parts = F.split(F.regexp_replace("text", r"\\.", ""), '"')
    flips = read.withColumns({"parts": parts}).withColumns({
        "flip": (F.size("parts") - 1) % 2, "o0": _braces(F.col("parts"), 0), "o1": _braces(F.col("parts"), 1)}).drop("parts")
    order = Window.partitionBy(*_BLOCK).orderBy("seq")
    out = flips.withColumn("odd", F.sum("flip").over(order) % 2)
    for case in (0, 1):
        after = (F.col("odd") + case) % 2
        before = (after + F.col("flip")) % 2
        change = F.when(before == 0, F.col("o0")).otherwise(F.col("o1")) - F.when(after == 0, 1).otherwise(0)
        out = out.withColumn(f"s{case}", after).withColumn(f"c{case}", change)
    return out.withColumns({f"d{case}": F.sum(f"c{case}").over(order) for case in (0, 1)})


def block_starts(read: DataFrame) -> DataFrame:
    """(file, block, inside, depth, whole): the state each block begins with, and whether its file is a whole object."""
    ends = read.groupBy(*_BLOCK).agg(
        F.max("size").alias("size"), F.sum(F.octet_length("text") + 1).alias("bytes"),
        (F.sum("flip") % 2).alias("odd"), F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    out = ends.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), zero) % 2)
    out = out.withColumn("c", F.when(F.col("inside") == 0, F.col("c0")).otherwise(F.col("c1")))
    out = out.withColumn("depth", F.coalesce(F.sum("c").over(earlier), zero))
    everything = Window.partitionBy("file")
    # text after the last brace was counted with a brace that is not there: seen by the bytes, unless the file is compressed
    total, size, level = F.sum("bytes").over(everything), F.col("size"), F.sum("c").over(everything)
    closed = F.when(total == size, level == 0).when(total == size + 1, level == -1).otherwise(level.isin(0, -1))
    return out.select(*_BLOCK, "inside", "depth", (closed & (F.sum("odd").over(everything) % 2 == 0)).alias("whole"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, text): the members of the object in their order, as JSON text without the braces of the object."""
    read = scanned(pieces(spark, path))
    inside = F.col("inside") == 1
    here = read.join(block_starts(read), _BLOCK).select(
        *_BLOCK, "seq", "text", "whole", (F.when(inside, F.col("s1")).otherwise(F.col("s0")) == 0).alias("outside"),
        (F.col("depth") + F.when(inside, F.col("d1")).otherwise(F.col("d0"))).alias("level"))
    broken = F.raise_error(F.concat(F.lit("not a whole JSON object: "), F.col("file"))).cast("boolean")
    here = here.withColumn("ends", F.when(F.col("whole"), F.col("outside") & (F.col("level") <= 1)).otherwise(broken))
    zero = F.lit(0).cast("long")
    blocks = here.groupBy(*_BLOCK).agg(F.count_if("ends").alias("ended"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*_BLOCK, F.coalesce(F.sum("ended").over(earlier), zero).alias("base"))
    before = Window.partitionBy(*_BLOCK).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(F.col("ends").cast("long")).over(before), zero)
    numbered = here.withColumn("own", own).join(blocks, _BLOCK).withColumn("number", F.col("own") + F.col("base"))
    put = numbered.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "text", "level"))).alias("p"))
    # the cut took a record's last brace; the brace that closes the object itself belongs to no record
    last = F.when(F.element_at("p", -1)["level"] == 1, "}").otherwise("")
    text = F.regexp_replace(F.concat(F.array_join(F.transform("p", lambda x: x["text"]), "}"), last), r"^\s*[{,]", "")
    return put.select("file", "number", text.alias("text")).filter(~F.col("text").rlike(r"^\s*$"))


def members(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(pos, key, v) of every key; ``value`` is the type of a record, whose fields are null if it is no object."""
    parsed = F.from_json(F.concat(F.lit("{"), F.col("text"), F.lit("}")), "map<string,string>", {"mode": "FAILFAST"})
    each = records(spark, path).select("file", "number", F.posexplode(F.map_entries(parsed)).alias("j", "e"))
    return each.groupBy(F.col("e.key").alias("key")).agg(
        F.min("number").alias("pos"), F.max_by("e.value", F.struct("file", "number", "j")).alias("raw")) \
        .select("pos", "key", F.from_json("raw", value).alias("v"))
