"""Small helpers the operators share: tables, fold flags, written intermediate tables, row keys."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

#: Word classes of the contracts, as Java regular expressions of what separates words.
SPACES = r"[\x20\x09-\x0D]+"
NON_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that clash with none of ``df`` (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id gives null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether the id's fold is ``remainder``; a null id is in no fold."""
    return F.coalesce(fold(doc_id, modulus) == F.lit(remainder), F.lit(False))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null becomes empty.  ``lower`` is that on texts of ASCII only, and faster."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)) \
        .otherwise(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def words(text: Column, separators: str) -> Column:
    """The words between runs of ``separators``; no empty strings, an empty array for null."""
    parts = F.split(F.coalesce(text, F.lit("")), separators)
    return F.array_remove(parts, "")


def small_batches(df: DataFrame, rows: int = 1000, mb: int = 8) -> DataFrame:
    """``df``, its session set to hand Python at most ``rows`` rows or about ``mb`` MB at a time.

    Texts differ in length by orders of magnitude; the default of 10,000 rows a batch
    does not bound a worker's memory.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))
    return df


def numbered(df: DataFrame, group: str | None, order: list[str], out: str, label: str) -> DataFrame:
    """``df`` as a written table with the place (from 0) of each row in its group, in ascending ``order``, nulls first.

    A range partition on group, order and a spread that also splits equal rows, so
    that no group or value becomes one task; each row then numbers itself, and a table
    of one row for each group and partition has where the groups' parts begin.
    """
    spread, seq, part, base = fresh(df, "_spread", "_seq", "_part", "_base")
    keys = [F.col(c).asc_nulls_first() for c in ([group] if group else []) + order]
    rows = df.withColumn(spread, F.monotonically_increasing_id()).repartitionByRange(*keys, F.col(spread)) \
        .sortWithinPartitions(*keys).drop(spread).withColumn(seq, F.monotonically_increasing_id())
    rows = written(rows, label).withColumn(part, F.shiftright(F.col(seq), 33))
    by = [group] if group else []
    parts = rows.groupBy(*by, part).agg(F.count("*").alias("n"), F.min(seq).alias("low"))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select(*by, part, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias(base))
    same = F.col(f"l.{part}") == F.col(f"r.{part}")
    if group:
        same = same & F.col(f"l.`{group}`").eqNullSafe(F.col(f"r.`{group}`"))
    return rows.alias("l").join(begins.alias("r"), same) \
        .select(*[F.col(f"l.`{c}`") for c in df.columns], (F.col(f"l.{seq}") + F.col(f"r.{base}")).alias(out))


_WRITTEN: set[str] = set()


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared checkpoint folder, which ``release`` removes."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    path = f"{root}/{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_release_at_end)
    _WRITTEN.add(path)
    return path


def narrow_parts(spark: SparkSession) -> int:
    """Partitions of tables with short rows: an eighth of the shuffle's, so that files stay few."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def written(df: DataFrame, label: str, narrow: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again: cuts the lineage.

    The executors share that folder, so a lost executor costs no recomputation of
    what was written.  ``narrow`` tables have short rows, the result of a light last
    step: they take an eighth of the shuffle's partitions, so that files stay few.
    ``release`` removes the tables; it also runs when Python ends.
    """
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(narrow_parts(spark))
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove written tables: those that ``frames`` read, or all of them without frames."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    used = {f for x in frames for f in x.inputFiles()}
    for path in sorted(_WRITTEN):
        if not frames or any(path.rsplit("/", 1)[-1] in f for f in used):
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
            _WRITTEN.discard(path)


def _release_at_end() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _WRITTEN:
        try:
            release(spark)
        except Exception:  # noqa: BLE001 - the session may be gone already; the folder is the cluster's scratch space
            _WRITTEN.clear()
