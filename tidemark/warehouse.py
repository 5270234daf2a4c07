"""The warehouse as a bundle of seven DataFrames.

Marts take a ``Warehouse`` and return a DataFrame; where the frames come from
(a stored snapshot, the driver-table adapter, a literal fixture) is the
caller's business.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas


@dataclass(frozen=True)
class Warehouse:
    dim_timestamp: DataFrame
    dim_etl_run: DataFrame
    dim_app: DataFrame
    dim_update_typ: DataFrame
    dim_update_content: DataFrame
    fact_news: DataFrame
    fact_steamspy_stats: DataFrame
    # True when every timestamp id is the epoch microsecond of its timestamp and
    # each load writes the timestamp rows with its facts (stores built by the
    # jobs, the driver adapter).  Marts then read ``ts`` off the id instead of
    # joining the (large) timestamp dimension; the orphan check (K3) verifies
    # the invariant.
    micros_ids: bool = False

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name in schemas.TABLES}

    def with_tables(self, **frames: DataFrame) -> "Warehouse":
        return replace(self, **frames)

    def register(self, prefix: str = "") -> None:
        """Expose every table as a temp view (``SELECT * FROM dim_app`` …)."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)

    def has_micros_ids(self) -> bool:
        """Whether every timestamp id is the epoch microsecond of its timestamp (one pass over that table)."""
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
        return self.dim_timestamp.filter(~micros.eqNullSafe(F.col("timestamp_id"))).isEmpty()

    @staticmethod
    def empty(spark: SparkSession) -> "Warehouse":
        """Typed empty tables (the reset state, M9)."""
        return Warehouse(**{name: spark.createDataFrame([], schema)
                            for name, schema in schemas.TABLES.items()})
