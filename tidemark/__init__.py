"""tidemark: a run-based analytics warehouse built on Spark DataFrames.

Layout
------
functions/  column expressions (parsing, date parts, safe ratio)
operators/  DataFrame -> DataFrame building blocks (dims, facts, pages,
            rolling counts, ranking, checks)
plans/      the marts (views) and dashboard reports composed from operators
sources/    landing-zone readers, warehouse store, driver-table adapter
streaming/  availableNow wrapper around the batch ingest
jobs.py     initial / incremental load jobs
"""

from tidemark.session import build_session  # noqa: F401
from tidemark.warehouse import Warehouse  # noqa: F401
