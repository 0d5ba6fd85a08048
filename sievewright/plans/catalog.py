"""The registered queries: each applies operators to the driver's tables, with the same thing said in SQL.

``QUERIES`` maps names to functions of (spark, sf_dir); ``SQL`` to text for the same tables where SQL can say it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str):
    """Seconds in whole hundredths, so that sums are exact."""
    return F.round(F.col(column) * 100).cast("long")


def load_all() -> None:
    """Import the modules that register queries."""
    from sievewright.plans import artifacts, checks, curation, geometry, ledgers, tables, upkeep  # noqa: F401
