"""Joins whose keys may be frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one row in so many is frequent.
FREQUENT = 4096


#: Rows of a task that sorts or collects whole groups of small rows.
TASK_ROWS = 125_000


def tasks(rows: DataFrame, each: int = TASK_ROWS) -> int:
    """How many tasks the number of rows asks for. They are counted, so they should be a table's."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // each))


def dealt(rows: DataFrame, *keys: str, each: int = TASK_ROWS) -> DataFrame:
    """``rows`` dealt by their keys to :func:`tasks`, so that a task's memory doesn't grow with the input.

    Windows and groups by these keys and more need no other shuffle.
    """
    return rows.repartition(tasks(rows, each), *keys)


def frequent(rows: DataFrame, key: str, total: int) -> DataFrame:
    """The keys with more than a ``FREQUENT``-th of ``total`` rows: fewer than ``FREQUENT``, whatever the data."""
    return rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") * FREQUENT > F.lit(total)).select(key)


def spread(rows: DataFrame, table: DataFrame, key: str, often: DataFrame) -> DataFrame:
    """``rows`` left-joined with ``table``, which has one row a key; rows of the keys in ``often`` (:func:`frequent`) stay where
    they are, as their side of ``table`` is broadcast, and only others are shuffled."""
    few = table.join(F.broadcast(often), key, "left_semi")
    marked = rows.join(F.broadcast(often.withColumn("_often", F.lit(True))), key, "left")
    near = marked.where("_often").drop("_often").join(F.broadcast(few), key, "left")
    return near.unionByName(marked.where("_often is null").drop("_often").join(table, key, "left"))
