"""Running values over one global order, without sending all rows to one task.

Rows are bucketed by an integer order column. Buckets are summed (pre-aggregated), the short table of buckets gets the
running value, and windows run within buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 4096


def _bucket(order: str, width: int) -> Column:
    return F.floor(F.col(order) / width)


def running_sum(df: DataFrame, order: str, value: Column, out: str, width: int = WIDTH) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to and including this one; ``order`` is an integer, without ties."""
    rows = df.withColumn("_v", value).withColumn("_b", _bucket(order, width))
    sums = rows.groupBy("_b").agg(F.sum("_v").alias("_s"))
    base = sums.select(F.col("_b").alias("_bb"), F.coalesce(F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = F.sum("_v").over(Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(base, F.col("_b") == F.col("_bb")).withColumn(out, F.col("_base") + F.coalesce(inside, F.lit(0))).drop("_v", "_b", "_bb", "_base")


def running_max(df: DataFrame, order: str, value: Column, out: str, width: int = WIDTH) -> DataFrame:
    """``df`` with the largest ``value`` of all rows up to and including this one, null before the first; order as above."""
    rows = df.withColumn("_v", value).withColumn("_b", _bucket(order, width))
    most = rows.groupBy("_b").agg(F.max("_v").alias("_m"))
    base = most.select(F.col("_b").alias("_bb"), F.max("_m").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_base"))
    inside = F.max("_v").over(Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(base, F.col("_b") == F.col("_bb")).withColumn(out, F.greatest("_base", inside)).drop("_v", "_b", "_bb", "_base")


def _scanned(rows: DataFrame, at: str, sums: list[str], marks: dict[str, str], width: int, levels: int) -> DataFrame:
    """``rows`` with _s_<sum>, its total up to and including this row, and _m_<mark>, its last mark before this row.

    _v_<sum> is what a row adds, _o_<mark> how far into the row its last mark is, null without one.
    """
    order = Window.orderBy(at) if not levels else Window.partitionBy("_b").orderBy(at)
    if levels:
        rows = rows.withColumn("_b", _bucket(at, width))
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"_s_{n}": F.sum(f"_v_{n}").over(upto) for n in sums})
    place = {m: F.col(f"_s_{n}") - F.col(f"_v_{n}") + F.col(f"_o_{m}") for m, n in marks.items()}
    rows = rows.withColumns({f"_m_{m}": F.last(p, ignorenulls=True).over(before) for m, p in place.items()})
    if not levels:
        return rows
    held = [F.sum(f"_v_{n}").alias(f"_v_{n}") for n in sums] + [F.max_by(p, F.when(p.isNotNull(), F.col(at))).alias(f"_o_{m}") for m, p in place.items()]
    key = f"_at{levels}"
    table = _scanned(rows.groupBy(F.col("_b").alias(key)).agg(*held), key, sums, marks, width, levels - 1)
    table = table.select(key, *((F.col(f"_s_{n}") - F.col(f"_v_{n}")).alias(f"_base_{n}") for n in sums), *(F.col(f"_m_{m}").alias(f"_carry_{m}") for m in marks))
    met = rows.join(table, F.col("_b") == F.col(key))
    met = met.withColumns({f"_m_{m}": F.coalesce(F.col(f"_base_{n}") + F.col(f"_m_{m}"), F.col(f"_carry_{m}")) for m, n in marks.items()})
    met = met.withColumns({f"_s_{n}": F.col(f"_base_{n}") + F.col(f"_s_{n}") for n in sums})
    return met.drop("_b", key, *(f"_base_{n}" for n in sums), *(f"_carry_{m}" for m in marks))


def scan(df: DataFrame, order: str, sums: dict[str, Column], marks: dict[str, tuple[str, Column]] | None = None, width: int = WIDTH) -> DataFrame:
    """``df`` with several running values in one pass over the order (an integer, without ties).

    ``sums``: the sum of a value over all rows up to and including this one. ``marks``: a name and a condition; what the sum
    of that name was at the last row before this one for which the condition held, null if there was none. Both carry over
    buckets as one associative pair (total, last mark), and over buckets of buckets, so only one row for ``width`` squared
    rows meets in one place. Nulls add nothing.
    """
    marks = marks or {}
    rows = df.withColumns({f"_v_{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()})
    rows = rows.withColumns({f"_o_{m}": F.when(c, F.col(f"_v_{n}")) for m, (n, c) in marks.items()})
    done = _scanned(rows, order, list(sums), {m: n for m, (n, _) in marks.items()}, width, 2)
    named = [F.col(f"_s_{n}").alias(n) for n in sums] + [F.col(f"_m_{m}").alias(m) for m in marks]
    return done.select(*(F.col(c) for c in df.columns), *named)


def ranked(df: DataFrame, order: str, out: str, width: int = WIDTH) -> DataFrame:
    """``df`` with the number of rows up to and including this one, from 1; order as above."""
    return running_sum(df, order, F.lit(1), out, width)


def ranked_by(df: DataFrame, key: str, order: str, out: str, width: int = WIDTH) -> DataFrame:
    """``df`` with the place of each row, from 1, among the rows of its key; order as above. No key's rows meet in one task."""
    rows = df.withColumn("_b", _bucket(order, width))
    counts = rows.groupBy(key, "_b").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.select(F.col(key).alias("_k"), F.col("_b").alias("_bb"), before.alias("_base"))
    inside = F.row_number().over(Window.partitionBy(key, "_b").orderBy(order))
    return rows.join(base, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_bb"))).withColumn(out, F.col("_base") + inside).drop("_b", "_bb", "_k", "_base")


def lookback(df: DataFrame, key: str, order: Sequence[str], values: dict[str, Column], bucket: Column) -> DataFrame:
    """``df`` with, for each of ``values``, the last one that isn't null among the earlier rows of the key.

    ``bucket`` rises with ``order`` and cuts a key's rows, so those of a hot key don't meet in one task.
    """
    rows = df.withColumns({f"_v_{n}": c for n, c in values.items()}).withColumn("_b", bucket)
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    own = {f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(before(key, "_b").orderBy(*order)) for n in values}
    lasts = rows.groupBy(key, "_b").agg(*(F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.struct(*order))).alias(f"_c_{n}") for n in values))
    carried = [F.last(f"_c_{n}", ignorenulls=True).over(before(key).orderBy("_b")).alias(f"_c_{n}") for n in values]
    table = lasts.select(F.col(key).alias("_k"), F.col("_b").alias("_bb"), *carried)
    met = rows.withColumns(own).join(table, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_b") == F.col("_bb")))
    return met.select(*(F.col(c) for c in df.columns), *(F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in values))


def previous(df: DataFrame, order: str, value: str, out: str, width: int = WIDTH) -> DataFrame:
    """``df`` with ``value`` of the row before in the order of ``order`` (an integer, without ties), null for the first."""
    rows = df.withColumn("_b", _bucket(order, width))
    lasts = rows.groupBy("_b").agg(F.max_by(value, order).alias("_last"))
    before = lasts.select(F.col("_b").alias("_bb"), F.lag("_last").over(Window.orderBy("_b")).alias("_before"))
    own = F.lag(value).over(Window.partitionBy("_b").orderBy(order))
    first = F.row_number().over(Window.partitionBy("_b").orderBy(order)) == 1
    return rows.join(before, F.col("_b") == F.col("_bb")).withColumn(out, F.when(first, F.col("_before")).otherwise(own)).drop("_b", "_bb", "_before")


def latest(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the highest version of each key, by a pre-aggregated maximum (no sort)."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(version)).alias("_r")).select(key, *(F.col(f"_r.{c}").alias(c) for c in others))
