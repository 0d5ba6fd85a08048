"""Vector arithmetic on array columns, in double precision and inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null when a norm is zero or not finite."""
    length = norm(a) * norm(b)
    return F.when((length > 0) & (length < F.lit(float("inf"))), dot(a, b) / length)


def unit(a: Column) -> Column:
    """At length 1; an error for zero or infinite vectors."""
    n = norm(a)
    return F.when((n > 0) & (n < F.lit(float("inf"))), F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.raise_error(F.lit("vector has no finite positive norm")).cast("array<double>"))


def rounded(x: Column, digits: int) -> Column:
    """Rounded as C and SQL engines do: the double times a power of ten, half away from zero, sign of zero kept.

    Spark's round() takes the shortest decimal that stands for the double, which may be a tie where the product is none.
    """
    scale = F.lit(10.0**digits)
    near = F.round(F.abs(x) * scale, 0) / scale
    return F.when(x < 0, -near).when(x == 0, x).otherwise(near)


def is_valid_score(c: Column, bound: float) -> Column:
    """A finite number within the bound. NaN is tested first: Spark orders it above all numbers."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= bound)
