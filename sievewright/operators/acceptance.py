"""Acceptance: unique verified artifacts in commit order, up to a shared quota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.operators.ordered import ranked


def not_in_sources(candidates: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    return candidates.join(sources.select(key).distinct(), key, "left_anti")


def first_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key: a pre-aggregated minimum, so a key with most of the rows costs one row a task."""
    others = [c for c in df.columns if c not in (key, order)]
    least = F.min_by(F.struct(F.lit(0).alias("_"), *others), F.col(order))
    return df.groupBy(key).agg(F.min(order).alias(order), least.alias("_r")).select(key, order, *(F.col(f"_r.{c}").alias(c) for c in others))


def first_n(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first n rows by an integer without ties, with their rank. Ranks come from buckets, so n may be large."""
    return ranked(df, order, "rank").where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("int"))


def accepted(candidates: DataFrame, sources: DataFrame, quota: int, key: str = "hash", order: str = "sequence") -> DataFrame:
    """Passed candidates whose key is neither a source's nor that of an earlier accepted one, the first ``quota``.

    Only accepted artifacts enter the seen set, so rejected rows are dropped before the first of each key is taken.
    """
    passed = candidates.where("passed").drop("passed")
    return first_n(first_by_key(not_in_sources(passed, sources, key), key, order), quota, order)


def outcome() -> Column:
    """The outcome of a completion, in order of precedence, from columns failed, passed, seen, full."""
    return F.when(F.col("failed"), "error").when(~F.col("passed"), "rejected").when(F.col("seen"), "duplicate").when(F.col("full"), "interrupted").otherwise("accepted")


def batch_size(lanes: int, quota: int, accepted_count: int) -> int:
    """How many candidates may be in flight: never more than could still be accepted."""
    return max(0, min(lanes, quota - accepted_count))


def open_slots(lanes: Column, quota: Column, accepted_count: Column, in_flight: Column) -> Column:
    """How many more candidates may start: free lanes, and never more than could still be accepted."""
    return F.greatest(F.lit(0), F.least(lanes - in_flight, quota - accepted_count - in_flight))


def round_robin(attempts: DataFrame, sources: DataFrame, sequence: str, next_source: int = 0) -> DataFrame:
    """The source of each attempt: sources take turns in their order. ``sources``: pos (0..n-1) and source_id."""
    n = sources.count()
    turn = F.pmod(F.col(sequence) + F.lit(next_source), F.lit(max(n, 1)))
    return attempts.withColumn("pos", turn.cast("long")).join(sources.withColumn("pos", F.col("pos").cast("long")), "pos")
