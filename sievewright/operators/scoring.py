"""Caption scores, pairs, and the fixed acceptance policy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.vectors import cosine, is_valid_score

#: Fixed values of the policy: physical pairs 1 to 4 of which three must pass, accident pair 5, bounds on scores.
PHYSICAL, PHYSICAL_LEAST, ACCIDENT = 4, 3, 5
SCORE_BOUND, SELECTOR_BOUND = 1.00001, 1.0


def caption_pairs(features: DataFrame, captions: DataFrame, key: str) -> DataFrame:
    """One row a feature and pair: id, undesired, preferred, margin, passed (strictly positive margin).

    ``features``: key and feature; ``captions``: id, undesired_v, preferred_v, five rows of fixed criteria, so the
    product with them is linear in the features.
    """
    rows = features.join(F.broadcast(captions))
    rows = rows.withColumn("undesired", cosine(F.col("feature"), F.col("undesired_v"))).withColumn("preferred", cosine(F.col("feature"), F.col("preferred_v")))
    margin = F.col("preferred") - F.col("undesired")
    return rows.select(key, "id", "undesired", "preferred", margin.alias("margin"), (margin > 0).alias("passed"))


def decisions(pairs: DataFrame, key: str) -> DataFrame:
    """One row a key: physical_pass_count, accident_passed, passed."""
    counted = pairs.groupBy(key).agg(
        F.count_if((F.col("id") <= PHYSICAL) & F.col("passed")).alias("physical_pass_count"),
        F.bool_or((F.col("id") == ACCIDENT) & F.col("passed")).alias("accident_passed"),
    )
    return counted.withColumn("passed", verdict(F.col("physical_pass_count"), F.col("accident_passed")))


def verdict(physical: Column, accident: Column) -> Column:
    return (physical >= PHYSICAL_LEAST) & accident


def score_error(scores: Column, count: int, bound: float) -> Column:
    """Why an array of scores is invalid; null if it is valid."""
    return (
        F.when(scores.isNull() | (F.size(scores) != count), "count")
        .when(F.exists(scores, lambda s: s.isNull() | F.isnan(s) | (F.abs(s) == float("inf"))), "not_finite")
        .when(F.exists(scores, lambda s: ~is_valid_score(s, bound)), "out_of_bounds")
    )


def tampered(stored: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """Stored decisions that scores don't give again."""
    again = decisions(pairs, key).select(F.col(key).alias("_k"), F.col("passed").alias("_p"), F.col("physical_pass_count").alias("_n"))
    same = F.col("passed").eqNullSafe(F.col("_p")) & F.col("physical_pass_count").eqNullSafe(F.col("_n"))
    return stored.join(again, F.col(key) == F.col("_k"), "left").where(~same).drop("_k", "_p", "_n")


class Scorer:
    """Plug for a model: scores batches of a candidate table on the executors.

    ``score`` gets a pandas frame and returns one with the columns of ``schema``. Results of earlier runs are left out
    by an anti join on the key before scoring, so nothing is scored twice.
    """

    def __init__(self, score: Callable[[pd.DataFrame], pd.DataFrame], schema: str, key: str) -> None:
        self.score, self.schema, self.key = score, schema, key

    def __call__(self, candidates: DataFrame, cached: DataFrame | None = None) -> DataFrame:
        fresh = candidates if cached is None else candidates.join(cached.select(self.key), self.key, "left_anti")
        score = self.score

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from map(score, batches)

        out = fresh.mapInPandas(run, self.schema)
        return out if cached is None else out.unionByName(cached)
