"""Ingest guards: constraints as violation tables, keep-first deduplication, leakage between splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.identity import is_safe_id, is_within

#: Fixed domains.
SPLITS, ELIGIBLE, LEAST_SIDE = ("source", "train", "val", "test"), ("source", "train"), 32


class ConstraintError(ValueError):
    """A constraint query returned rows."""


def require_empty(violations: DataFrame, what: str) -> None:
    """Stop if a violation table has rows; at most a few are fetched for the message."""
    if found := violations.limit(3).collect():
        raise ConstraintError(f"{what}: {found}")


def with_defaults(rows: DataFrame) -> DataFrame:
    """split defaults to source; an absent or empty group is the row's own id and marked as inferred."""
    named = F.nullif(F.col("group_id"), F.lit(""))
    return rows.withColumn("group_inferred", named.isNull()).withColumn("group_id", F.coalesce(named, "source_id")).withColumn("split", F.coalesce("split", F.lit("source")))


def repeated_ids(rows: DataFrame, key: str = "source_id") -> DataFrame:
    return rows.groupBy(key).count().where("count > 1")


def unknown_splits(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("split").isin(*SPLITS))


def too_small(rows: DataFrame) -> DataFrame:
    return rows.where(F.least("width", "height") < LEAST_SIDE)


def blank_hints(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("preserve_hint").isNotNull() & (F.trim("preserve_hint") == ""))


def leaks(rows: DataFrame, *keys: Column | str, split: str = "split") -> DataFrame:
    """Keys that occur in more than one split."""
    return rows.groupBy(*keys).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")


def keep_first(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """All rows with kept (the first of its key in scan order) and duplicate_of (the first's name, null if kept).

    The first of each key is a pre-aggregated minimum that is joined back, so no window holds a whole group. Rows without
    a key are one group like any other. Rows that tie on order go by name; rows that tie on both are all kept.
    """
    firsts = rows.groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(F.col(order).alias("o"), F.col(name).alias("n"))).alias("_f"))
    met = rows.join(firsts, F.col(key).eqNullSafe(F.col("_k")))
    kept = F.col(order).eqNullSafe(F.col("_f.o")) & F.col(name).eqNullSafe(F.col("_f.n"))
    return met.select(*rows.columns, kept.alias("kept"), F.when(~kept, F.col("_f.n")).alias("duplicate_of"))


def eligible(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("split").isin(*ELIGIBLE))


def unsafe(rows: DataFrame) -> DataFrame:
    """Rows whose id can't be a file name, or whose image lies outside the dataset."""
    return rows.where(~F.coalesce(is_safe_id(F.col("source_id")) & is_within(F.col("image_path")), F.lit(False)))


def manifest_sources(manifest: DataFrame, images: DataFrame) -> DataFrame:
    """The rows of a manifest with what its images tell (hashes, sizes); ids, paths and missing images stop the ingest."""
    require_empty(unsafe(manifest), "unsafe ids or paths")
    told = images.select("image_path", "file_sha256", "pixel_sha256", "width", "height")
    rows = manifest.join(told, "image_path", "left")
    require_empty(rows.where("pixel_sha256 is null").select("source_id", "image_path"), "images are missing")
    return rows


def ingest(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sources, duplicates): all guards in their order, then the kept rows of eligible splits.

    Hints are checked after deduplication, so those of dropped rows don't count.
    """
    rows = with_defaults(rows)
    require_empty(repeated_ids(rows), "source ids repeat")
    require_empty(unknown_splits(rows), "unknown splits")
    require_empty(leaks(rows, "group_id"), "groups in several splits")
    require_empty(too_small(rows), "images below the least side")
    require_empty(leaks(rows, "pixel_sha256"), "images in several splits")
    marked = keep_first(rows, "pixel_sha256", "ord", "source_id")
    kept = marked.where("kept").drop("kept", "duplicate_of")
    require_empty(blank_hints(kept), "blank hints")
    if eligible(kept).isEmpty():
        raise ConstraintError("no image of an eligible split")
    return eligible(kept), marked.where(~F.col("kept")).select("source_id", "duplicate_of")
