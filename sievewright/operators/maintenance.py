"""Maintenance planning: protected paths, cleanup, path rewriting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ancestors(path: Column) -> Column:
    """A path and every folder above it."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def protected(paths: DataFrame, references: DataFrame) -> DataFrame:
    """Paths that a reference equals or lies below. The prefix test is an equi join on the references' ancestors."""
    named = references.select(F.explode(ancestors(F.col("reference"))).alias("path")).distinct()
    return paths.join(named, "path", "left_semi")


def cleanup_plan(candidates: DataFrame, references: DataFrame) -> DataFrame:
    """Paths that may go: the candidate isn't accepted and nothing accepted refers to the path or below it."""
    named = references.select(F.explode(ancestors(F.col("reference"))).alias("path")).distinct()
    return candidates.where(F.col("outcome") != "accepted").join(named, "path", "left_anti")


def pending_journal(journal: DataFrame) -> DataFrame:
    return journal.where(F.col("state") == "pending")


def relocate(path: Column, old: str, new: str) -> Column:
    """Prefix replaced where the whole folder name matches."""
    return F.when(path == old, F.lit(new)).when(path.startswith(old + "/"), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(path)


def rewrite(rows: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Values replaced by exact match with (old, new), others kept."""
    pairs = mapping.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    return rows.join(pairs, F.col(column) == F.col("_old"), "left").withColumn(column, F.coalesce("_new", column)).drop("_old", "_new")


def rewrite_links(text: Column, old: str, new: str) -> Column:
    """Markdown link targets replaced."""
    return F.replace(text, F.lit(f"]({old})"), F.lit(f"]({new})"))


def legacy_outcome() -> Column:
    """Outcome of an old record from status and export_status."""
    return F.when(F.col("export_status") == "duplicate", "duplicate").when(F.col("status").isin("rejected", "uncertain"), "rejected").otherwise("error")
