"""Reports over the ledger, exports of accepted artifacts, gallery layout."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions.identity import digest

EXPORT_SCHEMA, LEGACY_SCHEMA = "2.0", "1.1"


def outcome_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("outcome").agg(F.count("*").alias("n"))


def per_source(sources: DataFrame, ledger: DataFrame) -> DataFrame:
    """Attempts and accepted of every source, zero for those without attempts. The ledger is summed before the join."""
    sums = ledger.groupBy("source_id").agg(F.count("*").alias("attempts"), F.count_if(F.col("outcome") == "accepted").alias("accepted"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return sources.join(sums, "source_id", "left").select("source_id", zero("attempts"), zero("accepted"))


def unknown_sources(sources: DataFrame, ledger: DataFrame) -> DataFrame:
    """(source_id, n): entries of sources that the run doesn't have."""
    return ledger.join(sources.select("source_id").distinct(), "source_id", "left_anti").groupBy("source_id").agg(F.count("*").alias("n"))


def mean_cost(ledger: DataFrame, seconds: str) -> DataFrame:
    """One row: attempts, accepted, mean seconds for each accepted; null when there is none."""
    sums = ledger.agg(F.count("*").alias("attempts"), F.count_if(F.col("outcome") == "accepted").alias("accepted"), F.sum(seconds).alias("seconds"))
    return sums.select("attempts", "accepted", F.try_divide("seconds", "accepted").alias("mean_seconds"))


def stage_seconds(stages: DataFrame, key: str, names: list) -> DataFrame:
    """Seconds by stage as columns, repeated stages (retries) added up."""
    return stages.groupBy(key).pivot("stage", names).agg(F.sum("seconds"))


def is_exportable() -> Column:
    """Eligible, and complete as far as the record's schema knows of completeness."""
    return (F.col("export_status") == "eligible") & ((F.col("schema_version") != EXPORT_SCHEMA) | F.coalesce("presentation_complete", F.lit(False)))


def split_export(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current, legacy) rows for two sinks."""
    legacy = F.col("schema_version") == LEGACY_SCHEMA
    return rows.where(~legacy), rows.where(legacy)


def gallery(rows: DataFrame, *order: str) -> DataFrame:
    """index (from 1), columns, row and col of every tile in the order given.

    Counts by the first column of the order give each of its values a base; only rows of one value are ranked together.
    """
    first, rest = order[0], order[1:] or order
    counts = rows.groupBy(F.col(first).alias("_k")).agg(F.count("*").alias("_n"))
    base = F.coalesce(F.sum("_n").over(Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_k", base.alias("_base"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    n = F.col("_all")
    tiles = rows.join(counts, F.col(first).eqNullSafe(F.col("_k"))).withColumn("index", (F.col("_base") + F.row_number().over(Window.partitionBy(first).orderBy(*rest))).cast("int"))
    tiles = tiles.withColumn("columns", F.ceil(F.sqrt(F.when(n <= 16, n.cast("double")).otherwise(n * F.lit(0.65))))).drop("_k", "_base", "_all")
    at = F.col("index") - 1
    return tiles.withColumn("row", F.floor(at / F.col("columns"))).withColumn("col", at % F.col("columns"))


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_small_json(value: object, path: str | Path) -> bool:
    """A small document on the driver, replaced in one step and only if its digest changed; True if written."""
    target = Path(path)
    if target.exists() and digest(json.loads(target.read_text())) == digest(value):
        return False
    partial = target.with_name(f".{target.name}.partial")
    with partial.open("w") as f:
        json.dump(value, f, sort_keys=True, ensure_ascii=False, allow_nan=False, indent=1)
        f.flush()
        os.fsync(f.fileno())
    os.replace(partial, target)
    folder = os.open(target.parent, os.O_RDONLY)
    try:
        os.fsync(folder)  # the new name lasts, too
    finally:
        os.close(folder)
    return True


def markdown(title: str, rows: DataFrame) -> str:
    """A Markdown table of a report, row by row; the driver holds one partition's rows at a time."""
    cell = lambda v: "" if v is None else str(v).replace("\\", "\\\\").replace("|", "\\|").replace("\n", " ")
    out = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "| " + " | ".join("---" for _ in rows.columns) + " |"]
    for r in rows.toLocalIterator():
        out.append("| " + " | ".join(map(cell, r)) + " |")
    return "\n".join(out) + "\n"
