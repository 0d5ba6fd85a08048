"""Verified export: accepted records are decided again, hashed again and compared before they leave a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.operators import scoring
from sievewright.operators.acceptance import first_by_key
from sievewright.operators.ingest import ELIGIBLE, ConstraintError, require_empty
from sievewright.operators.reporting import EXPORT_SCHEMA, LEGACY_SCHEMA, is_exportable


def export_errors(records: DataFrame, sources: DataFrame, files: DataFrame, pairs: DataFrame, backend: str, criteria: str, legacy: bool = False) -> DataFrame:
    """``records`` with error: why a record may not be exported, by the first check that fails; null if it may.

    ``records``: candidate_id, sequence, source_id, backend, image_path, pixel_sha256, file_sha256, criteria_sha256.
    ``sources``: source_id, split, pixel_sha256. ``files``: image_path and the hashes of what is stored now.
    ``pairs``: caption pairs by candidate_id, from which decisions are made again. A record repeats another's pixels if
    that one comes before it by sequence; the first of each is a pre-aggregated minimum.
    """
    named = sources.select("source_id", F.col("split").alias("_split"))
    known = sources.select(F.col("pixel_sha256").alias("_pixels")).distinct().withColumn("_source", F.lit(True))
    now = files.select("image_path", F.col("pixel_sha256").alias("_pixel_now"), F.col("file_sha256").alias("_file_now"))
    decided = scoring.decisions(pairs, "candidate_id").select("candidate_id", F.col("passed").alias("_passed"))
    firsts = first_by_key(records.select("pixel_sha256", "sequence"), "pixel_sha256", "sequence").select(F.col("pixel_sha256").alias("_pixels"), F.col("sequence").alias("_first"))
    rows = records.join(named, "source_id", "left").join(now, "image_path", "left").join(decided, "candidate_id", "left")
    rows = rows.join(known, F.col("pixel_sha256") == F.col("_pixels"), "left").drop("_pixels").join(firsts, F.col("pixel_sha256") == F.col("_pixels"), "left")
    same = F.col("pixel_sha256").eqNullSafe(F.col("_pixel_now")) & F.col("file_sha256").eqNullSafe(F.col("_file_now")) & F.col("pixel_sha256").isNotNull()
    error = F.when(~F.col("backend").eqNullSafe(F.lit(backend)), "backend").when(~F.coalesce(F.col("_split").isin(*ELIGIBLE), F.lit(False)), "split")
    if not legacy:
        error = error.when(~F.coalesce("_passed", F.lit(False)), "decision").when(~F.col("criteria_sha256").eqNullSafe(F.lit(criteria)), "criteria")
    error = error.when(~same, "hash").when(F.col("_source"), "source").when(F.col("_first") < F.col("sequence"), "repeated")
    return rows.withColumn("error", error).select(*records.columns, "error")


def verified_export(records: DataFrame, sources: DataFrame, files: DataFrame, pairs: DataFrame, run: dict, trusted: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(current, legacy) rows of a run's accepted records, all of which must hold; an error names the first that don't.

    ``run``: schema_version, backend, criteria_sha256. Only ``trusted`` backends are exported, so no made-up one is.
    """
    if run["backend"] not in trusted:
        raise ConstraintError(f"export of backend {run['backend']!r} is refused")
    legacy = run["schema_version"] == LEGACY_SCHEMA
    if not legacy and run["schema_version"] != EXPORT_SCHEMA:
        raise ConstraintError(f"unknown schema version {run['schema_version']!r}")
    accepted = records.where(is_exportable())
    checked = export_errors(accepted, sources, files, pairs, run["backend"], run["criteria_sha256"], legacy)
    require_empty(checked.where("error is not null").select("candidate_id", "error"), "records fail verification")
    kept = sources.select("source_id", *(c for c in ("image_path", "split", "group_id", "domain") if c in sources.columns)).withColumnRenamed("image_path", "source_image_path")
    status = F.lit("legacy_unverified" if legacy else "clip_verified")
    rows = accepted.join(kept, "source_id").withColumn("verification_status", status).withColumn("record_path", F.concat(F.lit("records/"), "candidate_id", F.lit(".json"))).withColumn("label", F.lit(None).cast("string")).withColumn("task", F.lit("image_only"))
    nothing = rows.limit(0)
    return (nothing, rows) if legacy else (rows, nothing)
