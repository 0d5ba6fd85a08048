"""Sources: image folders, manifests, records and masks. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.functions.identity import folder_source_id
from sievewright.functions.images import pixel_hashes, told
from sievewright.operators.spans import from_mask

#: Image suffixes, schema versions of manifests.
SUFFIXES = ("bmp", "jpeg", "jpg", "png", "tif", "tiff", "webp")
VERSIONS = ("1.1", "2.0")

MANIFEST = "schema_version string, source_id string, image_path string, split string, group_id string, domain string, preserve_hint string, label string"
LEDGER = (
    "candidate_id string, source_id string, attempt_index long, sequence long, outcome string, error_code string, attempt_elapsed_seconds double, "
    "stage_seconds map<string,double>, timing_complete boolean, cleanup_state string, accepted_cost_seconds double, accepted_active_watermark double"
)


def relative_path(root: str) -> Column:
    """The file's path below ``root``, whatever the store's prefix."""
    tail = root.rstrip("/").split("://")[-1].lstrip("/").removeprefix("file:")
    return F.regexp_extract(F.col("path"), f".*?\\Q{tail}\\E/(.*)$", 1)


def image_files(spark: SparkSession, root: str, only: str | None = None) -> DataFrame:
    """path, relative_path, content of all images below a folder. ``only`` reads that file and opens no other."""
    suffix = "\\.(?:" + "|".join(SUFFIXES) + ")$"
    reader = spark.read.format("binaryFile")
    rows = reader.load(f"{root.rstrip('/')}/{only}") if only else reader.option("recursiveFileLookup", "true").load(root)
    return rows.where(F.lower("path").rlike(suffix)).select("path", relative_path(root).alias("relative_path"), "content")


def images(spark: SparkSession, root: str, only: str | None = None) -> DataFrame:
    """Sources of a folder: source_id, image_path, file_sha256, pixel_sha256, width, height, ord (scan order).

    Pixels are hashed as RGB in the orientation that the file tells (EXIF); gray is spread, transparency dropped. Files of
    several frames stop the read. The JVM decodes pixels and Python reads the few bytes that tell orientation and frames,
    so files are read twice; what is joined is hashes, never pixels.
    """
    path = f"{root.rstrip('/')}/{only}" if only else root
    decoded = spark.read.format("image").option("recursiveFileLookup", str(not only).lower()).option("dropInvalid", "false").load(path).select("image.*")
    rows = decoded.where(F.lower("origin").rlike("\\.(?:" + "|".join(SUFFIXES) + ")$")).withColumn("path", F.col("origin"))
    rows = rows.select("path", relative_path(root).alias("image_path"), "width", "height", _hashes()("data", "height", "width", "nChannels").alias("hashes"))
    files = image_files(spark, root, only).select(F.col("relative_path").alias("image_path"), F.sha2("content", 256).alias("file_sha256"), _told()("content").alias("told"))
    met = rows.join(files, "image_path")
    single = F.when(F.col("told.frames") == 1, F.col("told.orientation")).otherwise(F.raise_error(F.concat(F.lit("several frames: "), "image_path")).cast("int"))
    met = met.withColumn("orientation", single)
    turned = F.col("orientation") >= 5
    met = met.select("image_path", "file_sha256", F.element_at("hashes", F.col("orientation")).alias("pixel_sha256"), F.when(turned, F.col("height")).otherwise(F.col("width")).alias("width"), F.when(turned, F.col("width")).otherwise(F.col("height")).alias("height"))
    return in_scan_order(met, "image_path").select(folder_source_id(F.col("image_path")).alias("source_id"), "image_path", "file_sha256", "pixel_sha256", "width", "height", "ord")


def in_scan_order(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ord: the place of their path, from 0. Beginnings of paths are counted; only paths that share one are ranked together."""
    rows = rows.withColumn("_head", F.substring(path, 1, 24))
    counts = rows.groupBy("_head").agg(F.count("*").alias("_n"))
    base = F.coalesce(F.sum("_n").over(Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("_head").alias("_h"), base.alias("_base"))
    place = F.row_number().over(Window.partitionBy("_head").orderBy(path))
    return rows.join(counts, F.col("_head") == F.col("_h")).withColumn("ord", (F.col("_base") + place - 1).cast("int")).drop("_head", "_h", "_base")


@lru_cache(1)
def _hashes():
    @F.pandas_udf("array<string>")
    def run(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.Series:
        return pd.Series([None if d is None or h <= 0 else pixel_hashes(d, h, w, c) for d, h, w, c in zip(data, height, width, channels, strict=True)])

    return run


@lru_cache(1)
def _told():
    @F.pandas_udf("orientation int, frames int")
    def run(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([told(c) for c in content], columns=["orientation", "frames"]).astype("int32")

    return run


def masks(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """(path, error, runs) of the mask files that ``expected`` (path, sha256, width, height) names below ``root``.

    error is the first check that fails: missing, hash, mode (one channel), size, values (0 and 255 only); null if all
    hold. runs: array of (y, x0, x1), null where there is an error.
    """
    decoded = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "false").load(root).select("image.*").withColumn("path", F.col("origin"))
    decoded = decoded.select(relative_path(root).alias("path"), "height", "width", "nChannels", _runs()("data", "height", "width", "nChannels").alias("found"))
    files = image_files(spark, root).select(F.col("relative_path").alias("path"), F.sha2("content", 256).alias("now"))
    want = expected.select("path", "sha256", F.col("width").alias("_w"), F.col("height").alias("_h"))
    rows = want.join(files, "path", "left").join(decoded, "path", "left")
    error = (
        F.when(F.col("now").isNull() | F.col("height").isNull(), "missing")
        .when(F.col("now") != F.col("sha256"), "hash")
        .when(F.col("nChannels") != 1, "mode")
        .when((F.col("width") != F.col("_w")) | (F.col("height") != F.col("_h")), "size")
        .when(~F.col("found.binary"), "values")
    )
    return rows.select("path", error.alias("error"), F.when(error.isNull(), F.col("found.runs")).alias("runs"))


@lru_cache(1)
def _runs():
    @F.pandas_udf("binary boolean, runs array<struct<y:int,x0:int,x1:int>>")
    def run(data: pd.Series, height: pd.Series, width: pd.Series, channels: pd.Series) -> pd.DataFrame:
        out = []
        for d, h, w, c in zip(data, height, width, channels, strict=True):
            if d is None or c != 1 or h <= 0:
                out.append((False, []))
                continue
            mask = np.frombuffer(d, dtype=np.uint8).reshape(h, w)
            out.append((bool(np.isin(mask, (0, 255)).all()), [{"y": y, "x0": a, "x1": b} for y, a, b in from_mask(mask > 0)]))
        return pd.DataFrame(out, columns=["binary", "runs"])

    return run


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSONL manifest; blank lines are skipped, malformed lines and unknown versions stop the read."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    row = F.from_json("value", MANIFEST, {"mode": "FAILFAST"})
    rows = lines.withColumn("ord", F.monotonically_increasing_id()).select(row.alias("r"), "ord").select("r.*", "ord")
    known = F.col("schema_version").isin(*VERSIONS)
    checked = F.when(known, F.col("schema_version")).otherwise(F.raise_error(F.concat(F.lit("unknown schema version: "), F.coalesce("schema_version", F.lit("none")))))
    return rows.withColumn("schema_version", checked)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger entries; keys outside the closed set stop the read."""
    from sievewright.operators.ledger import KEYS

    lines = spark.read.text(path).where(F.trim("value") != "")
    known = F.forall(F.json_object_keys("value"), lambda k: k.isin(*KEYS))
    row = F.when(known, F.from_json("value", LEDGER, {"mode": "FAILFAST"})).otherwise(F.raise_error(F.concat(F.lit("unknown ledger key in "), "value")))
    return lines.select(row.alias("r")).select("r.*").orderBy("sequence")


def records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """One JSON document a file."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(folder)


def gallery_records(rows: DataFrame) -> DataFrame:
    """Accepted and eligible records that are complete as far as their version knows, in gallery order."""
    from sievewright.operators.reporting import is_exportable

    return rows.where((F.col("status") == "accepted") & is_exportable()).orderBy("sequence", "candidate_id")
