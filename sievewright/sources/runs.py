"""Discovery of runs below a folder, and work on each of them under its lock."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators.lifecycle import writer_lock

#: The files of a run, versions, and the states in which nobody writes.
FILES = ("config.json", "manifest.json", "sources.json", "state.json")
VERSIONS, IDLE = ("1.1", "2.0"), ("completed", "failed", "interrupted")


def discover(spark: SparkSession, root: str, backends: tuple[str, ...]) -> DataFrame:
    """(run, status) of all folders that are runs; status is ready or active.

    A run has the four files, a known version and backend, and a name that its manifest tells. Others are left out.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f"{root.rstrip('/')}/*/")
    parts = F.split("path", "/")
    rows = files.select(F.element_at(parts, -2).alias("run"), F.element_at(parts, -1).alias("name"), F.decode("content", "UTF-8").alias("text")).where(F.col("name").isin(*FILES))
    text = lambda name: F.max(F.when(F.col("name") == name, F.col("text")))
    runs = rows.groupBy("run").agg(F.count_distinct("name").alias("n"), text("manifest.json").alias("manifest"), text("state.json").alias("state")).where(F.col("n") == len(FILES))
    told = lambda key: F.get_json_object("manifest", f"$.{key}")
    known = told("schema_version").isin(*VERSIONS) & told("backend").isin(*backends) & (told("run_id") == F.col("run"))
    status = F.when(F.get_json_object("state", "$.status").isin(*IDLE), "ready").otherwise("active")
    return runs.where(known).select("run", status.alias("status"))


def each_run(spark: SparkSession, root: str | Path, backends: tuple[str, ...], work: Callable[[Path], object], exclude: str | None = None) -> dict[str, object]:
    """What ``work`` gives for each ready run, in order of name, under the run's lock; others are told as skipped.

    Cleanup and migration over runs are this with their own work. A run is one folder of files, so runs are a short list.
    """
    out: dict[str, object] = {}
    for row in discover(spark, f"file://{Path(root).resolve()}", backends).orderBy("run").collect():
        folder = Path(root) / row["run"]
        if row["run"] == exclude or folder.is_symlink():
            continue
        if row["status"] == "active":
            out[row["run"]] = "skipped_active"
            continue
        try:
            with writer_lock(folder / ".lock"):
                out[row["run"]] = work(folder)
        except BlockingIOError:
            out[row["run"]] = "skipped_active"
    return out
