"""Session settings that the library's plans rely on."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session; on a cluster, set the same options there and leave master and memory to it.

    Only a local master gets a folder of this machine for checkpoints; elsewhere ``spark.checkpoint.dir`` must name a
    shared one, and operators that need it say so.
    """
    builder = (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master == "local" or master.startswith("local["):
        builder = builder.config("spark.checkpoint.dir", "file:///tmp/checkpoints")
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once, so that they need no path of their own to it."""
    context = spark.sparkContext
    if getattr(context, "_sievewright_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(os.path.realpath(tempfile.mkdtemp())) / "sievewright.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, Path(package.name) / file.relative_to(package))
    context.addPyFile(str(target))
    context._sievewright_shipped = True
