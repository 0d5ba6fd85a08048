"""Published tables: versions by manifest, refreshed where their rows changed, upserts with tombstones and compaction, and
migration of paths.

A table is dealt by a hash of its key to buckets, a folder each. A version is a small manifest, one JSON file that names
the folder, number of rows and digest of each bucket; readers see a version whole or not at all. Every change goes the
same way: rows are written to folders of the change's own (``copied``), read back and compared by digest (``verified``), and a
manifest that names them is put in place in one step (``published``). A change has a token. One that a crash stopped is
begun again with its token: what wasn't published is written anew, what was is left alone.

Scale: digests are pre-aggregated sums of row hashes, a row a bucket; a manifest holds as many entries as there are buckets.
Files are reached through Spark's file systems, so a table can be in any store that has an atomic rename.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievewright.operators.ordered import latest

#: Called after each step of a change; tests plant crashes with it.
After = Callable[[str], None]


def _nothing(step: str) -> None:
    pass


class _Files:
    """Small files and folders below a root, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root, self._path = root.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = spark._jvm.org.apache.commons.io.IOUtils

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a file in one step; False if there is one of this name already."""
        temporary = self._at(f"{name}.new")
        stream = self._fs.create(temporary, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        return not self._fs.exists(self._at(name)) and bool(self._fs.rename(temporary, self._at(name)))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def row_digest(columns: Sequence[str]) -> Column:
    """An aggregate that tells tables of rows apart, whatever their order: the sums of two hashes of each row."""
    one = lambda seed: F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).cast("string")
    return F.concat_ws(":", F.count("*").cast("string"), F.coalesce(one(1), F.lit("0")), F.coalesce(one(2), F.lit("0")))


class Published:
    """A table of published versions below ``root``, keyed by ``key`` (unique, not null), in ``buckets`` buckets.

    Rows are dealt by ``by``, the key by default; a row's ``by`` may not change.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, schema: str, buckets: int = 16, by: str | None = None) -> None:
        self.spark, self.root, self.key, self.buckets, self.by = spark, root.rstrip("/"), key, buckets, by or key
        self.schema = StructType.fromDDL(schema)
        self.files = _Files(spark, root)

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in self.files.names("versions") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, the last one by default; an empty one before the first."""
        known = self.versions()
        if not known:
            return {"version": 0, "token": None, "buckets": {}, "deltas": []}
        return json.loads(self.files.read(f"versions/v{version or known[-1]:010d}.json"))

    def _folders(self, names: Sequence[str], schema: StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{n}" for n in names))

    def _write(self, rows: DataFrame, folder: str) -> None:
        """A file a bucket; a bucket of many rows is one task's work, so there should be enough of them."""
        dealt = rows.withColumn("_bucket", self.bucket(F.col(self.by)))
        dealt.repartition(self.buckets, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/{folder}")

    def _digests(self, rows: DataFrame, schema: StructType) -> dict[int, str]:
        by = rows.groupBy(self.bucket(F.col(self.by)).alias("b")).agg(row_digest(schema.fieldNames()).alias("d"))
        return {r["b"]: r["d"] for r in by.collect()}  # a row a bucket

    def _publish(self, before: dict, token: str, buckets: dict, deltas: list, after: After) -> int:
        version = before["version"] + 1
        if not self.files.put(f"versions/v{version:010d}.json", json.dumps({"version": version, "token": token, "buckets": buckets, "deltas": deltas})):
            raise RuntimeError(f"another writer has published version {version} of {self.root}")
        after("published")
        return version

    def _done(self, token: str) -> int | None:
        """The version that a change has published; a few of the last ones are looked at."""
        return next((v for v in self.versions()[-8:] if self.manifest(v)["token"] == token), None)

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version: of each key the last one written, none if that is a tombstone. ``only``: these buckets."""
        manifest = self.manifest(version)
        wanted = {str(b) for b in only} if only is not None else None
        base = self._folders([e["folder"] for b, e in manifest["buckets"].items() if wanted is None or b in wanted], self.schema)
        if not manifest["deltas"]:
            return base
        names = self.schema.fieldNames()
        rows = base.select(*names, F.lit(False).alias("_gone"), F.lit(0).alias("_nth"))
        for nth, delta in enumerate(manifest["deltas"], 1):
            held = [f"{delta}/_bucket={b}" for b in only] if only is not None else [delta]
            there = {f"{delta}/{n}" for n in self.files.names(delta)} | {delta}
            part = self._folders([h for h in held if h in there], StructType([*self.schema.fields, *StructType.fromDDL("_gone boolean").fields]))
            rows = rows.unionByName(part.select(*names, "_gone", F.lit(nth).alias("_nth")))
        # As many tasks as buckets at least, so that a larger table's tasks stay as they are.
        tasks = max(self.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return latest(rows.repartition(tasks, self.key), self.key, "_nth").where("not _gone").select(*names)

    def refresh(self, rows: DataFrame, token: str, only: Sequence[int] | None = None, after: After = _nothing) -> int:
        """Make the table hold ``rows`` and no others; buckets whose rows are as they were keep their folders.

        ``only``: ``rows`` are of these buckets, the others stay.
        """
        done = self._done(token)
        if done:
            return done
        before = self.manifest()
        if before["deltas"] and only is not None:
            raise ValueError("compact the table first")
        rows = rows.select(*self.schema.fieldNames())
        digests = self._digests(rows, self.schema)
        covered = set(range(self.buckets)) if only is None else set(only)
        changed = sorted(b for b, d in digests.items() if before["buckets"].get(str(b), {}).get("digest") != d)
        kept = {b: e for b, e in before["buckets"].items() if int(b) not in covered or int(b) in digests and int(b) not in changed}
        folder = f"data/{token}"
        if changed:
            self._write(rows.where(self.bucket(F.col(self.by)).isin(changed)), folder)
        after("copied")
        if changed and self._digests(self._folders([f"{folder}/_bucket={b}" for b in changed], self.schema), self.schema) != {b: digests[b] for b in changed}:
            raise RuntimeError(f"what was written to {folder} isn't what was to be written")
        after("verified")
        buckets = kept | {str(b): {"folder": f"{folder}/_bucket={b}", "digest": digests[b]} for b in changed}
        return self._publish(before, token, buckets, [], after)

    def upsert(self, rows: DataFrame, token: str, gone: Column | None = None, after: After = _nothing) -> int:
        """Add rows that replace those of their keys; where ``gone`` holds, the key goes. A small folder, until :meth:`compact`."""
        done = self._done(token)
        if done:
            return done
        before = self.manifest()
        marked = rows.select(*self.schema.fieldNames(), (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("_gone"))
        self._write(marked, f"data/{token}")
        after("copied")
        return self._publish(before, token, before["buckets"], [*before["deltas"], f"data/{token}"], after)

    def touched(self) -> list[int]:
        """The buckets that changes since the last compaction have rows of."""
        found = {n.partition("=")[2] for d in self.manifest()["deltas"] for n in self.files.names(d) if n.startswith("_bucket=")}
        return sorted(int(b) for b in found)

    def compact(self, token: str, after: After = _nothing) -> int:
        """Merge changes into the buckets that they touch; all others keep their folders. What the table holds stays the same."""
        done = self._done(token)
        if done:
            return done
        before, touched = self.manifest(), self.touched()
        rows = self.read(before["version"], touched) if touched else self._folders([], self.schema)
        digests = self._digests(rows, self.schema)
        if digests:
            self._write(rows, f"data/{token}")
        after("copied")
        buckets = {b: e for b, e in before["buckets"].items() if int(b) not in touched}
        buckets |= {str(b): {"folder": f"data/{token}/_bucket={b}", "digest": d} for b, d in digests.items()}
        if digests and self._digests(self._folders([buckets[str(b)]["folder"] for b in digests], self.schema), self.schema) != digests:
            raise RuntimeError(f"what was written to data/{token} isn't what was to be written")
        after("verified")
        return self._publish(before, token, buckets, [], after)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the manifests before the last ``keep`` and the folders that none of these names."""
        known = self.versions()
        for version in known[:-keep]:
            self.files.delete(f"versions/v{version:010d}.json")
        held = set()
        for version in known[-keep:]:
            manifest = self.manifest(version)
            held |= {e["folder"].split("/")[1] for e in manifest["buckets"].values()} | {d.split("/")[1] for d in manifest["deltas"]}
        gone = [n for n in self.files.names("data") if n not in held]
        for name in gone:
            self.files.delete(f"data/{name}")
        return gone


def migrate(artifacts: Published, records: Published, moved: Callable[[Column], Column], token: str, reference: str = "path", after: After = _nothing) -> None:
    """Move artifacts (key: path) to new paths and let records refer to them there; references resolve at every moment.

    New rows are published beside the old ones, then the rewritten records, then the table without the old rows, and at
    last the old folders go. Artifacts whose path doesn't change, and records that refer to nothing moved, stay as they are.
    """
    step = lambda name: lambda s: after(f"{name} {s}")
    if not artifacts._done(f"{token}-moved"):
        if not artifacts._done(f"{token}-beside"):
            old = artifacts.read()
            new = old.withColumn("_to", moved(F.col(artifacts.key))).where(~F.col("_to").eqNullSafe(F.col(artifacts.key)))
            artifacts.refresh(old.unionByName(new.withColumn(artifacts.key, F.col("_to")).drop("_to")), f"{token}-beside", after=step("beside"))
        records.refresh(records.read().withColumn(reference, moved(F.col(reference))), f"{token}-records", after=step("records"))
        both = artifacts.read()
        left = both.where(F.col(artifacts.key).eqNullSafe(moved(F.col(artifacts.key))))
        artifacts.refresh(left, f"{token}-moved", after=step("moved"))
    artifacts.vacuum()
    after("old artifacts deleted")
    records.vacuum()
