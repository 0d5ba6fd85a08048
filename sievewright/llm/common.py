"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and the controls TAB to CR. ``bytes.split()`` splits on exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch; texts can be long, so batches are kept shorter than Spark's default.
BATCH_ROWS, BATCH_BYTES = 2000, 1 << 24

#: A key with more than one row in so many is frequent.
FREQUENT = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark only (the path may name any store that Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the folder that driver and executors share.

    Only a local master may leave the setting out; there ``/tmp/checkpoints`` serves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master.startswith("local[") or master == "local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file:///tmp/checkpoints"
    return f"{base.rstrip('/')}/sievewright/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


#: Tables written while :func:`recording`; None when nothing records.
_recorded: list[str] | None = None


@contextlib.contextmanager
def recording(into: list[str]) -> Iterator[None]:
    """Note the tables that are written meanwhile, so that they can go when they have served."""
    global _recorded
    before, _recorded = _recorded, into
    try:
        yield
    finally:
        _recorded = before


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_unread(tables: list[str], df: DataFrame) -> None:
    """Remove the given tables, but for those that ``df`` reads."""
    last = {f.rpartition("/")[0].rpartition("/")[2] for f in df.inputFiles()}
    for path in list(tables):
        if path.rpartition("/")[2] not in last:
            _delete(df.sparkSession, path)
            tables.remove(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all that this application wrote to its scratch folder; results that are read from there end with it."""
    _delete(spark, scratch_path(spark, "x").rpartition("/")[0])


def materialise(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors.

    The table stays until :func:`drop_scratch`, as what is made from it may be read at any time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    if _recorded is not None:
        _recorded.append(path)
    return spark.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: at most BATCH_ROWS rows and BATCH_BYTES an Arrow batch, unless set lower."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{key}").removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


#: What clears the tables that operators keep in a Python worker from task to task.
kept_in_worker: list[Callable[[], None]] = []


def tidy() -> None:
    """In a worker: give back what tasks of another operator have kept, and what Arrow and the C library hold for later."""
    for clear in kept_in_worker:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(sizes: Iterable[int], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Cut a batch of texts of these sizes into runs of rows holding about ``most`` bytes, so that what is made of them stays small."""
    start = held = end = 0
    for end, n in enumerate(sizes, 1):
        held += n
        if held >= most:
            yield start, end
            start, held = end, 0
    if start < end:
        yield start, end


_SPACE = re.compile(rb"[ \t-\r]")


def word_steps(text: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text between white space, a list for each ``step`` bytes or so: a long text's words aren't held at once."""
    at = 0
    while len(text) - at > step:
        cut = _SPACE.search(text, at + step)
        if not cut:
            break
        yield text[at : cut.start()].split()
        at = cut.end()
    yield (text[at:] if at else text).split()


def bounded_sample(rows: DataFrame, key: Column, n: int, size: int) -> DataFrame:
    """The ``size`` rows that come first by a hash of ``key``, of n rows; the same rows on every run.

    A cut of the hash range leaves about twice as many before they are ordered, so tasks send little to the last step.
    """
    h = F.pmod(F.xxhash64(key, F.lit(3)), F.lit(1 << 40))
    share = min(1.0, (2 * size + 100) / max(n, 1))
    return rows.withColumn("_h", h).where(F.col("_h") < F.lit(int(share * (1 << 40)))).orderBy("_h", key).limit(size).drop("_h")


def joined_by_count(rows: DataFrame, table: DataFrame, key: str, n: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row a key and, in column ``n``, how many of ``total`` rows have it.

    Keys with more than a ``FREQUENT``-th of the rows, fewer than ``FREQUENT`` whatever the data, are broadcast, so their
    rows stay where they are; only the others are shuffled. ``n`` is dropped. Keys that are null match nothing.
    """
    often = F.col(n) * FREQUENT > F.lit(total)
    few, many = table.where(often).drop(n), table.where(~often).drop(n)
    marked = rows.join(F.broadcast(few.withColumn("_few", F.lit(True))), key, "left")
    near = marked.where("_few").drop("_few")
    far = marked.where("_few is null").select(*rows.columns)
    if how == "inner":
        return near.unionByName(far.join(many, key))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in many.schema if f.name != key]
    return near.unionByName(far.where(F.col(key).isNotNull()).join(many, key, "left")).unionByName(far.where(F.col(key).isNull()).select(*rows.columns, *nothing))
