"""WARC archives written and read through Spark, with boundary-chain verification.

Writing: payload digests are counted as small rows (pre-aggregated before the shuffle, and frequent ones broadcast, so a
page that makes up a third of the table is never one task's work); only records that are not revisits carry a payload.
Spark's text sink writes each record followed by the blank line that ends it, so any store that Spark writes to will do.

Reading: files that are not compressed are split among tasks. Every task cuts its split at the magic and emits, for every
magic that a header follows, a candidate record with the offset of its successor. Magic inside a payload gives candidates
as well. Pointer jumping from the start of each file, over the offsets of all its splits, then retains the candidates
that the chain reaches, in a logarithmic number of vectorised steps; all others are payload bytes. A chain that doesn't
end exactly where the file ends raises an error: no record is lost in silence. Payloads are digested while they stream
past, one at a time in each split; records that run into the next split, or that a false candidate hid, are digested from
their pieces in a second pass, ``PER_PASS`` records at a time.

A file's chain, two numbers a candidate, is one task's work; a line between two magics is held whole, so a payload must
fit a worker's memory (and Spark's limit of 2 GB a value). Both WARC/1.0 and WARC/1.1 are read, plain or gzip (one member
or many). In archives of others, page_id is null unless the record id is ``urn:page:``, and a told digest, in base 16 or
32, is compared only where it is one of the whole block, which it isn't for ``application/http``.

Nulls: a null html is an empty payload; a null page_id is always written as a response and never referred to; a null
url is left out. Rows that repeat a page_id and payload repeat the record; of equal payloads the largest page_id is the
response, rows that tie on it all are. Extra columns are ignored. An empty table gives an archive without records, and an
empty file has none.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.llm.common import joined_by_count, materialise, scratch_path

#: What every record begins with, and what a task cuts its split at.
MAGIC, VERSION = "WARC/1.", "1\r\n"
END = "\r\n\r\n"
#: Payloads shorter than this are never deduplicated.
REVISIT_BYTES = 1000
#: Records that one further pass digests; it bounds a broadcast table.
PER_PASS = 200_000

def records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """One WARC record a row, in column ``record``, without the blank line that ends it."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("n"))
    firsts = rows.where(F.col("n") >= revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("c")).where("c > 1 and keep is not null")
    firsts = materialise(firsts, "repeated")
    typed = joined_by_count(rows, firsts, "digest", "c", pages.count(), "left")
    again = F.coalesce(F.col("page_id") < F.col("keep"), F.lit(False))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(MAGIC + VERSION),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(again, line("WARC-Refers-To", urn(F.col("keep")))).otherwise(""),
        F.when(again, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        line("X-Payload-Length", F.col("n").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(again, "0").otherwise(F.col("n").cast("string"))),
        F.lit("\r\n"),
    )
    return typed.select(F.concat(head, F.when(again, "").otherwise(F.col("payload"))).alias("record"))


def write_archives(rows: DataFrame, path: str, max_records: int = 5000, compression: str = "gzip") -> None:
    """Write the records of :func:`records` as archives below ``path``."""
    rows.write.option("lineSep", END).option("compression", compression).option("maxRecordsPerFile", max_records).text(path)


_FIELD = re.compile(rb"([A-Za-z0-9-]+): *([^\r\n]*)")
_HEAD = re.compile(rb"[01]\r\n((?:[^\r\n]+\r\n)+)\r\n")
_CANDIDATE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("body", pa.int64()), ("next", pa.int64()), ("kind", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("told", pa.string()), ("length", pa.int64()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string())])
_DDL = "file string, block long, at long, body long, next long, kind string, page_id long, uri string, told string, length long, payload_bytes long, refers_to long, digest string"


def _told(head: dict[bytes, bytes]) -> str | None:
    """The digest that a header tells for the whole block, in base 16."""
    value = head.get(b"warc-block-digest") or (None if head.get(b"content-type", b"").startswith(b"application/http") else head.get(b"warc-payload-digest"))
    if not value or not value.lower().startswith(b"sha1:"):
        return None
    text = value[5:].decode(errors="replace").strip()
    if len(text) == 32:
        try:
            return base64.b32decode(text.upper()).hex()
        except ValueError:
            return None
    return text.lower()


class _Split:
    """A split while it streams past: candidates, and the digest of one payload at a time."""

    def __init__(self, file: str, block: int, size: int) -> None:
        self.file, self.block, self.size, self.at = file, block, size, 0
        self.first = block == 0  # later splits begin after a magic
        self.row: dict | None = None
        self.sha, self.left = hashlib.sha1(), 0

    def _feed(self, data: bytes | memoryview, out: list[dict]) -> None:
        if self.row is not None:
            used = data[: self.left]
            self.sha.update(used)
            self.left -= len(used)
            if not self.left:
                self.row["digest"] = self.sha.hexdigest()
                out.append(self.row)
                self.row = None

    def line(self, value: bytes, out: list[dict]) -> None:
        """What stands between two magics, and the magic before it unless it is a split's first."""
        magic = MAGIC.encode()
        if not self.first:
            at, self.at = self.at, self.at + len(magic)
            self._feed(magic, out)
            m = _HEAD.match(value)
            fields = {k.lower(): v.strip() for k, v in _FIELD.findall(m[1])} if m else {}
            if fields.get(b"content-length", b"").isdigit():
                row = self._candidate(at, self.at + m.end(), fields)
                if self.row is None:
                    self.row, self.sha, self.left = row, hashlib.sha1(), row["length"]
                    self._feed(memoryview(value)[m.end() :], out)
                else:
                    out.append(row)
                    self._feed(value, out)
            else:
                self._feed(value, out)
        self.first = False
        self.at += len(value)

    def _candidate(self, at: int, body: int, head: dict[bytes, bytes]) -> dict:
        number = lambda key: int(m[1]) if (m := re.search(rb"urn:page:(-?\d+)>", head.get(key, b""))) else None
        kind, length = head.get(b"warc-type", b"").decode(errors="replace"), int(head[b"content-length"])
        uri = head[b"warc-target-uri"].decode(errors="replace") if b"warc-target-uri" in head else None
        row = {"file": self.file, "block": self.block, "at": at, "body": body, "next": body + length + len(END), "kind": kind, "page_id": number(b"warc-record-id"), "uri": uri, "told": _told(head), "length": length, "payload_bytes": length}
        if kind == "revisit":
            told = head.get(b"x-payload-length", b"")
            row |= {"refers_to": number(b"warc-refers-to"), "payload_bytes": int(told) if told.isdigit() else None}
        return row

    def end(self, out: list[dict]) -> None:
        """A payload that isn't complete stays without digest; the split's size is a row of its own."""
        if self.row is not None:
            out.append(self.row)
        out.append({"file": self.file, "block": self.block, "at": -1, "next": self.at, "length": self.size})


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Split | None = None
    for batch in batches:
        out: list[dict] = []
        for file, block, size, value in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if now is None or (file, block) != (now.file, now.block):
                if now is not None:
                    now.end(out)
                now = _Split(file, block, size)
            now.line(value, out)
        if out:
            yield pa.RecordBatch.from_pylist(out, _CANDIDATE)
    if now is not None:
        now.end(out := [])
        yield pa.RecordBatch.from_pylist(out, _CANDIDATE)


def _reached(at: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which candidates the chain from offset 0 reaches. ``at`` ascends; doubling jumps, so log2(n) steps."""
    n = len(at)
    jump = np.searchsorted(at, successor)
    jump = np.where((jump < n) & (at[np.minimum(jump, n - 1)] == successor), jump, n)
    jump = np.append(jump, n)
    reach = np.zeros(n + 1, dtype=bool)
    reach[0] = n > 0 and at[0] == 0
    while True:
        new = reach.copy()
        new[jump[reach]] = True
        jump = jump[jump]
        if (new == reach).all():
            return reach[:n]
        reach = new


def _chain(rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a file that its chain reaches, with the offset in the file at which their split begins."""
    file = rows["file"].iloc[0]
    sizes = rows[rows["at"] < 0].sort_values("block")
    base = dict(zip(sizes["block"], sizes["next"].cumsum() - sizes["next"], strict=True))
    total = int(sizes["next"].sum())
    told = int(sizes["size"].iloc[0])
    if told >= 0 and told != total:
        raise ValueError(f"{file}: its splits hold {total} bytes of {told}")
    rows = rows[rows["at"] >= 0]
    shift = rows["block"].map(base).to_numpy(dtype=np.int64)
    order = np.argsort(rows["at"].to_numpy() + shift, kind="stable")
    rows, shift = rows.iloc[order], shift[order]
    at, successor = rows["at"].to_numpy() + shift, rows["next"].to_numpy() + shift
    reach = _reached(at, successor)
    end = int(successor[reach].max()) if reach.any() else 0
    if end != total:
        raise ValueError(f"{file}: no record at byte {end} of {total}" if end < total else f"{file}: its last record is cut short")
    kept = rows[reach]
    return pd.DataFrame({"file": file, "block": kept["block"], "at": kept["at"], "base": shift[reach]})


def _pieces(wanted: dict[tuple[str, int], list[tuple[int, int, int]]]):
    """(file, start, at, data): the bytes of wanted ranges (start, from, to), offsets of the split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for batch in batches:
            out: list[tuple] = []
            for file, block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if (file, block) != now:
                    now, at, data = (file, block), 0, value if not block else MAGIC.encode() + value
                else:
                    data = MAGIC.encode() + value
                for start, lo, hi in wanted.get(now, ()):
                    a, b = max(lo, at), min(hi, at + len(data))
                    if a < b:
                        out.append((file, start, a - lo, data[a - at : b - at]))
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64(), pa.binary()))], names=["file", "start", "at", "data"])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, digest) of pieces in order."""
    last, sha = None, hashlib.sha1()
    done: list[tuple] = []
    for batch in batches:
        for file, start, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if (file, start) != last:
                if last is not None:
                    done.append((*last, sha.hexdigest()))
                last, sha = (file, start), hashlib.sha1()
            sha.update(data)
    if last is not None:
        done.append((*last, sha.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string()))], names=["file", "start", "digest"])


def _mended(lines: DataFrame, found: DataFrame, sizes: DataFrame, per_pass: int) -> DataFrame:
    """(file, start, digest) of the records of ``found`` that have none, from a further pass over ``lines``."""
    spark = lines.sparkSession
    open_ = materialise(found.where("digest is null").select("file", (F.col("base") + F.col("at")).alias("start"), (F.col("base") + F.col("body")).alias("lo"), (F.col("base") + F.col("body") + F.col("length")).alias("hi")), "open")
    passes = -(-open_.count() // per_pass)
    out = spark.createDataFrame([], "file string, start long, digest string")
    for i in range(passes):
        some = open_.where(F.pmod(F.xxhash64("file", "start"), F.lit(passes)) == i).join(sizes, "file").where((F.col("lo") < F.col("base") + F.col("bytes")) & (F.col("hi") > F.col("base")))
        wanted: dict[tuple[str, int], list[tuple[int, int, int]]] = {}
        for r in some.collect():  # about per_pass rows
            wanted.setdefault((r["file"], r["block"]), []).append((r["start"], r["lo"] - r["base"], r["hi"] - r["base"]))
        pieces = lines.mapInArrow(_pieces(wanted), "file string, start long, at long, data binary")
        # Offsets count from the record's first byte in each split; splits come in order of their base.
        pieces = pieces.repartition("file", "start").sortWithinPartitions("file", "start", "at").select("file", "start", "data")
        out = out.unionByName(materialise(pieces.mapInArrow(_digests, "file string, start long, digest string"), "mended"))
    return out


def read_archives(spark: SparkSession, path: str, per_pass: int = PER_PASS) -> DataFrame:
    """The records of all archives below ``path``: file, at (offset), kind, page_id, uri, payload_bytes, digest, refers_to."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    packed = F.col("_metadata.file_name").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    size = F.when(packed, F.lit(-1)).otherwise(F.col("_metadata.file_size"))
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), size.alias("size"), F.col("value").cast("binary").alias("value"))
    rows = materialise(lines.mapInArrow(_candidates, _DDL), "candidates")
    chain = rows.select("file", "block", "at", "next", F.col("length").alias("size")).groupBy("file").applyInPandas(_chain, "file string, block long, at long, base long")
    found = materialise(rows.join(chain, ["file", "block", "at"]), "records")
    if not found.where("digest is null").isEmpty():
        sizes = rows.where("at < 0").select("file", "block", F.col("next").alias("bytes"))
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("base", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
        more = _mended(lines.select("file", "block", "value"), found, sizes, per_pass).select(F.col("file").alias("in"), "start", F.col("digest").alias("mended"))
        found = found.join(more, (F.col("file") == F.col("in")) & (F.col("base") + F.col("at") == F.col("start")), "left").withColumn("digest", F.coalesce("digest", "mended"))
    again = F.col("kind") == "revisit"
    wrong = F.raise_error(F.concat(F.col("file"), F.lit(": the payload differs from its digest at byte "), (F.col("base") + F.col("at")).cast("string")))
    digest = F.when(again, F.col("told")).when(F.col("told") == F.col("digest"), F.col("digest")).when(F.col("told").isNull(), F.col("digest")).otherwise(wrong.cast("string"))
    return found.select("file", (F.col("base") + F.col("at")).alias("at"), "kind", "page_id", "uri", "payload_bytes", digest.alias("digest"), "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(records(pages), path)
    return read_archives(spark, path)
