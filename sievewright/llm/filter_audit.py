"""Filter interaction audit by Walsh-Hadamard sums: what each of five filters removes, in every order that they can have.

A document's failures are a mask of five bits. For each part and label (all documents, those of good quality, toxic ones)
32 signed parity sums are aggregated, S(w) = sum of (-1)^|w & mask|; they add up over tasks, parts and days. The inverse
transform, five butterflies and an exact division by 32, gives the number of documents with each mask. From these
numbers follow all 120 orders at all five steps, without another look at a document, and the Shapley values in closed
form: a document that fails k filters is removed by each of them in 120 / k of the orders.

Conditions (A to E, first bit to last): under ``LEAST_WORDS`` words; distinct words under half of the words; capitals A-Z
over 2 % of the code points; one of ``#$%&*|``; a text that a smaller doc_id has too, in the whole table.

Scale: texts are read once, in Arrow batches, and leave 60 bytes a document. Equal texts (equal SHA-256) meet by a
pre-aggregated minimum of their ids; digests of large groups of copies are broadcast, so their rows stay where they are.
Labels are joined by doc_id. The sums, 32 numbers a part and label, are pre-aggregated in every task; 600 rows a part come out.

Null text: empty (A, not B: none of its words repeats; all empty texts are equal). Very long texts are counted whole, in
steps. Null part: the empty string. A null doc_id is neither smaller nor larger than another, and has no labels. Rows that
repeat a doc_id are documents of their own, and no duplicates of each other. A document counts as good or toxic if any of
its labels says so; null labels say nothing. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import byte_texts, joined_by_count, materialise, short_batches, tidy, word_steps

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 2
_MARKS, _CAPITALS = b"#$%&*|", bytes(range(65, 91))
_MASKS, _FAILS = 1 << len(FILTERS), {f: 1 << i for i, f in enumerate(FILTERS)}
#: The labels that parity sums are kept for: all documents, those of good quality, toxic ones.
LABELS = ("all", "good", "toxic")


def text_failures(text: bytes) -> int:
    """The conditions that a text fails by itself (A to D), as a mask."""
    n, distinct = 0, set()
    for words in word_steps(text):
        n += len(words)
        distinct.update(words)
    points = len(text) if text.isascii() else len(text.decode(errors="replace"))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    failed = (n < LEAST_WORDS, 100 * len(distinct) < DISTINCT_PERCENT * n, 100 * capitals > CAPITALS_PERCENT * points, len(text.translate(None, _MARKS)) < len(text))
    return sum(1 << i for i, f in enumerate(failed) if f)


def _looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tidy()
    for batch in batches:
        texts = [t or b"" for t in byte_texts(batch.column(2))]
        masks = pa.array([text_failures(t) for t in texts], pa.int32())
        digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), masks, digests], names=["doc_id", "part", "mask", "digest"])


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """(doc_id, part, mask): every document with the filters that it fails."""
    short_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    rows = materialise(rows.mapInArrow(_looked_at, "doc_id long, part string, mask int, digest binary"), "failures")
    equal = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
    equal = materialise(equal.where("least < most").drop("most"), "equal-texts")
    marked = joined_by_count(rows, equal, "digest", "n", rows.count(), "left")
    copied = F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False))
    return marked.select("doc_id", "part", (F.col("mask") + F.when(copied, _FAILS["E"]).otherwise(0)).alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``, false without a label."""
    say = lambda c: F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False)).alias(c)
    of = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_of")).agg(say("quality"), say("toxic"))
    met = rows.join(of, F.col("doc_id") == F.col("_of"), "left")
    return met.select(*rows.columns, F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def parity_sums(rows: DataFrame) -> DataFrame:
    """(part, sums): for each label that occurs, the signed sums over masks for all parities w, in order."""
    sign = [F.lit(1) - 2 * F.bit_count(F.col("mask").bitwiseAND(F.lit(w))).bitwiseAND(F.lit(1)) for w in range(_MASKS)]
    label = F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.col("good"), "good"), F.when(F.col("toxic"), "toxic"))))
    by = rows.select("part", "mask", label.alias("label")).groupBy("part", "label").agg(*(F.sum(s.cast("long")).alias(f"s{w}") for w, s in enumerate(sign)))
    return by.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("label", F.array(*(f"s{w}" for w in range(_MASKS)))))).alias("sums"))


def cells(sums: np.ndarray) -> np.ndarray:
    """Parity sums (last axis: 32) back to numbers of documents by mask; the transform is its own inverse, but for the size."""
    out = sums.astype(np.int64)
    n, step = out.shape[-1], 1
    while step < n:
        pair = out.reshape(*out.shape[:-1], n // (2 * step), 2, step)
        out = np.stack([pair[..., 0, :] + pair[..., 1, :], pair[..., 0, :] - pair[..., 1, :]], axis=-2).reshape(out.shape)
        step *= 2
    if (out % n).any():
        raise ValueError("these are not parity sums of whole documents")
    return out // n


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the filters before, bit of the step's filter) for every order."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(order), step, before, _FAILS[f]))
            before |= _FAILS[f]
    return out


def shapley_weights(bit: int) -> np.ndarray:
    """In how many of the 120 orders the filter is the one that removes a document, by the document's mask."""
    orders = len(list(permutations(FILTERS)))
    return np.array([orders // m.bit_count() if m & bit else 0 for m in range(_MASKS)], dtype=np.int64)


def _evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = _steps()
    masks = np.arange(_MASKS)
    before = np.array([b for _, _, b, _ in steps])[:, None]
    bit = np.array([b for *_, b in steps])[:, None]
    reached, fails = (masks & before) == 0, (masks & bit) > 0
    each = {"kept": reached & ~fails, "removed": reached & fails, "redundant": ~reached & fails, "unique_fails": masks == bit}
    each = {k: v.astype(np.int64) for k, v in each.items()} | {"shapley": np.stack([shapley_weights(b) for *_, b in steps])}
    for batch in batches:
        for row in batch.to_pylist():
            sums = dict(row["sums"])
            n, good, toxic = cells(np.array([sums.get(label, [0] * _MASKS) for label in LABELS]))
            got = {k: m @ n for k, m in each.items()} | {"good_lost": each["removed"] @ good, "toxic_lost": each["removed"] @ toxic}
            columns = [pa.array([row["part"]] * len(steps), pa.string()), pa.array([s[0] for s in steps]), pa.array([s[1] for s in steps], pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(got[k]) for k in COUNTS)], names=["part", "filter_order", "step", *COUNTS])


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def evaluate(sums: DataFrame) -> DataFrame:
    """600 rows a part: filter_order, step, and what the step's filter does there."""
    return sums.mapInArrow(_evaluated, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The whole audit, from documents (doc_id, text, ``part``) and labels (doc_id, quality, toxic)."""
    return evaluate(parity_sums(labelled(failures(docs, part), labels)))
