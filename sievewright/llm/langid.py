"""Language identification by error-correcting output codes.

Every language has a codeword of bits; one binary classifier a bit, linear over hashed byte n-grams, predicts it.
Decoding weighs the bits' losses by how well each classifier did on its training rows, chooses the codeword with
the smallest loss, and flags a document as ambiguous when the runner-up is close.

Codewords have as many bits as keep any two of them ``DISTANCE`` apart, so wrong bits can be outvoted however many
languages there are.

The classifier is fitted on the driver on a bounded sample: at most ``per_lang`` labelled rows a language, the first by a
hash of doc_id, and fewer if languages are so many that all together would pass ``most_rows`` (but ``LEAST_ROWS`` of each:
no language is left out). Rows are held as sparse features and fitted in batches of ``BATCH``. Prediction covers every row
and reads whole texts, however long: a text is its counts of byte n-grams.

Null or letterless text: ``und``, score 0, not ambiguous. Null lang: never used in fitting. Without any labelled row
with letters everything is ``und``. Equal losses go to the language that is first by code point. Repeated rows are
predicted alike. A null doc_id has no hash: it is predicted like others, and who fits on some folds leaves it out. Extra
columns pass through. An empty table
fits no model and gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import byte_texts, short_batches

PER_LANG, MOST_ROWS, LEAST_ROWS, BITS, DISTANCE, BATCH = 250, 8000, 8, 15, 5, 1000
UNKNOWN = "und"
_DIMS = 4096 + 8192


def _symbols() -> np.ndarray:
    """A byte's symbol: 0 for everything that is no letter, 1-26 for letters, 27-63 for bytes of longer characters."""
    table = np.zeros(256, dtype=np.uint8)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i + 1
    high = np.arange(128, 256)
    table[128:] = 27 + high % 37
    return table


_SYMBOL = _symbols()
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def features(text: bytes) -> np.ndarray | None:
    """Square roots of n-gram counts (pairs, hashed triples), at length 1; None if the text has no letter."""
    if not text or not (_ASCII_LETTER.search(text) or any(map(str.isalpha, text.decode("utf-8", "replace")))):
        return None
    raw = np.frombuffer(text, dtype=np.uint8)
    s = _SYMBOL[raw]
    s = np.concatenate([[0], s, [0]]).astype(np.int32)
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)  # runs of other characters count once
    s = s[keep]
    two = s[:-1] * 64 + s[1:]
    three = ((two[:-1] * 64 + s[2:]) * np.int32(40503) >> 5) & 8191
    x = np.concatenate([np.bincount(two, minlength=4096), np.bincount(three, minlength=8192)]).astype(np.float32)
    x[0] = 0
    x = np.sqrt(x)
    return x / max(float(np.linalg.norm(x)), 1e-9)


def codewords(k: int, bits: int = BITS, distance: int = DISTANCE) -> np.ndarray:
    """k rows of +1/-1, any two ``distance`` bits apart or more: the best of a fixed series of random matrices.

    Columns split the classes. Bits are added until the distance is reached.
    """
    rng, bits = np.random.default_rng(7), max(bits, 2 * (k - 1).bit_length())
    while True:
        best, found = -1, np.ones((k, bits))
        for _ in range(400 if k <= 64 else 8):
            m = rng.integers(0, 2, (k, bits)) * 2 - 1
            for j in range(bits):
                while k > 1 and abs(m[:, j].sum()) == k:
                    m[:, j] = rng.integers(0, 2, k) * 2 - 1
            alike = (m @ m.T).astype(np.int32)
            np.fill_diagonal(alike, -bits)
            far = int(bits - alike.max()) // 2 if k > 1 else bits
            if far > best:
                best, found = far, m
        if best >= distance:
            return found.astype(np.float64)
        bits += 4


@dataclass(frozen=True)
class EcocModel:
    langs: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every row against every codeword."""
        f = x @ self.weights + self.bias
        plus, minus = np.logaddexp(0, -f) * self.trust, np.logaddexp(0, f) * self.trust
        up = (self.codes > 0).astype(float)
        return plus @ up.T + minus @ (1 - up).T

    def predict(self, x: np.ndarray, margin: float) -> list[tuple[str, float, bool]]:
        loss = self.losses(x)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        best = np.round(loss, 9).argmin(axis=1)  # sums that differ by rounding are equal
        rest = np.sort(loss, axis=1)
        near = rest[:, 1] - rest[:, 0] < margin if loss.shape[1] > 1 else np.zeros(len(x), dtype=bool)
        return [(self.langs[b], float(p[i, b]), bool(near[i])) for i, b in enumerate(best)]


Sparse = tuple[np.ndarray, np.ndarray]


def _dense(rows: list[Sparse]) -> np.ndarray:
    x = np.zeros((len(rows), _DIMS), dtype=np.float32)
    for i, (at, value) in enumerate(rows):
        x[i, at] = value
    return x


def _fit_bits(rows: list[Sparse], y: np.ndarray, steps: int = 250, rate: float = 4.0, decay: float = 1e-5, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, bias, part of rows right, by bit): logistic regression of all bits at once, by gradient descent with momentum.

    y: rows by bits, +1/-1. Every step takes the next ``batch`` rows in a fixed random order.
    """
    w, b = np.zeros((_DIMS, y.shape[1]), dtype=np.float32), np.zeros(y.shape[1], dtype=np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    y = y.astype(np.float32)
    order = np.random.default_rng(3).permutation(len(rows))
    parts = [order[at : at + batch] for at in range(0, len(order), batch)]
    x = None
    for step in range(max(steps, 15 * len(parts))):
        part = parts[step % len(parts)]
        x = x if x is not None and len(parts) == 1 else _dense([rows[i] for i in part])
        g = -y[part] / (1 + np.exp(np.clip(y[part] * (x @ w + b), -30, 30))) / len(part)
        vw = 0.9 * vw - rate * (x.T @ g + decay * w)
        vb = 0.9 * vb - rate * g.sum(axis=0)
        w, b = w + vw, b + vb
    right = sum(((_dense([rows[i] for i in part]) @ w + b) * y[part] > 0).sum(axis=0) for part in parts)
    return w, b, right / len(rows)


def fit(rows: DataFrame, per_lang: int = PER_LANG, most_rows: int = MOST_ROWS, bits: int = BITS) -> EcocModel | None:
    """Fit on rows with doc_id, text and lang; which rows may be used is the caller's to filter."""
    usable = rows.where("lang is not null and text is not null").select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("h"))
    per_lang = min(per_lang, max(LEAST_ROWS, most_rows // max(1, usable.select("lang").distinct().count())))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")) <= per_lang
    # Ids are ranked without their texts; the chosen ones, at most per_lang a language, then fetch the texts.
    ids = usable.select("lang", "doc_id", "h").withColumn("first", first).where("first").select(F.col("lang").alias("l"), F.col("doc_id").alias("d")).distinct()
    chosen = usable.join(F.broadcast(ids), (F.col("lang") == F.col("l")) & F.col("doc_id").eqNullSafe(F.col("d"))).withColumn("first", first).where("first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                if (x := features(text)) is not None:
                    at = np.flatnonzero(x)
                    yield pa.RecordBatch.from_pydict({"lang": [lang], "at": [at.astype("<u2").tobytes()], "x": [x[at].astype("<f2").tobytes()]})

    got = sorted(tuple(r) for r in chosen.select("lang", "text").mapInArrow(run, "lang string, at binary, x binary").collect())
    if not got:
        return None
    langs = tuple(sorted({lang for lang, _, _ in got}))
    number = {lang: i for i, lang in enumerate(langs)}
    codes = codewords(len(langs), bits)
    w, b, right = _fit_bits([(np.frombuffer(at, "<u2"), np.frombuffer(x, "<f2")) for _, at, x in got], codes[[number[lang] for lang, _, _ in got]])
    trust = np.clip(2 * right - 1, 0.05, 1)
    return EcocModel(langs, codes, w, b, trust / trust.sum() * len(trust))


def identify(docs: DataFrame, model: EcocModel | None, margin: float = 0.5) -> DataFrame:
    """The columns of ``docs`` and lang_pred, score (0 to 1), ambiguous. Clashing columns of the input are replaced."""
    spark = docs.sparkSession
    short_batches(spark)
    docs = docs.drop("lang_pred", "score", "ambiguous")
    names = docs.columns
    shared = spark.sparkContext.broadcast(model)  # bounded: bits x 12,288 weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = byte_texts(batch.column(names.index("text")))
            out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, False)] * len(texts)
            for at in range(0, len(texts), 500):
                found = [(i, x) for i in range(at, min(at + 500, len(texts))) if m is not None and (x := features(texts[i])) is not None]
                if found:
                    for (i, _), answer in zip(found, m.predict(np.stack([x for _, x in found]), margin), strict=True):
                        out[i] = answer
            lang, score, near = (pa.array([r[j] for r in out], kind) for j, kind in enumerate((pa.string(), pa.float64(), pa.bool_())))
            yield pa.RecordBatch.from_arrays([*batch.columns, lang, score, near], names=[*names, "lang_pred", "score", "ambiguous"])

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

    schema = StructType([*docs.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType()).add("ambiguous", BooleanType())
    return docs.mapInArrow(run, schema)


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 4."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))
