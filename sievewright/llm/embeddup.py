"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are brought to length 1 and rotated into principal axes, largest variance first. Within a label they are ordered
by cells of their ``LEAD`` leading coordinates, cut into blocks and, within these, tiles. Two blocks, or two tiles, are
compared only if the boxes of their leading coordinates come within sqrt(2 - 2t) of each other. A comparison accumulates
inner products over the leading dimensions in steps, bounds the rest by the product of the two suffix norms
(Cauchy-Schwarz), and stops for every pair whose bound says that the cosine cannot reach t. What is left is decided in
double precision; pairs that rounding could put on either side of t, by dot / (|a| |b|) of the original vectors.

Scale: equal vectors of a label are one row with its number of copies from the start (pre-aggregated), so a vector that
makes up a third of the table is compared once. A block's number comes from counts by cell (pre-aggregated) and, within a
cell, a hash, so neither a label nor a cell with a third of all rows is one task's work. A block is shipped, as one packed
row of about ``BLOCK`` vectors, to the pairs it takes part in; the larger the block, the less is shipped. A pair of blocks
emits, for each vector with a link, the number of its links and one vector that links lead to, never the pairs themselves.
Data without structure in its leading coordinates leaves little to prune: then the work is the square of a label.

The axes are fitted on a bounded sample (``SAMPLE`` vectors of each of the ``LENGTHS`` most usual lengths, the first by
hash); they only order the work, the result doesn't depend on them. Null, zero and non-finite vectors and vectors with
null components or a null label link with nothing; vectors are compared among their own length. Null vec_ids count as
vectors but are never a component's name. Ties: cosines of exactly t link. Repeated rows count as rows. Very long vectors
are held a block at a time. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import bounded_sample, joined_by_count, materialise, short_batches
from sievewright.llm.components import connected_components, roots

THRESHOLD, BLOCK, TILE, SAMPLE = 0.98, 4096, 512, 4096
#: Leading coordinates that order rows, and lengths whose axes are fitted.
LEAD, LENGTHS = 6, 8
#: Dimensions after which pairs that can't reach the threshold are given up.
STEPS = (8, 16, 32)


def sound(column: str = "embedding"):
    """Whether a vector can link: not null or empty, all components finite, not all zero."""
    v = F.col(column)
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)


def axes(vectors: DataFrame, sizes: list[tuple[int, int]], kind: np.dtype, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Principal axes (columns) of a bounded sample of unit vectors, for each of the given (length, number of rows)."""
    out = {}
    for d, n in sizes:
        rows = bounded_sample(vectors.where(F.col("d") == d), F.col("v"), n, sample).select("v").collect()
        x = _unit(np.frombuffer(b"".join(r["v"] for r in rows), dtype=kind).reshape(-1, d).astype(np.float64))
        _, _, turn = np.linalg.svd(x - x.mean(axis=0), full_matrices=True)
        out[d] = turn.T
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # neither overflow nor underflow
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _decided(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    """Whether each pair of original vectors (rows of a, b) has cosine >= t."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        cosine = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
    odd = ~np.isfinite(cosine)
    if odd.any():
        cosine[odd] = (_unit(a[odd]) * _unit(b[odd])).sum(axis=1)
    return cosine >= t


class Side:
    """One block: originals, unit vectors, rotated coordinates and their suffix norms."""

    def __init__(self, raw: np.ndarray, turn: np.ndarray | None, steps: tuple[int, ...] = STEPS) -> None:
        self.raw, self.unit = raw, _unit(raw)
        self.turned = self.unit if turn is None else self.unit @ turn
        d = raw.shape[1]
        self.cuts = [0, *(s for s in steps if s < d), d]
        squares = self.turned**2
        self.rest = {at: np.sqrt(squares[:, at:].sum(axis=1)) for at in self.cuts[1:]}


def compare(a: Side, b: Side, t: float, rows_a: slice, rows_b: slice, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= t of the given rows of two blocks; i < j if they are the same rows."""
    slack, cuts = 1e-9, a.cuts
    x, y = a.turned[rows_a], b.turned[rows_b]
    part = x[:, : cuts[1]] @ y[:, : cuts[1]].T
    alive = part + np.outer(a.rest[cuts[1]][rows_a], b.rest[cuts[1]][rows_b]) >= t - slack
    if same:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    held = part[i, j]
    for lo, hi in zip(cuts[1:-1], cuts[2:], strict=True):
        if not len(i):
            break
        held = held + np.einsum("kd,kd->k", x[i, lo:hi], y[j, lo:hi])
        keep = held + a.rest[hi][rows_a][i] * b.rest[hi][rows_b][j] >= t - slack
        i, j, held = i[keep], j[keep], held[keep]
    i, j = i + rows_a.start, j + rows_b.start
    cosine = np.einsum("kd,kd->k", a.unit[i], b.unit[j])
    good, near = cosine >= t, np.flatnonzero(np.abs(cosine - t) <= 1e-12)
    good[near] = _decided(a.raw[i[near]], b.raw[j[near]], t)
    return i[good], j[good]


def _boxes(side: Side, tile: int) -> list[tuple[slice, np.ndarray, np.ndarray]]:
    """Tiles of a block with the boxes of their leading coordinates."""
    lead = side.turned[:, :LEAD]
    return [(slice(at, min(at + tile, len(lead))), lead[at : at + tile].min(axis=0), lead[at : at + tile].max(axis=0)) for at in range(0, len(lead), tile)]


def linked(a: Side, b: Side | None, t: float, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= t between two blocks, or within one, tile by tile."""
    reach = 2 - 2 * t + 1e-9
    one, two = _boxes(a, tile), _boxes(a if b is None else b, tile)
    found = [(np.zeros(0, dtype=np.int64),) * 2]
    for m, (rows_a, lo_a, hi_a) in enumerate(one):
        for n, (rows_b, lo_b, hi_b) in enumerate(two):
            if b is None and n < m:
                continue
            gap = np.maximum(0, np.maximum(lo_b - hi_a, lo_a - hi_b))
            if float(gap @ gap) <= reach:
                found.append(compare(a, a if b is None else b, t, rows_a, rows_b, b is None and m == n))
    i, j = zip(*found, strict=True)
    return np.concatenate(i), np.concatenate(j)


def links(vectors: DataFrame, kind: np.dtype, t: float = THRESHOLD, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(a, b, n): for pairs of blocks, how many vectors link to a, copies counted, and one vector b that its links lead to.

    Sums of n by a are numbers of links, and the pairs (a, b) have the components of all links. vectors has key (long),
    label, d (length), v (packed) and copies (long).
    """
    spark = vectors.sparkSession
    usual = vectors.groupBy("d").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(LENGTHS).collect()
    turn = spark.sparkContext.broadcast(axes(vectors, [(r["d"], r["n"]) for r in usual], kind))  # bounded: lengths x dims x dims
    reach = float(np.sqrt(max(0.0, 2 - 2 * t))) + 1e-9

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            for d in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == d))
                x = _unit(np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=kind).reshape(-1, d).astype(np.float64))
                x = (x @ turn.value[d][:, :LEAD] if d in turn.value else x[:, :LEAD]).clip(-1, 1)
                x = np.pad(x, ((0, 0), (0, LEAD - x.shape[1])))
                slot = (np.floor((x + 1) / reach).astype(np.int64) @ (1 << 10 * np.arange(LEAD)[::-1])) if reach > 2**-8 else np.floor((x[:, 0] + 1) * 2**40).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(slot), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), LEAD).cast(pa.list_(pa.float64()))], names=["key", "label", "d", "v", "copies", "slot", "x"])

    of_label = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select("key", "label", "d", "v", "copies").mapInArrow(lead, f"key long, label {of_label}, d int, v binary, copies long, slot long, x array<double>")
    rows = materialise(rows.withColumn("cell", F.xxhash64("label", "d", "slot")), "leading")
    # A row's place among those of its label: the rows in the cells before, and a hash within its cell.
    counts = rows.groupBy("label", "d", "slot", "cell").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("label", "d").orderBy("slot", "cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Cells are told apart by hash; two that share one are counted together.
    counts = counts.withColumn("before", before).groupBy("cell").agg(F.min("before").alias("before"), F.sum("n").alias("n")).withColumn("held", F.col("n"))
    placed = joined_by_count(rows, materialise(counts, "cells"), "cell", "n", vectors.count())
    placed = placed.withColumn("block", F.floor((F.col("before") + F.pmod(F.xxhash64("key"), F.col("held"))) / block))
    sides = [f(F.col("x")[i]).alias(f"{name}{i}") for i in range(LEAD) for name, f in (("lo", F.min), ("hi", F.max))]
    packed = placed.groupBy("label", "d", "block").agg(*sides, F.collect_list(F.struct("slot", "key", "copies", "v")).alias("rows"))
    packed = materialise(packed, "blocks")
    # Pairs of blocks: each is listed in the cells, as wide as the reach, that it touches; the right one also in the next cell.
    cell = lambda c: F.floor(F.col(c) / reach)
    spans = packed.drop("rows")
    left = spans.withColumn("at", F.explode(F.sequence(cell("lo0"), cell("hi0"))))
    right = spans.select("label", "d", F.col("block").alias("block2"), *(F.col(c).alias(f"{c}_") for c in spans.columns[3:])).withColumn("at", F.explode(F.sequence(cell("lo0_") - 1, cell("hi0_"))))
    gaps = [F.pow(F.greatest(F.lit(0.0), F.col(f"lo{i}_") - F.col(f"hi{i}"), F.col(f"lo{i}") - F.col(f"hi{i}_")), F.lit(2.0)) for i in range(LEAD)]
    pairs = left.join(right, ["label", "d", "at"]).where("block <= block2").where(sum(gaps[1:], gaps[0]) <= reach**2 + 1e-9).select("label", "d", "block", "block2").distinct()
    both = pairs.join(packed.select("label", "d", "block", F.col("rows").alias("one")), ["label", "d", "block"])
    alone = both.where("block = block2").withColumn("two", F.lit(None).cast(both.schema["one"].dataType))
    both = both.where("block < block2").join(packed.select("label", "d", F.col("block").alias("block2"), F.col("rows").alias("two")), ["label", "d", "block2"])

    def side(cell: pa.Scalar, d: int) -> tuple[np.ndarray, np.ndarray, Side]:
        inner = cell.values
        slot, key, copies = (inner.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        raw = np.frombuffer(b"".join(inner.field(3).to_pylist()), dtype=kind).reshape(-1, d).astype(np.float64)
        order = np.lexsort((key, slot))
        return key[order], copies[order], Side(raw[order], turn.value.get(d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                d = batch.column(0)[at].as_py()
                key, weight, a = side(batch.column(1)[at], d)
                if batch.column(2)[at].is_valid:
                    key_b, weight_b, b = side(batch.column(2)[at], d)
                    i, j = linked(a, b, t, tile)
                    j = j + len(key)
                    key, weight = np.concatenate([key, key_b]), np.concatenate([weight, weight_b])
                else:
                    i, j = linked(a, None, t, tile)
                n = np.bincount(i, weight[j], len(key)) + np.bincount(j, weight[i], len(key))
                root = roots(len(key), i, j)
                met = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(key[met]), pa.array(key[root[met]]), pa.array(n[met].astype(np.int64))], names=["a", "b", "n"])

    compared = [x.select("d", "one", "two").mapInArrow(run, "a long, b long, n long") for x in (alone, both)]
    return compared[0].unionByName(compared[1])


def near_duplicates(embeddings: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    spark = embeddings.sparkSession
    short_batches(spark)
    narrow = embeddings.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = np.dtype("<f4" if narrow else "<f8")
    rows = embeddings.select("vec_id", "label", F.when(sound() & F.col("label").isNotNull(), F.col("embedding").cast("array<float>" if narrow else "array<double>")).alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [None if not x.is_valid else x.values.to_numpy(zero_copy_only=False).astype(kind).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["vec_id", "label", "v"])

    of_id, of_label = (embeddings.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    rows = rows.mapInArrow(packed, f"vec_id {of_id}, label {of_label}, v binary").withColumn("uid", F.monotonically_increasing_id())
    # Equal vectors of a label have one name; null for those that link with nothing.
    name = F.when(F.col("v").isNotNull(), F.sha2(F.concat(F.col("v"), F.lit(":"), F.col("label").cast("string").cast("binary")), 256))
    rows = materialise(rows.withColumn("name", name), "vectors")
    groups = rows.where("name is not null").groupBy("name").agg(F.min("uid").alias("key"), F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.min(F.struct("label", "v")).alias("of"))
    groups = groups.select("name", "key", "least", "copies", "of.label", "of.v", (F.octet_length("of.v") / kind.itemsize).cast("int").alias("d"))
    groups = materialise(groups, "groups")
    if groups.isEmpty():
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    pairs = materialise(links(groups.drop("name", "least"), kind, t), "links")
    others = pairs.groupBy("a").agg(F.sum("n").alias("others"))
    label = connected_components(pairs)
    named = groups.select("name", "key", "least", "copies").join(label, F.col("key") == F.col("node"), "left").withColumn("component", F.coalesce("component", "key"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").join(others, F.col("key") == F.col("a"), "left")
    found = named.select("name", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component_id", "copies")
    out = joined_by_count(rows.select("vec_id", "name"), materialise(found, "found"), "name", "copies", rows.count(), "left")
    component = F.when(F.col("name").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
