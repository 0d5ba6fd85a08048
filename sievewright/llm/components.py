"""Connected components of an edge table: forests of each task, then alternating large-star and small-star rounds.

Every task first replaces the edges that it holds, ``HELD`` at a time, by a star for each of their components, which
leaves few rounds to do. Every round is two aggregations and two joins on node ids; no adjacency list is ever collected.
A hub, a node with more than a few thousandths of a percent of all edges, is joined by broadcast, so its edges stay
spread over their tasks; there are few such nodes by arithmetic (:func:`joined_by_count`). The label of a component is its
smallest node. Rounds are written to the shared folder, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import joined_by_count, materialise

#: Edges that a task reduces at once.
HELD = 1_000_000


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches by the links (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        # The label's own node learns of the lower label too, so chains shorten by halves.
        for at in (i, j, label[i], label[j]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of the components of what a task holds: (u, v), v the smallest node."""

    def stars(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        u, v = (np.concatenate(c) for c in zip(*held, strict=True))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = roots(len(nodes), at[: len(u)], at[len(u) :])
        far = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], names=["u", "v"])

    held, n = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n >= HELD:
            yield stars(held)
            held, n = [], 0
    if held:
        yield stars(held)


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"] or 0


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; nodes without edges are their own component and not listed.

    Edges are undirected; repeated edges, loops and nulls are harmless. An empty edge table gives an empty result.
    """
    at = F.greatest(F.col(a), F.col(b))
    to = F.least(F.col(a), F.col(b))
    stars = materialise(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(at.cast("long").alias("u"), to.cast("long").alias("v")).distinct().mapInArrow(_forest, "u long, v long").distinct(),
        "edges",
    )
    before = _mark(stars)
    while before[0]:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = joined_by_count(both.where("v > u"), least, "u", "n", 2 * before[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large")
        root = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        # A node whose neighbours all have one least neighbour adds nothing to the second join.
        several = root.where("n > 1")
        stars = root.select("u", F.col("m").alias("v"))
        if not several.isEmpty():
            small = joined_by_count(large, several, "u", "n", before[0]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            stars = materialise(small.union(stars).distinct(), "stars")
        after = _mark(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
