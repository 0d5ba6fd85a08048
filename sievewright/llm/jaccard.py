"""Near-duplicates for the pipeline: SimHash groups and MinHash bands, verified by exact Jaccard similarity.

A text is the set of the XXH64 values of its 5-word shingles (A-Z in lower case, words between white space; a text of
fewer words is one shingle). Candidates are texts whose SimHash fingerprints, voted by that set, the SimHash operator puts
in one component by its Golay-code keys (links at two bits or fewer), and texts that share a MinHash band. Two candidates
are linked if the Jaccard similarity of their sets, computed from the texts, is 0.8 or more; links join them into
components. SimHash alone would not do: at a similarity of 0.8 to 0.95 fingerprints differ in 6 to 14 bits of 64 (measured
on the test documents, none in two or fewer). Of 20 bands of 4 minima, a pair at 0.8 shares none with a chance of 0.00003,
at 0.9 with less than 1e-9; no other pair is left out.

Scale: equal sets are one node from the start. Every member of a bucket is first compared with the bucket's hub, the node
that meets most others over all its buckets. Bands that hubs leave in several components are compared in whole, in
blocks, by counts of shared hashes; a block emits a spanning forest of its links, never its pairs. That work grows with
the square of such a bucket; equal texts and buckets that a hub joins cost their size. Only texts that share a bucket
with another are moved. Frequent keys are joined by broadcast.

Null and wordless texts are one node. Null doc_ids link like others and have the component of their equals; a component
of null ids alone is null. Very long texts are hashed whole. Ties: a similarity of exactly 0.8 links. Repeated rows give
repeated results. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm import simhash
from sievewright.llm.common import byte_texts, joined_by_count, materialise, short_batches, tidy
from sievewright.llm.components import connected_components

SHINGLE, SEED, BANDS, MINIMA = 5, 42, 20, 4
#: Least similarity, as numerator and denominator.
LEAST = (4, 5)
#: Members of a bucket that are compared in one task; its tables grow with the square.
BLOCK = 500
_RANDOM = np.random.default_rng(SEED)
_TIMES = _RANDOM.integers(0, 1 << 63, BANDS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, BANDS * MINIMA, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, k: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n = len(words) - k + 1
    return np.unique(np.fromiter((digest(joined[starts[i] : ends[i + k - 1] - 1], seed) for i in range(n)), dtype=np.uint64, count=n))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key a band, from the minima of the set under each of the band's hash functions."""
    least = np.full(BANDS * MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 4096):
        v = hashes[at : at + 4096, None] * _TIMES + _PLUS
        least = np.minimum(least, (v ^ v >> np.uint64(32)).min(axis=0) if len(v) else least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for column in least.reshape(BANDS, MINIMA).T:
        key = (key ^ column) * _MIX
        key ^= key >> np.uint64(29)
    return key


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of at least LEAST; two empty sets are alike."""
    small, large = sorted((len(a), len(b)))
    if small * LEAST[1] < large * LEAST[0]:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * LEAST[1] >= (small + large - both) * LEAST[0]


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, keys, fp): node names the set of shingles, fp is its SimHash fingerprint."""
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            nodes, keys, fps = [], [], []
            for text in byte_texts(batch.column(1)):
                hashes = shingles(text or b"")
                nodes.append(xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED) if len(hashes) else 0)
                keys.append(band_keys(hashes).view(np.int64) if len(hashes) else [])
                fps.append(simhash.voted([hashes]) if len(hashes) else 0)
            longs = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (nodes, fps)]
            columns = [batch.column(0), batch.column(2), longs[0], pa.array(keys, pa.list_(pa.int64())), longs[1]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "node", "keys", "fp"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, node long, keys array<long>, fp long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        last, sets = None, None
        for batch in batches:
            good = []
            ids, left, right = batch.column(0).to_pylist(), batch.column(2), batch.column(3)
            for i, node in enumerate(ids):
                if node != last:
                    last, sets = node, shingles(left[i].as_py().encode())
                good.append(alike(sets, shingles(right[i].as_py().encode())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): links between nodes, enough of them to give the components. ``nodes``: node, first (doc_id, text_hash), keys."""
    groups = materialise(simhash.components(nodes.select("fp").distinct()), "jaccard-simhash")
    grouped = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("node", F.xxhash64(F.lit("simhash"), F.coalesce("component", "fp")).alias("key"), F.lit(False).alias("band"))
    keys = materialise(nodes.select("node", F.explode("keys").alias("key"), F.lit(True).alias("band")).unionByName(grouped), "jaccard-all-keys")
    shared = materialise(keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").withColumn("n", F.col("m")), "jaccard-shared")
    rows = materialise(joined_by_count(keys, shared, "key", "n", keys.count()), "jaccard-keys")
    weight = rows.groupBy("node").agg(F.sum("m").alias("w"))
    met = nodes.join(weight, "node").select("node", F.col("first.doc_id").alias("of_id"), F.col("first.text_hash").alias("of_hash"))
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(met, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash")))
    texts = materialise(found.select("node", "text").dropDuplicates(["node"]), "jaccard-texts")

    hubs = rows.join(weight, "node").groupBy("key").agg(F.max(F.struct("w", "node"))["node"].alias("hub"))
    stars = rows.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    first = materialise(verified(stars, texts), "jaccard-links")

    label = connected_components(first).withColumnRenamed("node", "of")
    named = rows.where("band").join(label, F.col("node") == F.col("of"), "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    several = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members")).where("lo < hi").select("key", "members")
    left = materialise(named.join(several, "key"), "jaccard-left")
    sets = materialise(hashed(texts.join(left.select("node").distinct(), "node")), "jaccard-sets")
    return first.unionByName(materialise(compared(left, sets), "jaccard-links"))


def hashed(texts: DataFrame) -> DataFrame:
    """(node, hashes): the set of each text, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            sets = [shingles(text).tobytes() for text in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "hashes"])

    return texts.select("node", "text").mapInArrow(run, "node long, hashes binary")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many members every two of the sets share."""
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    met = count[column] > 1
    row, column = row[met], np.unique(column[met], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, (at, at + 4096))
        cells = np.zeros((len(sets), 4096), dtype=np.float32)
        cells[row[lo:hi], column[lo:hi] - at] = 1
        out += cells @ cells.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out.astype(np.int64)


def joining(nodes: list[int], components: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between alike nodes of different components, enough of them to join all components that links join."""
    both, size = shared_counts(sets), np.array([len(s) for s in sets])
    label, out = np.unique(components, return_inverse=True)[1], []
    near = both * LEAST[1] >= (size[:, None] + size - both) * LEAST[0]
    for i in range(len(nodes)):
        for j in np.flatnonzero(near[i] & (label != label[i])).tolist():
            if label[j] != label[i]:
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return out


def compared(left: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links within buckets (key, node, component, members), by exact similarity of all pairs.

    A bucket of more than ``block`` members is cut into blocks; each two of them meet in a task of their own.
    """

    def run(group: pa.Table) -> pa.Table:
        tidy()
        found = joining(group["node"].to_pylist(), group["component"].to_pylist(), [np.frombuffer(h, dtype=np.uint64) for h in group["hashes"].to_pylist()])
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    blocks = F.ceil(F.col("members") / block).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pairs = F.when(blocks == 1, F.array(F.lit("0"))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0), blocks - 1), lambda x: x != mine), lambda x: F.concat_ws(":", F.least(x, mine), F.greatest(x, mine)))
    )
    dealt = left.select("key", "node", "component", F.explode(pairs).alias("pair")).join(sets, "node")
    return dealt.groupBy("key", "pair").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, component_id (the smallest doc_id its links reach)."""
    rows = materialise(signatures(docs), "jaccard-signatures")
    nodes = materialise(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("keys").alias("keys"), F.first("fp").alias("fp"), F.count("*").alias("rows")), "jaccard-nodes")
    label = connected_components(links(nodes, docs)).withColumnRenamed("node", "of")
    named = nodes.select("node", "least", "rows").join(label, F.col("node") == F.col("of"), "left").select("node", "least", "rows", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialise(named.join(least, "component").select("node", "component_id", "rows"), "jaccard-named")
    return joined_by_count(rows.select("doc_id", "node"), named, "node", "rows", rows.count()).select("doc_id", "component_id")
