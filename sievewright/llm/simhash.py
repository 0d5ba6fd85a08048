"""SimHash near-duplicates with Golay-code fuzzy hashing.

Fingerprints are 64 bits voted by the XXH64 values of 3-word shingles. The 64 bits are cut into segments of 22, 21 and
21 bits. If two fingerprints differ in two bits or fewer, pigeonhole leaves one segment without error, and the next
segment (cyclically) has two errors at most. A segment, padded to 23 bits, is decoded by the perfect binary Golay
code: its keys are the indices of all codewords within distance 4, which are one codeword if the nearest is at
distance 2 or less and six otherwise; two words at distance 2 or less always share one. A join key is thus an exact
segment and a codeword index of the next one, 33 or 34 bits, about sixteen keys a fingerprint. Fingerprints that share
a key are compared; links join them into components.

Scale: equal fingerprints are one row from the start, so groups of copies cost one aggregation. Keys that only one
fingerprint has are dropped by a pre-aggregated count. A key that more than ``BUCKET`` fingerprints share is refined:
its other 42 bits are cut into six parts of seven bits, of which four have no error, and each choice of four is a key
of its own; such a key leaves 15 bits open and so holds 32,768 fingerprints at most, whatever the data. (Refined keys are
plain pigeonhole keys beside the Golay index, which a crowded key has used up; the links are the same.) A bucket emits
a spanning forest of its links, never its pairs. Frequent keys and fingerprints are joined by broadcast.

Very long texts are hashed whole, in steps. Ties: a bit set in exactly half of the hashes is 0.

Null and wordless texts have fingerprint 0 and link like others. Null doc_ids get a fingerprint and the component of
their equals; a component of null ids alone is null. Repeated rows give repeated results. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import byte_texts, joined_by_count, materialise, short_batches, tidy
from sievewright.llm.components import connected_components

SHINGLE, SEED, DISTANCE, BUCKET = 3, 42, 2, 1000
#: First bit (from the right) and width of each segment.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
_BITS = np.array([[v >> b & 1 for b in range(8)] for v in range(256)], dtype=np.int64)


def fingerprint(text: bytes, k: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of a whole text (UTF-8): A-Z in lower case, words between white space, k-word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n, digest = len(words) - k + 1, xxhash.xxh64_intdigest
    steps = (range(at, min(at + (1 << 16), n)) for at in range(0, n, 1 << 16))
    return voted(np.fromiter((digest(joined[starts[i] : ends[i + k - 1] - 1], seed) for i in some), dtype="<u8", count=len(some)) for some in steps)


def voted(parts: Iterable[np.ndarray]) -> int:
    """The fingerprint of hashes that come in parts: a bit is 1 if it is set in over half of them."""
    n, votes = 0, np.zeros((8, 256), dtype=np.int64)
    for h in parts:
        cells = h.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(8) * 256
        votes += np.bincount(cells.ravel(), minlength=2048).reshape(8, 256)
        n += len(h)
    ones = (votes @ _BITS).ravel()
    return sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            fps = np.array([fingerprint(t or b"") for t in byte_texts(batch.column(1))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
_GENERATOR = 0b101011100011


def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(syndromes of the high 12 bits, error patterns by syndrome, how many): all patterns of weight 4 or less."""
    unit = [_syndrome(1 << b) for b in range(23)]
    high = np.zeros(4096, dtype=np.uint32)
    for v in range(4096):
        for b in range(12):
            if v >> b & 1:
                high[v] ^= unit[11 + b]
    patterns, count = np.zeros((2048, 6), dtype=np.uint32), np.zeros(2048, dtype=np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = 0
            for b in bits:
                s ^= unit[b]
            patterns[s, count[s]] = sum(1 << b for b in bits)
            count[s] += 1
    return high, patterns, count


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): the indices of all codewords within distance 4 of each 23-bit word."""
    high, patterns, count = golay()
    words = words.astype(np.uint32)
    s = high[words >> 11] ^ (words & 2047)
    row = np.repeat(np.arange(len(words)), count[s])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count[s]) - count[s], count[s])
    return row, (words[row] ^ patterns[s[row], nth]) >> 11


def join_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of unsigned fingerprints."""
    part = [fps >> np.uint64(at) & np.uint64((1 << width) - 1) for at, width in SEGMENTS]
    rows, keys = [], []
    for i, exact in enumerate(part):
        row, index = golay_keys(part[(i + 1) % 3])
        rows.append(row)
        keys.append((np.uint64(i) << np.uint64(34) | exact[row] << np.uint64(12) | index.astype(np.uint64)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(keys)


def refined_keys(fps: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, refined key) for fingerprints of a crowded key: the exact segment and four of the other 42 bits' six parts."""
    u, rows, out = fps.view(np.uint64), [], []
    for i, (at, width) in enumerate(SEGMENTS):
        row = np.flatnonzero(keys >> 34 == i)
        v = u[row]
        low = v & np.uint64((1 << at) - 1)
        rest = v >> np.uint64(at + width) << np.uint64(at) | low if at + width < 64 else low
        exact = v >> np.uint64(at) & np.uint64((1 << width) - 1)
        sevens = [rest >> np.uint64(7 * j) & np.uint64(127) for j in range(6)]
        for c, four in enumerate(combinations(range(6), 4)):
            key = np.full(len(row), i * 15 + c, dtype=np.uint64)
            key = key << np.uint64(22) | exact
            for j in four:
                key = key << np.uint64(7) | sevens[j]
            rows.append(row)
            out.append(key)
    return np.concatenate(rows), np.concatenate(out).view(np.int64)


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within a bucket (unsigned fingerprints), as index pairs."""
    if len(fps) == 2:
        return [(0, 1)] if int(fps[0] ^ fps[1]).bit_count() <= distance else []
    links, free = [], np.arange(len(fps))
    while len(free):
        stack, free = [int(free[0])], free[1:]
        while stack and len(free):
            at = stack.pop()
            near = np.bitwise_count(fps[free] ^ fps[at]) <= distance
            found = free[near].tolist()
            links += [(at, x) for x in found]
            stack += found
            free = free[~near]
    return links


def _exploded(make, *names: str):
    """Arrow function: ``make`` gives (row, key) for the columns of a batch; the first column is repeated by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 50_000):
                columns = [c.slice(a, 50_000).to_numpy(zero_copy_only=False) for c in batch.columns]
                row, key = make(*columns)
                yield pa.RecordBatch.from_arrays([pa.array(columns[0][row]), pa.array(key)], names=list(names))

    return run


def links(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp), enough of them to give the components."""
    if distance > 2:
        raise ValueError("the keys are right for two differing bits at most")
    keys = materialise(distinct.select("fp").mapInArrow(_exploded(lambda fp: join_keys(fp.view(np.uint64)), "fp", "key"), "fp long, key long"), "simhash-all-keys")
    shared = materialise(keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").withColumn("n", F.col("m")), "simhash-shared")
    rows = materialise(joined_by_count(keys, shared, "key", "n", keys.count()), "simhash-keys")
    crowded = rows.where(F.col("m") > bucket).select("fp", "key").mapInArrow(_exploded(refined_keys, "fp", "key"), "fp long, key long").distinct()
    buckets = rows.where(F.col("m") <= bucket).select("key", "fp").groupBy("key").agg(F.collect_list("fp").alias("fps")).unionByName(crowded.groupBy("key").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            a, b = [], []
            for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                fps = values[lo:hi]
                for x, y in forest(fps, distance):
                    a.append(fps[x])
                    b.append(fps[y])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (a, b)], names=["a", "b"])

    return buckets.select("fps").mapInArrow(run, "a long, b long").distinct()


def components(distinct: DataFrame) -> DataFrame:
    """(node, component) of fingerprints (column fp) that have a link; others are not listed."""
    return connected_components(links(distinct))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, fp (signed), component_id (the smallest doc_id its links reach)."""
    fps = materialise(fingerprints(docs), "fingerprints")
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct")
    label = components(distinct)
    named = distinct.join(label, F.col("fp") == F.col("node"), "left").select("fp", "least", "n", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialise(named.join(least, "component").select("fp", "component_id", "n"), "named")
    return joined_by_count(fps, named, "fp", "n", fps.count()).select("doc_id", "fp", "component_id")
