"""Periodic runs of words by bit-parallel lags.

A run is a stretch of words with a smallest period q that is at least ``LEAST`` words and ``TIMES`` periods long and that
no neighbouring word extends. A document's words are numbered and the numbers cut into bit planes, each one big integer
with a bit a word. For a lag q the planes are XORed with themselves shifted by q and the results ORed: what stays zero are
words that are equal q apart. Zero stretches that are long enough are isolated by ANDing their complement with itself
shifted by 1, 2, 4, ... words; the ends of what is left are the ends of runs. A stretch whose period is a proper multiple of its
smallest one is told by the prime factors of q: it has period q / f for one of them.

Lags from ``SPARSE`` on are tried only where a run could be: a run holds, at a multiple of 2 q, a block of ``SPARSE``
words that stands again q words later. All such places of a document, n log n of them, are compared at once by rolling
hashes, and planes are cut to where hits are. A place within a known run whose period divides q can't begin another one.
So nothing is lost, and the work of a long text doesn't grow with the square of its words unless most lags match.

Scale: a document is one row in and one row out; there is no shuffle and nothing is kept. Memory a word: four bytes for its
number and the planes' bits, besides the text and its distinct words; long texts are split in steps.

Null text: no words, no runs. Very long texts are processed whole. Null doc_ids and repeated rows are rows of their own.
Ties of the longest run go to the smallest start, then period. Other columns are ignored, but for those named in ``keep``.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievewright.llm.common import byte_texts, short_batches, tidy, word_steps

LEAST, TIMES = 6, 4
#: Lags below this are tried everywhere; it is also the number of words of a block that must stand again.
SPARSE = 8
#: Places compared at once.
PLACES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def numbered(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word of a text, and the words by number."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    parts = [np.fromiter((known[w] for w in words), dtype=np.int32, count=len(words)) for words in word_steps(text)]
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)), list(known)


def planes(ids: np.ndarray) -> list[int]:
    """Bit planes of the numbers; bit i of a plane belongs to word i."""
    top = int(ids.max()) if len(ids) else 0
    return [int.from_bytes(np.packbits((ids >> b & 1).astype(np.uint8), bitorder="little").tobytes(), "little") for b in range(max(1, top.bit_length()))]


def _bits(x: int) -> np.ndarray:
    """Where bits are set, in order."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(x.to_bytes((x.bit_length() + 7) // 8, "little"), dtype=np.uint8), bitorder="little"))


def zero_stretches(cut: list[int], n: int, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches [i, j) of at least ``least`` words i of n that equal the word q later."""
    full = (1 << n - q) - 1
    differs = 0
    for plane in cut:
        differs |= plane ^ plane >> q
    equal = ~differs & full
    have = 1
    while have < least and equal:
        step = min(have, least - have)
        equal &= equal >> step
        have += step
    if not equal:
        return _NONE, _NONE
    return _bits(equal & ~(equal << 1)), _bits(equal & ~(equal >> 1)) + least


_NONE = np.zeros(0, dtype=np.int64)


def _prime_factors(q: int) -> list[int]:
    out, f = [], 2
    while f * f <= q:
        if q % f == 0:
            out.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return [*out, q] if q > 1 else out


def _hits(ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) for lags SPARSE to ``top``: the blocks at multiples of twice the lag that stand again a lag later."""
    n = len(ids)
    if top < SPARSE:
        return _NONE, _NONE
    h, width = ids.astype(np.uint64), 1
    while width < SPARSE:  # hashes of 2, 4, ... neighbouring words
        h = h[:-width] * _ODD + (h[width:] ^ h[width:] >> np.uint64(29))
        width *= 2
    lags, places = [], []
    q = np.arange(SPARSE, top + 1)
    count = np.maximum(0, (n - q - SPARSE) // (2 * q) + 1)
    ends = np.cumsum(count)
    a = 0
    while a < len(q):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PLACES, "right")))
        lag = np.repeat(q[a:b], count[a:b])
        place = (np.arange(len(lag)) - np.repeat(ends[a:b] - count[a:b] - (ends[a - 1] if a else 0), count[a:b])) * 2 * lag
        same = h[place] == h[place + lag]
        lags.append(lag[same])
        places.append(place[same])
        a = b
    return np.concatenate(lags), np.concatenate(places)


def runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n, found = len(ids), []
    if n < least:
        return found
    top = n // times
    whole = planes(ids)
    # For each word, the end and the period of one run that holds it, of those known so far.
    end, period = np.zeros(n, dtype=np.int64), np.ones(n, dtype=np.int64)

    def take(lo: int, hi: int, q: int) -> None:
        cut = whole if lo == 0 and hi == n else [plane >> lo & (1 << hi - lo) - 1 for plane in whole]
        for i, j in zip(*(x.tolist() for x in zero_stretches(cut, hi - lo, q, max(least, times * q) - q)), strict=True):
            i, j = lo + i, lo + j + q
            if any((ids[i : j - q // f] == ids[i + q // f : j]).all() for f in _prime_factors(q)):
                continue
            found.append((i, j - i, q))
            free = end[i:j] < j
            end[i:j][free], period[i:j][free] = j, q

    for q in range(1, min(SPARSE - 1, top) + 1):
        take(0, n, q)
    lags, places = _hits(ids, top)
    at = np.append(np.flatnonzero(np.append(True, lags[1:] != lags[:-1])), len(lags)) if len(lags) else _NONE
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        q, where = int(lags[a]), places[a:b]
        where = where[(end[where] < where + q) | (q % period[where] != 0)]
        if not len(where):
            continue
        cuts = np.flatnonzero(np.diff(where) > 2 * q) + 1
        groups = np.split(where, cuts) if len(cuts) < 16 else [where]
        for group in groups:
            take(max(0, int(group[0]) - 2 * q), min(n, int(group[-1]) + 3 * q + SPARSE), q)
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when each run is cut to its first period."""
    depth = np.zeros(n + 1, dtype=np.int64)
    for start, length, q in found:
        depth[start + q] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def collapsed_sha256(ids: np.ndarray, words: list[bytes], step: int = 1 << 16) -> str:
    """Hex SHA-256 of the words joined by one space."""
    digest = hashlib.sha256()
    for a in range(0, len(ids), step):
        digest.update((b" " if a else b"") + b" ".join([words[i] for i in ids[a : a + step].tolist()]))
    return digest.hexdigest()


_OUT = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")] + [(c, pa.string()) for c in ("runs_sha256", "collapsed_sha256")])

#: What a document's numbered words are before runs are looked for: (doc_id, ids) to ids.
Rewrite = Callable[[int | None, np.ndarray], np.ndarray]


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """One row a document: doc_id, n_runs, the longest run (start, length, period, exponent_milli) and digests.

    runs_sha256 is of every run's ``start,length,period`` and a line feed, collapsed_sha256 of the words that stay.
    ``rewrite`` changes the words of a document first, for planting repetitions.
    """
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                ids, words = numbered(text or b"")
                ids = rewrite(doc_id, ids) if rewrite else ids
                found = runs(ids)
                start, length, q = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                listed = hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in found).encode()).hexdigest()
                rows.append((doc_id, len(found), start, length, q, 1000 * length // q if q else None, listed, collapsed_sha256(ids[kept(len(ids), found)], words)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)] if rows else [pa.array([], f.type) for f in _OUT], schema=_OUT)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
