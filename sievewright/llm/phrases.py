"""Substring deduplication with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. A word is removed if a window over it also starts in a
document with a smaller doc_id. The work goes in five steps:

1. Copies. Of documents with equal texts (equal SHA-256) only the first goes on; a later copy loses every word that a
   window covers, which needs no search.
2. Anchors. The anchor of a window is the smallest hash among its ``GRAM``-word grams, so equal windows have equal
   anchors. Each document emits its distinct anchors (about one for five words); anchors of one text only are dropped.
3. Confirming. Documents with recurring anchors emit, for each run of windows with the same recurring anchor, the words
   of the run (a segment). Window hashes of all segments are counted in the JVM, pre-aggregated, with the smallest
   doc_id that each starts in; those of several documents are confirmed.
4. Automata. Confirmed windows are dealt to shards by anchor. Runs of them that have one first document are passages;
   the distinct passages of a shard are compiled, as words, into one Aho-Corasick automaton (pyahocorasick, integer
   sequences; words are numbered exactly). All segments of the shard stream through it, equal ones once: the automaton,
   which compares words, locates every occurrence and gives the smallest doc_id of its windows.
5. Removal. Runs of located windows go back to their documents, which drop the covered words.

Scale: shards hold about ``SHARD`` segments. Anchors that are frequent in a sample of the texts (a boilerplate line, a
large group of near copies; at most ``HOT`` of them by arithmetic) are dealt over as many shards as their segments fill,
each with a copy of the anchor's confirmed windows; they are counted by pre-aggregation and joined as a broadcast table.
The sample only says which anchors take that way; the result is the same whatever it holds. No task holds a hot passage
whole. Texts are shuffled twice, compressed: to meet their recurring anchors, and to drop words.

Hashes of 64 bits name windows and texts while they are counted. Two different windows of the corpus with one hash, which
happens with a chance of 2^-64 a pair, would count as one; what is located is compared by words.

Null text: no words. Fewer than ``WINDOW`` words: nothing is removed. A very long text is processed whole; its segments
hold at most ``LONGEST`` windows each. A document with a null doc_id takes no part: its words stay and remove nothing.
Rows that repeat a doc_id are no duplicates of each other (no smaller doc_id), and are told apart by a hash of their text.
Ties: an occurrence in the smallest doc_id stays wherever in that document it stands. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import byte_texts, joined_by_count, materialise, short_batches, slices, tidy

WINDOW, GRAM, SHARD = 13, 5, 10_000
#: Most windows of a segment; most anchors that count as hot; one text in so many is looked at to find them.
LONGEST, HOT, SAMPLE = 64, 20_000, 64
#: The end of a run that covers a whole document.
WHOLE = 2_000_000_000
_MULTIPLIERS = (np.random.default_rng(11).integers(0, 1 << 62, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def _mixed(g: np.ndarray) -> np.ndarray:
    g ^= g >> np.uint64(29)
    g *= np.uint64(0x9E3779B97F4A7C15)
    g ^= g >> np.uint64(32)
    return g


def _grams(h: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram`` neighbouring word hashes."""
    n = max(0, len(h) - gram + 1)
    g = np.zeros(n, dtype=np.uint64)
    for j in range(gram):
        g += h[j : j + n] * _MULTIPLIERS[j]
    return _mixed(g)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def anchors(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The anchor of each window (signed 64 bits)."""
    if len(words) < window:
        return np.zeros(0, dtype=np.int64)
    g = _grams(word_hashes(words), gram)
    width, have = window - gram + 1, 1
    while have < width:  # smallest of `have` neighbours, doubled while it fits
        step = min(have, width - have)
        g = np.minimum(g[:-step], g[step:])
        have += step
    return g.view(np.int64)


def _edges(a: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, dtype=np.int64)


def _emit_anchors(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for batch in batches:
            hashes, found, held = [], [], 0
            for th, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                a = anchors((text or b"").split(), window, gram)
                if len(a):
                    a = np.unique(a[_edges(a)])
                    hashes.append(np.full(len(a), th, dtype=np.int64))
                    found.append(a)
                    held += len(a)
                if held > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(hashes))], names=["anchor", "th"])
                    hashes, found, held = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(hashes))], names=["anchor", "th"])

    return run


_SEGMENT = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("at", pa.int32()), ("words", pa.binary())])


def _emit_segments(window: int, gram: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            held = 0
            for doc, th, packed, shared in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                words = unpack(packed).split()
                a = anchors(words, window, gram)
                edge = _edges(a)
                hit = np.isin(a[edge], shared.values.to_numpy())
                for lo, hi in zip(edge[hit].tolist(), np.append(edge[1:], len(a))[hit].tolist(), strict=True):
                    for at in range(lo, hi, longest):
                        segment = b" ".join(words[at : min(at + longest, hi) + window - 1])
                        for column, value in zip(out, (int(a[lo]), doc, th, at, segment), strict=True):
                            column.append(value)
                        held += len(segment)
                    if held > 1 << 23:
                        yield _batch(out)
                        out, held = [[], [], [], [], []], 0
            if out[0]:
                yield _batch(out)

    return run


def _batch(out: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _SEGMENT, strict=True)], schema=_SEGMENT)


def _layout(segments: list[bytes], window: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """(words of each segment, segment of each window, place of each window's first word among all words)."""
    split = [s.split(b" ") for s in segments]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    windows = np.maximum(sizes - window + 1, 0)
    of = np.repeat(np.arange(len(split)), windows)
    place = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows) + (np.cumsum(sizes) - sizes)[of]
    return split, of, place


def _emit_windows(window: int):
    """(hash, doc_id, dealt) of every window of segments (words, doc_id, dealt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(0)).to_numpy()):
                part = batch.slice(a, b - a)
                split, of, place = _layout(part.column(0).to_pylist(), window)
                found = _grams(word_hashes([w for words in split for w in words]), window)[place]
                docs, dealt = (part.column(i).to_numpy(zero_copy_only=False)[of] for i in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(docs), pa.array(dealt)], names=["hash", "doc_id", "dealt"])

    return run


class PhraseAutomaton:
    """Aho-Corasick automaton of passages over numbered words; each has the smallest doc_id that its windows start in."""

    def __init__(self) -> None:
        import ahocorasick

        self.passages: dict[tuple[int, ...], int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)

    def occurrences(self, sequence: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, smallest doc_id) of every passage in a sequence."""
        if not self.passages:
            return (np.zeros(0, dtype=np.int64),) * 3
        for i, passage in enumerate(self.passages):
            self.automaton.add_word(passage, i)
        self.automaton.make_automaton()
        found = np.array(list(self.automaton.iter(sequence)), dtype=np.int64).reshape(-1, 2)
        sizes = np.fromiter(map(len, self.passages), dtype=np.int64, count=len(self.passages))
        first = np.fromiter(self.passages.values(), dtype=np.int64, count=len(self.passages))
        end = found[:, 0] + 1
        return end - sizes[found[:, 1]], end, first[found[:, 1]]


_RUN = "doc_id long, th long, a int, b int"


def _shard(window: int):
    """Compile the confirmed passages of a shard and stream its segments, equal ones once."""

    def run(rows: pd.DataFrame, confirmed: pd.DataFrame) -> pd.DataFrame:
        code, segments = pd.factorize(rows["words"])
        split, of, place = _layout(segments.tolist(), window)
        numbers: dict[bytes, int] = {}
        sequence = tuple([numbers.setdefault(w, len(numbers)) for words in split for w in words])
        begins = np.cumsum([0, *map(len, split)])
        machine = PhraseAutomaton()
        known, first = confirmed["hash"].to_numpy(dtype=np.int64), confirmed["first"].to_numpy(dtype=np.int64)
        if len(known) and len(place):
            # A passage is a run of confirmed windows with one first document, as words of a segment.
            order = np.argsort(known)
            known, first = known[order], first[order]
            hashes = _grams(word_hashes(list(numbers))[np.array(sequence, dtype=np.int64)], window)[place].view(np.int64)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            met = np.flatnonzero(known[at] == hashes)
            low = first[at[met]]
            fresh = np.flatnonzero(np.append(True, (met[1:] != met[:-1] + 1) | (of[met[1:]] != of[met[:-1]]) | (low[1:] != low[:-1]))) if len(met) else met
            last = np.append(fresh[1:], len(met)) - 1 if len(met) else met
            for i, j, doc in zip(place[met[fresh]].tolist(), place[met[last]].tolist(), low[fresh].tolist(), strict=True):
                machine.passages[sequence[i : j + window]] = doc
        start, end, low = machine.occurrences(sequence)
        segment = np.searchsorted(begins, start, side="right") - 1
        inside = end <= begins[segment + 1]  # a match that runs over the end of a segment is none
        start, end, low, segment = start[inside], end[inside], low[inside], segment[inside]
        # Each occurrence in a segment is one in all rows of it.
        order = np.argsort(code, kind="stable")
        copies = np.bincount(code, minlength=len(split))
        n = copies[segment]
        hit = np.repeat(np.arange(len(start)), n)
        row = order[np.repeat((np.cumsum(copies) - copies)[segment] - (np.cumsum(n) - n), n) + np.arange(len(hit))]
        docs = rows["doc_id"].to_numpy(dtype=np.int64)
        good = low[hit] < docs[row]
        hit, row = hit[good], row[good]
        shift = rows["at"].to_numpy(dtype=np.int64)[row] - begins[segment[hit]]
        a, b = start[hit] + shift, end[hit] - (window - 1) + shift
        # Occurrences that meet or overlap become one run.
        order = np.lexsort((a, row))
        row, a, b = row[order], a[order], b[order]
        far = int(b.max()) + 2 if len(b) else 1
        reach = np.maximum.accumulate(row * far + b) if len(b) else b
        fresh = np.flatnonzero(np.append(True, (row[1:] * far + a[1:]) > reach[:-1])) if len(a) else np.zeros(0, dtype=np.int64)
        last = np.append(fresh[1:], len(a)) - 1 if len(a) else fresh
        row = row[fresh]
        return pd.DataFrame({"doc_id": docs[row], "th": rows["th"].to_numpy(dtype=np.int64)[row], "a": a[fresh].astype(np.int32), "b": (reach[last] - row * far).astype(np.int32)})

    return run


def _packed(texts: DataFrame) -> DataFrame:
    """(doc_id, th, z): texts compressed, for shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([pack(t) for t in byte_texts(batch.column(2))], pa.binary())], names=["doc_id", "th", "z"])

    return texts.select("doc_id", "th", "text").mapInArrow(run, "doc_id long, th long, z binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))


def _shard_of(anchor: Column, salt: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(anchor, salt), F.lit(shards)).cast("int")


def removed_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD, longest: int = LONGEST, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, th, a, b): the windows a <= start < b of a document (th: hash of its text) start in a smaller doc_id too."""
    texts = _texts(docs).where("doc_id is not null")
    ids = materialise(texts.select("doc_id", "th", F.sha2("text", 256).alias("sha")), "texts")
    copies = materialise(ids.groupBy("th", "sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("rows")), "copies")
    later = joined_by_count(ids, copies.where("first < last").select("sha", "first", "rows"), "sha", "rows", ids.count()).where("first < doc_id")
    later = later.select("doc_id", "th", F.lit(0).alias("a"), F.lit(WHOLE).alias("b"))

    emit = lambda rows: rows.select("th", "text").mapInArrow(_emit_anchors(window, gram), "anchor long, th long")
    some = materialise(emit(texts.where(F.pmod("th", F.lit(sample)) == 0)).distinct().groupBy("anchor").count(), "sample")
    held = some.agg(F.sum("count")).first()[0] or 0
    hot = [r["anchor"] for r in some.where(F.col("count") > max(8, held / HOT)).select("anchor").collect()]  # at most HOT by arithmetic
    hot = docs.sparkSession.createDataFrame([(a, -1 - i) for i, a in enumerate(sorted(hot))], "anchor long, hot int")
    # Rows of a hot anchor go on without being counted, over many tasks; confirming its windows counts them.
    found = emit(texts).join(F.broadcast(hot), "anchor", "left").withColumn("part", F.when(F.col("hot").isNull(), F.lit(0)).otherwise(F.col("th")))
    of = Window.partitionBy("anchor", "part")
    shared = found.withColumn("lo", F.min("th").over(of)).withColumn("hi", F.max("th").over(of)).where("lo < hi or hot is not null").select("anchor", "th")
    lists = shared.groupBy("th").agg(F.collect_set("anchor").alias("anchors"))
    lists = lists.join(copies.select("th", F.col("first").alias("doc_id")), "th")
    met = _packed(texts).join(lists, ["doc_id", "th"]).select("doc_id", "th", "z", "anchors")
    segments = materialise(met.mapInArrow(_emit_segments(window, gram, longest), "anchor long, doc_id long, th long, at int, words binary"), "segments")

    shards = max(1, -(-segments.count() // shard))
    sizes = segments.join(F.broadcast(hot), "anchor", "left").groupBy("hot").count().where("hot is not null")  # at most HOT rows
    salts = materialise(hot.join(sizes, "hot").select("hot", "anchor", F.ceil(F.col("count") / F.lit(shard)).cast("int").alias("salts")), "salts")
    salted = segments.join(F.broadcast(salts), "anchor", "left")
    # A window is dealt to its anchor's shard, or, if the anchor is hot, to that anchor's shards.
    dealt = F.coalesce("hot", _shard_of(F.col("anchor"), F.lit(0), shards))
    windows = salted.select("words", "doc_id", dealt.alias("dealt")).mapInArrow(_emit_windows(window), "hash long, doc_id long, dealt int")
    confirmed = windows.groupBy("hash", "dealt").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    everywhere = F.transform(F.sequence(F.lit(0), F.col("salts") - 1), lambda i: _shard_of(F.col("anchor"), i, shards))
    confirmed = confirmed.join(F.broadcast(salts), F.col("dealt") == F.col("hot"), "left").withColumn("shard", F.explode(F.when(F.col("salts").isNull(), F.array("dealt")).otherwise(F.array_distinct(everywhere))))
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id", "at"), F.col("salts")).cast("int"), F.lit(0))
    streamed = salted.select(_shard_of(F.col("anchor"), salt, shards).alias("shard"), "doc_id", "th", "at", "words")
    runs = streamed.groupBy("shard").cogroup(confirmed.select("shard", "hash", "first").groupBy("shard")).applyInPandas(_shard(window), _RUN)
    return runs.unionByName(later)


def drop_repeats(docs: DataFrame, window: int = WINDOW, **limits: int) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept (the words that stay, joined by single spaces)."""
    short_batches(docs.sparkSession)
    runs = removed_runs(docs, window, **limits)
    by_doc = runs.groupBy("doc_id").agg(F.collect_list(F.struct("th", "a", "b")).alias("r")).select("doc_id", F.col("r.th").alias("of"), F.col("r.a").alias("a"), F.col("r.b").alias("b"))
    packed = _packed(_texts(docs))
    joined = packed.where("doc_id is not null").join(by_doc, "doc_id", "left").select("doc_id", "th", "z", "of", "a", "b")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("of", "array<long>"), ("a", "array<int>"), ("b", "array<int>"))]
    joined = joined.unionByName(packed.where("doc_id is null").select("doc_id", "th", "z", *none))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for th, packed, of, a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), batch.column(4), batch.column(5), strict=True):
                words = unpack(packed).split()
                n_words.append(len(words))
                if not of.is_valid:
                    n_removed.append(0)
                    kept.append(b" ".join(words))
                    continue
                own = (of.values.to_numpy() == th) & (len(words) >= window)
                change = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(change, a.values.to_numpy()[own], 1)
                np.add.at(change, np.minimum(b.values.to_numpy()[own], len(words) - window + 1) + window - 1, -1)
                stays = np.cumsum(change)[:-1] == 0
                kept.append(b" ".join([words[i] for i in np.flatnonzero(stays).tolist()]))
                n_removed.append(int(len(words) - stays.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")
