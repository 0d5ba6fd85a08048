"""Mixture-controlled packing by deficit round-robin over source queues.

Documents are tokenized once; their ids (two bytes each) are written to the shared folder with their source and a
block number drawn from a hash of the row, so every block holds a like mixture whatever the order of the input. A
block is packed by one task: each window of ``width`` tokens credits every source with its share of the window, and
sources are served in round-robin order while they have credit; what a source gets too much or too little stays in
its deficit for the next window. Deficits also carry across blocks: the credit a source has left after a block is
share times all tokens so far less its own tokens so far, a running sum over a table with one row for each block and
source. Shares are those of the whole corpus (or given), so queues run dry together.

Windows are full but for the end of a block, which is cut into powers of two: these sequences need no padding.

Scale: blocks hold about ``block_tokens`` tokens, so memory doesn't grow with the data; a document longer than that
makes its own block larger. A source with a third of all rows is spread over all blocks.

Null text is empty (the document is its end token alone); a null source is a source of its own; null doc_ids and
repeated rows are packed like any others, each row as a document of its own. Other columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import kept_in_worker, materialise, short_batches, slices

WIDTH, END_ID, BLOCK_TOKENS, LEAST_PIECE = 2048, 1, 2_000_000, 128
#: Entries of each half of an encoder's tables.
_CACHE = 350_000


class Recent:
    """What was asked for lately, in two halves: a full half becomes the old one, and what is found there moves on.

    Frequent keys stay, whatever passes through; memory is bounded by two halves.
    """

    def __init__(self, size: int = _CACHE) -> None:
        self.size, self.new, self.old = size, {}, {}

    def add(self, items: Iterable[tuple[bytes, bytes]]) -> None:
        self.new.update(items)
        if len(self.new) > self.size:
            self.new, self.old = {}, self.new

    def many(self, keys: list[bytes], learn: Callable[[list[bytes]], Iterable[tuple[bytes, bytes]]]) -> list[bytes]:
        """The values of keys; those of unknown ones are learned together."""
        out = list(map(self.new.get, keys))
        places = [i for i, x in enumerate(out) if x is None]
        if places:
            old, unknown = self.old.get, {}
            found = {}
            for i in places:
                key = keys[i]
                x = out[i] = old(key)
                if x is None:
                    unknown[key] = None
                else:
                    found[key] = x
            if unknown:
                unknown = dict(learn(list(unknown)))
                for i in places:
                    if out[i] is None:
                        out[i] = unknown[keys[i]]
                found |= unknown
            self.add(found.items())
        return out


class WordEncoder:
    """Ids of texts, by chunks between white space, kept for chunks that recur.

    Right for tokenizers that lower-case, drop white space, never look across it and part letters from punctuation. A
    batch is split and its chunks are numbered by Arrow; only chunks that differ are looked up, and ids are gathered by
    number. A chunk of letters and closing punctuation has the ids of the letters and those of the punctuation. New
    letters are encoded together: each has one piece, whose last id is a token that ends with ``end_of_word``, and none
    can have fewer, so if the pieces add up, each has its own. Texts that hold the start of a special token are encoded
    as they are.
    """

    def __init__(self, path: str, end_of_word: str = "</w>", special: str = "<|") -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.special = Tokenizer.from_file(path), special
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(end_of_word)]] = True
        #: Ids of runs of letters (none for chunks that aren't) and of everything else.
        self.letters, self.others = Recent(), Recent()

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype=self.kind).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_letters(self, new: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of runs of letters; no ids for chunks that are none."""
        some = []
        for chunk, text in zip(new, b"\n".join(new).decode().split("\n"), strict=True):
            if text.isalpha():
                some.append((chunk, text))
            else:
                yield chunk, b""
        for at in range(0, len(some), 4000):
            part = some[at : at + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join([t for _, t in part])], add_special_tokens=False)[0].ids, dtype=self.kind)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                raw, start = ids.tobytes(), 0
                for (chunk, _), stop in zip(part, (stops * self.kind.itemsize).tolist(), strict=True):
                    yield chunk, raw[start:stop]
                    start = stop
            else:
                yield from zip([c for c, _ in part], self._each([t for _, t in part]), strict=True)

    def _learn_others(self, new: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        return zip(new, self._each([c.decode() for c in new]), strict=True)

    def _pieces(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk."""
        bodies = [c.rstrip(b".,;:!?") for c in chunks]
        out = self.letters.many(bodies, self._learn_letters)
        places = [i for i, (c, b, x) in enumerate(zip(chunks, bodies, out, strict=True)) if len(b) != len(c) or not x]
        rest = [chunks[i][len(bodies[i]) :] if out[i] else chunks[i] for i in places]
        for i, x in zip(places, self.others.many(rest, self._learn_others), strict=True):
            out[i] += x
        return out

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (a string array without nulls), as little-endian bytes."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        enc = lists.flatten().dictionary_encode()
        pieces = self._pieces(enc.dictionary.cast(pa.binary()).to_pylist())
        wide = self.kind.itemsize
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // wide
        flat, starts = np.frombuffer(b"".join(pieces), dtype=self.kind), np.cumsum(sizes) - sizes
        chunk = enc.indices.to_numpy()
        n = sizes[chunk]
        stops = np.cumsum(n)
        ids = flat[np.repeat(starts[chunk] - (stops - n), n) + np.arange(stops[-1] if len(stops) else 0)].tobytes()
        ends = np.append(0, stops)[np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))] * wide
        out = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for i in np.flatnonzero(pc.match_substring(texts, self.special).to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._each([texts[i].as_py()])[0]
        return out


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    """One encoder a Python worker, so that what it has learned serves the worker's next tasks too."""
    return WordEncoder(path)


kept_in_worker.append(encoder.cache_clear)


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, source, h (a hash that spreads rows, repeated ones too), n (tokens), ids (little-endian, two bytes each if the vocabulary allows)."""
    short_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("h", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.array([end_id], dtype=encode.kind).tobytes()
        for batch in batches:
            texts = batch.column(3).fill_null("")
            for a, b in slices(pc.binary_length(texts).to_numpy(), 1 << 23):
                ids = [x + end for x in encode(texts.slice(a, b - a))]
                n = pa.array([len(x) // encode.kind.itemsize for x in ids], pa.int64())
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), n, pa.array(ids, pa.binary())], schema=schema)
        pa.default_memory_pool().release_unused()

    rows = docs.select("doc_id", "source", F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("h"), "text")
    return rows.mapInArrow(run, "doc_id long, source string, h long, n long, ids binary")


def _powers(n: int, width: int) -> list[int]:
    """The last windows of a block with n tokens left (fewer than ``width``): powers of two, no padding."""
    return [1 << k for k in range(width.bit_length(), -1, -1) if n >> k & 1]


def pack_block(rows: list[tuple], shares: dict, credit: dict, width: int, item: np.dtype, least: int) -> Iterator[tuple]:
    """Pieces (doc_id, start, length, crc32, doc_tokens, window, offset) of one block; rows: (doc_id, source, n, ids)."""
    queues: dict = {}
    for doc, source, n, ids in rows:
        queues.setdefault(source, deque()).append([doc, n, np.frombuffer(ids, dtype=item).astype("<u4").tobytes(), 0])
    order = sorted(queues, key=lambda s: (s is None, s or ""))
    left = {s: sum(x[1] for x in q) for s, q in queues.items()}
    credit = {s: credit.get(s, 0.0) for s in order}
    total, window, at = sum(left.values()), 0, 0
    sizes = [width] * (total // width) + _powers(total % width, width)
    for size in sizes:
        for s in order:
            credit[s] += shares.get(s, 0.0) * size
        offset, idle = 0, 0
        while offset < size:
            s = order[at % len(order)]
            if not left[s] or (credit[s] <= 0 and idle < len(order)):
                at, idle = at + 1, idle + 1
                if idle > len(order):  # no source has credit: the fullest one goes on
                    s = max(order, key=lambda x: (left[x] > 0, credit[x]))
                else:
                    continue
            idle = 0
            room = min(size - offset, left[s], max(int(credit[s]), least))
            while room:
                head = queues[s][0]
                n = min(room, head[1] - head[3])
                a = head[3]
                yield head[0], a, n, zlib.crc32(head[2][4 * a : 4 * (a + n)]), head[1], window, offset
                head[3] += n
                offset, room = offset + n, room - n
                left[s] -= n
                credit[s] -= n
                if head[3] == head[1]:
                    queues[s].popleft()
            at += 1
        window += 1


def _before(rows: DataFrame, *keys: str, width: int = 4096) -> DataFrame:
    """``rows`` (block, n, keys) with ``before``: the sum of n over earlier blocks.

    Sums of ``width`` blocks each are put in order, then blocks within them, so no task holds the sums of all blocks.
    """
    rows = rows.withColumn("wide", F.floor(F.col("block") / width))
    earlier = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = rows.groupBy("wide", *keys).agg(F.sum("n").alias("n")).withColumn("base", earlier(keys, "wide"))
    base = base.select(F.col("wide").alias("w"), *(F.col(k).alias(f"of_{k}") for k in keys), "base")
    on = F.col("wide") == F.col("w")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"of_{k}"))
    inside = rows.withColumn("inside", earlier(("wide", *keys), "block"))
    return inside.join(base, on).select("block", *keys, (F.col("inside") + F.col("base")).alias("before"))


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, width: int = WIDTH, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, shares: dict | None = None, least: int = LEAST_PIECE) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``shares`` maps sources to target proportions; without it those of the corpus hold.
    """
    tokens = materialise(tokenize(docs, tokenizer_path, end_id), "tokens")
    total, held = tokens.agg(F.sum("n"), F.sum(F.octet_length("ids"))).first()
    total, item = total or 0, f"<u{(held or 0) // (total or 1) or 2}"
    blocks = max(1, round(total / block_tokens))
    rows = tokens.withColumn("block", F.pmod(F.xxhash64("h"), F.lit(blocks)))
    by = rows.groupBy("block", "source").agg(F.sum("n").alias("n"))
    if shares is None:
        share = by.groupBy("source").agg((F.sum("n") / F.lit(float(max(total, 1)))).alias("share"))
    else:
        whole = float(sum(shares.values()))
        share = by.select("source").distinct().withColumn("share", F.coalesce(F.create_map(*(F.lit(x) for k, v in shares.items() for x in (k, v / whole)))[F.col("source")], F.lit(0.0)))
    past = _before(by.groupBy("block").agg(F.sum("n").alias("n"))).select(F.col("block").alias("past_block"), F.col("before").alias("past"))
    own = _before(by, "source").select("block", F.col("source").alias("of"), F.col("before").alias("own"))
    share = share.select(F.col("source").alias("share_of"), "share")
    start = own.join(past, F.col("block") == F.col("past_block")).join(share, F.col("of").eqNullSafe(F.col("share_of")))
    start = start.select(F.col("block").alias("to"), "of", "share", (F.col("share") * F.col("past") - F.col("own")).alias("credit"))

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["h", "doc_id", "n"], kind="stable")  # whatever order the shuffle gives
        name = lambda s: s if isinstance(s, str) else None
        docs = [(int(d) if isinstance(d, str) else None, name(s), int(n), ids) for d, s, n, ids in zip(left["doc_id"], left["source"], left["n"], left["ids"], strict=True)]
        of = [name(s) for s in right["of"]]
        pieces = list(pack_block(docs, dict(zip(of, right["share"], strict=True)), dict(zip(of, right["credit"], strict=True)), width, np.dtype(item), least))
        out = pd.DataFrame(pieces, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        out["sequence_id"] += int(key[0]) << 32
        return out.astype({"doc_id": "Int64"})

    by_block = rows.select("block", "h", F.col("doc_id").cast("string").alias("doc_id"), "source", "n", "ids").groupBy("block")  # ids as text: exact beside nulls
    return by_block.cogroup(start.groupBy("to")).applyInPandas(run, _PIECES)
