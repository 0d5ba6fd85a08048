"""License scans by diagonal voting.

Words are what ASCII letters, digits and all other characters form, in lower case. A template is the words of a known
phrase or notice. Each document emits the rolling hashes of its word k-grams, all of them, for each length of gram that
templates use; Spark joins them with the templates' grams, and every match is a vote for a diagonal: the word of the
document at which the template would begin.

* Phrases are found where all their grams vote for one diagonal, so all their words stand there consecutively.
* Notices may differ in some words. Votes of neighbouring diagonals (``SLACK`` words apart or less: words put in or left
  out) are merged around each diagonal, and the span that they cover is verified: the words of the template that stand
  there, in proportion to those of template and span together (Jaccard), must reach ``LEAST``. Of neighbouring diagonals
  that pass, the best counts, the first of equals; so each occurrence is one span, and none is lost to another one near it.

Hashes only bring candidates together: a gram carries its words if the low bits of its hash are among the templates'
(all others leave them out, for they can't match), and a vote counts only if the words are equal.

Scale: one pass over the texts; grams are never shuffled, as the templates' table is broadcast (``MOST_GRAMS`` bounds it),
and only votes and one short row a document are written. Votes are aggregated by document and diagonal.

Null text: no words. Texts shorter than a gram have none. Very long texts are scanned whole, in steps; their votes are
aggregated like others. Repeated rows and null doc_ids are told apart by a row number and keep their own rows. Ties:
equal similarities of neighbouring diagonals go to the first. Other columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import byte_texts, materialise, short_batches, tidy, word_steps


class Template(NamedTuple):
    label: str
    text: str
    #: A phrase must stand word for word; a notice may differ.
    phrase: bool


# The phrases that licenses are told by, and the opening words of public license notices.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
NOTICES = (
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", False),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", False),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", False),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", False),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", False),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", False),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", False),
    Template("unlicense", "this is free and unencumbered software released into the public domain", False),
)

#: Words of a gram: of phrases (the shortest has two words) and of notices.
PHRASE_GRAM, NOTICE_GRAM = 2, 4
SLACK, LEAST = 3, 0.8
#: Most template grams, for the broadcast, and the low bits of a hash that say whether a gram carries its words.
MOST_GRAMS, BITS = 100_000, 16

#: Letters A-Z in lower case, all other ASCII but letters and digits as spaces.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word hashes, kept from word to word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each ``k`` neighbouring word hashes; grams of other lengths hash otherwise."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = (out ^ hashes[j : j + n]) * _MIX
        out ^= out >> np.uint64(31)
    return out


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


_GRAMS = "hash long, gram binary, template int, label string, phrase boolean, at int, grams int, size int"


def template_grams(templates: Sequence[Template]) -> list[tuple[int, bytes, int, str, bool, int, int, int]]:
    """(hash, gram, template, label, phrase, at, grams, size): the grams of all templates, with their places."""
    rows = []
    for number, t in enumerate(templates):
        words = words_of(t.text)
        k = PHRASE_GRAM if t.phrase else NOTICE_GRAM
        hashes = gram_hashes(np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64), k).view(np.int64).tolist()
        if not hashes:
            raise ValueError(f"a template of fewer than {k} words: {t.text!r}")
        rows += [(h, b" ".join(words[at : at + k]), number, t.label, t.phrase, at, len(hashes), len(words)) for at, h in enumerate(hashes)]
    if len(rows) > MOST_GRAMS:
        raise ValueError(f"more than {MOST_GRAMS} grams of templates are too many to broadcast")
    return rows


_ROW = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int64()), ("hash", pa.int64()), ("gram", pa.binary()), ("n_words", pa.int64())])


def _rolling(lengths: Sequence[int], marked: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function: a row for each document (pos null, with n_words), and one for each gram at each word."""
    overlap = max(lengths) - 1
    low = np.uint64(len(marked) - 1)

    def grams(uid: int, start: int, words: list[bytes], hashes: np.ndarray, fresh: int) -> Iterator[pa.RecordBatch]:
        """Grams that end at or after the word ``fresh``, words being numbered from ``start``."""
        for k in lengths:
            first = max(0, fresh - k + 1)
            h = gram_hashes(hashes[first:], k)
            if not len(h):
                continue
            texts = np.full(len(h), None, dtype=object)
            for i in np.flatnonzero(marked[h & low]).tolist():
                texts[i] = b" ".join(words[first + i : first + i + k])
            nothing = pa.nulls(len(h), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), uid)), nothing, pa.array(np.arange(start + first, start + first + len(h))), pa.array(h.view(np.int64)), pa.array(texts, pa.binary()), nothing], schema=_ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        known = _Hashes()
        for batch in batches:
            counts, held, size = [], [], 0
            for uid, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(2)), strict=True):
                n, words, tail = 0, [], np.zeros(0, dtype=np.uint64)
                for some in word_steps((text or b"").translate(_PLAIN)):
                    hashes = np.concatenate([tail, np.fromiter(map(known.__getitem__, some), dtype=np.uint64, count=len(some))])
                    fresh = len(tail)
                    for part in grams(uid, n - fresh, words + some, hashes, fresh):
                        held.append(part)
                        size += part.num_rows
                    n += len(some)
                    words, tail = (words + some)[-overlap:], hashes[-overlap:]
                    if size > 200_000:
                        yield pa.Table.from_batches(held, _ROW).combine_chunks().to_batches()[0]
                        held, size = [], 0
                counts.append(n)
            if held:
                yield pa.Table.from_batches(held, _ROW).combine_chunks().to_batches()[0]
            nothing = pa.nulls(len(counts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), nothing, nothing, pa.nulls(len(counts), pa.binary()), pa.array(counts, pa.int64())], schema=_ROW)

    return run


def votes(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """A row for each document (uid, doc_id, n_words), and one for each vote (uid, template, ..., at, diagonal), written once."""
    spark = docs.sparkSession
    short_batches(spark)
    known = template_grams(templates)
    table = spark.createDataFrame(known, _GRAMS)
    marked = np.zeros(1 << BITS, dtype=bool)
    marked[[row[0] & ((1 << BITS) - 1) for row in known]] = True
    lengths = sorted({PHRASE_GRAM if t.phrase else NOTICE_GRAM for t in templates})
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    rows = rows.mapInArrow(_rolling(lengths, marked), "uid long, doc_id long, pos long, hash long, gram binary, n_words long")
    # The document's own row has no hash and so no match; it is kept by the outer join, grams without a match aren't.
    met = rows.join(F.broadcast(table.withColumnsRenamed({"hash": "_hash", "gram": "_gram"})), (F.col("hash") == F.col("_hash")) & (F.col("gram") == F.col("_gram")), "left")
    met = met.where(F.col("n_words").isNotNull() | F.col("template").isNotNull())
    return materialise(met.select("uid", "doc_id", "n_words", "template", "label", "phrase", "at", "grams", "size", (F.col("pos") - F.col("at")).alias("diagonal")), "license-votes")


def phrase_places(found: DataFrame) -> DataFrame:
    """(uid, label, start, end, similarity): diagonals for which all grams of a phrase voted."""
    by = found.where("phrase").groupBy("uid", "template", "diagonal", "label", "grams", "size").agg(F.count("*").alias("n"))
    return by.where("n = grams").select("uid", "label", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("size")).alias("end"), F.lit(1.0).alias("similarity"))


def notice_spans(found: DataFrame, slack: int = SLACK, least: float = LEAST) -> DataFrame:
    """(uid, label, start, end, similarity): verified spans of notices."""
    by = found.where("not phrase").groupBy("uid", "template", "diagonal", "label", "size").agg(F.collect_set("at").alias("ats"))
    of = Window.partitionBy("uid", "template").orderBy("diagonal")
    near = of.rangeBetween(-slack, slack)
    # Places in the template and in the document that the grams of neighbouring diagonals cover.
    covered: Callable[[Column], Column] = lambda places: F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, p + NOTICE_GRAM - 1))))
    merged = by.withColumn("placed", F.transform("ats", lambda a: a + F.col("diagonal")))
    merged = merged.withColumn("theirs", F.flatten(F.collect_list("ats").over(near))).withColumn("ours", F.flatten(F.collect_list("placed").over(near)))
    common = F.least(F.size(covered(F.col("theirs"))), F.size(covered(F.col("ours"))))
    merged = merged.select("uid", "template", "diagonal", "label", "size", common.alias("common"), F.array_min("ours").alias("start"), (F.array_max("ours") + NOTICE_GRAM).alias("end"))
    merged = merged.withColumn("similarity", F.col("common") / (F.col("size") + F.col("end") - F.col("start") - F.col("common")))
    # The best of its neighbours, the first of equals.
    best = F.max(F.struct("similarity", (-F.col("diagonal")).alias("place"))).over(near)
    merged = merged.withColumn("best", -best["place"]).where(F.col("similarity") >= least)
    return merged.where("best = diagonal").select("uid", "label", "start", "end", "similarity")


_SPANS = "array<struct<start:bigint,end:bigint,label:string,similarity:double>>"


def scan(docs: DataFrame, phrases: Sequence[Template] = PHRASES, notices: Sequence[Template] = NOTICES) -> DataFrame:
    """One row a document: doc_id, n_words, places (of phrases), first_word and last_word (their starts), base_labels and
    labels (arrays, sorted), spans (verified ones of notices), score (the greatest similarity found, 0 without any)."""
    found = votes(docs, (*phrases, *notices))
    places = phrase_places(found).withColumn("base", F.lit(True))
    spans = notice_spans(found).withColumn("base", F.lit(False))
    own = F.struct("start", "end", "label", "similarity")
    told = places.unionByName(spans).groupBy("uid").agg(
        F.count_if("base").alias("places"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.sort_array(F.collect_list(F.when(~F.col("base"), own))).alias("spans"),
        F.max("similarity").alias("score"),
    ).withColumnRenamed("uid", "_uid")
    rows = found.where("n_words is not null").select("uid", "doc_id", "n_words").join(told, F.col("uid") == F.col("_uid"), "left")
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return rows.select("doc_id", "n_words", F.coalesce("places", F.lit(0)).alias("places"), "first_word", "last_word", none("base_labels", "array<string>"), none("labels", "array<string>"), none("spans", _SPANS), F.coalesce("score", F.lit(0.0)).alias("score"))
