"""Identities: digests, ids and seeds."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SAFE_ID = r"^[A-Za-z0-9][A-Za-z0-9_.-]{0,127}\z"


def canonical_json(value: object) -> str:
    """Keys sorted, no blanks, no escapes, no NaN: one text for one value."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def digest(value: object) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


@F.pandas_udf(StringType())
def canonical_digest(texts: pd.Series) -> pd.Series:
    """Canonical digest of JSON texts; null stays null. Spark's to_json keeps key order and drops nulls, so this is Python."""
    return texts.map(lambda t: digest(json.loads(t)), na_action="ignore")


def pixel_hash(width: Column, height: Column, rgb: Column) -> Column:
    """SHA-256 of an image's size and raw RGB bytes."""
    head = F.concat(F.lit("RGB:"), width.cast("string"), F.lit(":"), height.cast("string"), F.lit(":"))
    return F.sha2(F.concat(head.cast("binary"), rgb), 256)


def flat_digest(*parts: Column) -> Column:
    """Digest of flat values, as a JSON array of them would be hashed. Strings must not need escapes."""
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")).cast("binary"), 256)


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def folder_source_id(path: Column) -> Column:
    return F.concat(F.lit("src_"), F.substring(F.sha2(quoted(path).cast("binary"), 256), 1, 16))


def candidate_id(source_id: Column, attempt: Column, run_seed: int, hash_: Column) -> Column:
    key = flat_digest(F.lit(str(run_seed)), quoted(source_id), quoted(hash_))
    return F.concat(F.substring(source_id, 1, 80), F.lit("_"), F.lpad(attempt.cast("string"), 8, "0"), F.lit("_"), F.substring(key, 1, 10))


def attempt_seed(source_id: Column, attempt: Column, run_seed: int, hash_: Column) -> Column:
    """The first 32 bits of the digest of (seed, source, hash, attempt)."""
    key = flat_digest(F.lit(str(run_seed)), quoted(source_id), quoted(hash_), attempt.cast("string"))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def is_safe_id(c: Column) -> Column:
    return c.rlike(SAFE_ID)


def is_within(path: Column) -> Column:
    """A relative path without parent steps."""
    return ~path.startswith("/") & ~F.array_contains(F.split(path, "/"), "..")
