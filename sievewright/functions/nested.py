"""Strings inside nested JSON, and strict parsing."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def leaves(value: object) -> list[str]:
    """All string values of a document, keys not included, in order."""
    if isinstance(value, str):
        return [value]
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return [s for v in inner for s in leaves(v)]


def mapped(value: object, change: Callable[[str], str]) -> object:
    if isinstance(value, str):
        return change(value)
    if isinstance(value, dict):
        return {k: mapped(v, change) for k, v in value.items()}
    if isinstance(value, list):
        return [mapped(v, change) for v in value]
    return value


def string_leaves(text: Column) -> Column:
    """Array of a JSON text's string values. JSON path alternatives can't recurse, so this is Python."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: leaves(json.loads(t)), na_action="ignore")

    return run(text)


def relocated(text: Column, old: str, new: str) -> Column:
    """A JSON text whose string values below folder ``old`` move to ``new``."""

    def change(s: str) -> str:
        return new + s[len(old) :] if s == old or s.startswith(old + "/") else s

    return _rewritten(text, change)


def replaced(text: Column, mapping: dict[str, str]) -> Column:
    """A JSON text whose string values are replaced by exact match; ``mapping`` is a run's short list of moved files."""
    return _rewritten(text, lambda s: mapping.get(s, s))


def _rewritten(text: Column, change: Callable[[str], str]) -> Column:
    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: json.dumps(mapped(json.loads(t), change), ensure_ascii=False, separators=(",", ":")), na_action="ignore")

    return run(text)


def strict_json(text: str) -> object:
    """Parse, refusing repeated keys and numbers that JSON doesn't have."""

    def unique(pairs: list[tuple[str, object]]) -> dict:
        out = dict(pairs)
        if len(out) < len(pairs):
            raise ValueError("repeated key")
        return out

    def refuse(name: str) -> None:
        raise ValueError(f"no JSON number: {name}")

    return json.loads(text.strip(), object_pairs_hook=unique, parse_constant=refuse)


def json_error(text: Column) -> Column:
    """Why a completion is no strict JSON; null if it is. Spark's from_json doesn't notice repeated keys."""

    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        def why(t: str) -> str | None:
            try:
                strict_json(t)
            except ValueError as e:
                return "repeated key" if "repeated" in str(e) else "number" if "no JSON number" in str(e) else "syntax"
            return None

        return texts.map(why, na_action="ignore")

    return run(text)
