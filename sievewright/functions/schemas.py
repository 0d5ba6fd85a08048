"""JSON Schema (draft-07) documents as column expressions over VARIANT, so that texts are checked in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions.nested import json_error

# The two documents that completions are checked against.
ANSWER = {
    "type": "object",
    "additionalProperties": False,
    "required": ["answer", "reason"],
    "properties": {
        "answer": {"type": "string", "enum": ["YES", "NO", "UNCERTAIN"]},
        "reason": {"type": "string", "minLength": 1, "maxLength": 1000, "pattern": "\\S"},
    },
}
PROFILE = {
    "type": "object",
    "additionalProperties": False,
    "required": ["summary", "must_preserve", "uncertain"],
    "properties": {
        "summary": {"type": "string", "minLength": 1, "maxLength": 1500, "pattern": "\\S"},
        "must_preserve": {"type": "array", "minItems": 1, "maxItems": 12, "items": {"type": "string", "minLength": 1, "maxLength": 500, "pattern": "\\S"}},
        "uncertain": {"type": "boolean"},
    },
}

_NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}
_KNOWN = {"type", "enum", "const", "minimum", "maximum", "minLength", "maxLength", "pattern", "minItems", "maxItems", "items", "required", "properties", "additionalProperties"}
_NAMES = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is evaluated once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _is(value: Column, told: Column, kind: str) -> Column:
    """Whether a VARIANT is of a kind; ``told`` is its schema."""
    if kind in _NAMES:
        return told.startswith(_NAMES[kind])
    number = told.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    if kind == "number":
        return number
    if kind == "integer":
        x = F.try_variant_get(value, "$", "double")
        return number & (x == F.floor(x))
    raise ValueError(f"unknown type: {kind}")


def _equals(value: Column, told: Column, constant: object) -> Column:
    if isinstance(constant, bool):
        return _is(value, told, "boolean") & (F.try_variant_get(value, "$", "boolean") == F.lit(constant))
    if isinstance(constant, str):
        return _is(value, told, "string") & (F.try_variant_get(value, "$", "string") == F.lit(constant))
    if isinstance(constant, int | float):
        return _is(value, told, "number") & (F.try_variant_get(value, "$", "double") == F.lit(float(constant)))
    if constant is None:
        return _is(value, told, "null")
    raise ValueError("only plain values can be compared")


def problem(value: Column, schema: dict, path: str = "$") -> Column:
    """The first thing that is wrong with a VARIANT, as ``path: keyword``; null if nothing is.

    Keywords bind only values of their type, as the draft says. Keywords that this doesn't know are refused.
    """
    return _let(value, lambda v: _let(F.schema_of_variant(v), lambda told: _problem(v, told, schema, path)))


def _problem(value: Column, told: Column, schema: dict, path: str) -> Column:
    unknown = set(schema) - _KNOWN - _NOTES
    if unknown:
        raise ValueError(f"unknown keywords: {sorted(unknown)}")
    found: list[Column] = []

    def wrong(keyword: str, when: Column) -> None:
        found.append(F.when(when, F.lit(f"{path}: {keyword}")))

    if "type" in schema:
        kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        right = F.lit(False)
        for kind in kinds:
            right = right | _is(value, told, kind)
        wrong("type", ~right)
    for keyword, constants in (("enum", schema.get("enum")), ("const", [schema["const"]] if "const" in schema else None)):
        if constants is not None:
            same = F.lit(False)
            for constant in constants:
                same = same | _equals(value, told, constant)
            wrong(keyword, ~same)
    number = F.when(_is(value, told, "number"), F.try_variant_get(value, "$", "double"))
    text = F.when(_is(value, told, "string"), F.try_variant_get(value, "$", "string"))
    items = F.when(_is(value, told, "array"), F.try_variant_get(value, "$", "array<variant>"))
    limits = {"minimum": lambda n: number < n, "maximum": lambda n: number > n, "minLength": lambda n: F.length(text) < n, "maxLength": lambda n: F.length(text) > n, "minItems": lambda n: F.size(items) < n, "maxItems": lambda n: F.size(items) > n}
    for keyword, breaks in limits.items():
        if keyword in schema:
            # size() of null is -1 in some modes: only arrays are counted.
            wrong(keyword, breaks(schema[keyword]) if "Items" not in keyword else items.isNotNull() & breaks(schema[keyword]))
    if "pattern" in schema:
        wrong("pattern", ~text.rlike(f"(?U){schema['pattern']}"))
    if "items" in schema:
        found_in = F.filter(F.transform(items, lambda x: problem(x, schema["items"], f"{path}[]")), lambda p: p.isNotNull())
        found.append(F.get(found_in, F.lit(0)))
    named = schema.get("properties", {})
    get = lambda name: F.when(_is(value, told, "object"), F.try_variant_get(value, f"$['{name}']", "variant"))
    for name in schema.get("required", []):
        wrong(f"required {name}", _is(value, told, "object") & get(name).isNull())
    if schema.get("additionalProperties") is False:
        keys = F.map_keys(F.when(_is(value, told, "object"), F.try_variant_get(value, "$", "map<string,variant>")))
        wrong("additionalProperties", F.exists(keys, lambda k: ~k.isin(list(named)) if named else F.lit(True)))
    elif not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError("additionalProperties must be true or false")
    checked = lambda name, inner: _let(get(name), lambda one: F.when(one.isNotNull(), problem(one, inner, f"{path}.{name}")))
    found += [checked(name, inner) for name, inner in named.items()]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def completion_error(text: Column, schema: dict) -> Column:
    """Why a text isn't a strict JSON document of a schema: that of :func:`nested.json_error`, else the first problem; null
    for a right one, and for a null text."""
    return F.coalesce(json_error(text), problem(F.try_parse_json(text), schema))
