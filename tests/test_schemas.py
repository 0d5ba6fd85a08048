"""Schema predicates against what the documents say."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sievewright.functions import schemas

PROFILE = [
    ({"summary": "s", "must_preserve": ["a"], "uncertain": False}, None),
    ({"summary": "s", "must_preserve": [], "uncertain": False}, "$.must_preserve: minItems"),
    ({"summary": "s", "must_preserve": ["a"] * 13, "uncertain": True}, "$.must_preserve: maxItems"),
    ({"summary": "s", "must_preserve": ["a", " "], "uncertain": True}, "$.must_preserve[]: pattern"),
    ({"summary": "s", "must_preserve": ["a", "b" * 501], "uncertain": True}, "$.must_preserve[]: maxLength"),
    ({"summary": "s", "must_preserve": ["a", None], "uncertain": True}, "$.must_preserve[]: type"),
    ({"summary": "", "must_preserve": ["a"], "uncertain": True}, "$.summary: minLength"),
    ({"summary": "  ", "must_preserve": ["a"], "uncertain": True}, "$.summary: pattern"),
    ({"summary": "ü" * 1500, "must_preserve": ["a"], "uncertain": True}, None),
    ({"summary": "ü" * 1501, "must_preserve": ["a"], "uncertain": True}, "$.summary: maxLength"),
    ({"summary": "s", "must_preserve": "a", "uncertain": True}, "$.must_preserve: type"),
    ({"summary": "s", "must_preserve": ["a"], "uncertain": 1}, "$.uncertain: type"),
    ({"summary": "s", "must_preserve": ["a"], "uncertain": None}, "$.uncertain: type"),
    ({"summary": "s", "must_preserve": ["a"]}, "$: required uncertain"),
    ({"summary": "s", "must_preserve": ["a"], "uncertain": True, "x y": 1}, "$: additionalProperties"),
    ([], "$: type"),
    ("s", "$: type"),
    (None, "$: type"),
]
ANSWER = [('{"answer": "YES", "reason": "r"}', None), ('{"answer": "yes", "reason": "r"}', "$.answer: enum"), ('{"answer": "NO", "answer": "NO", "reason": "r"}', "repeated key"), ('{"answer": NaN, "reason": "r"}', "number"), ('{"answer": "NO"} x', "syntax"), (None, None), ("", "syntax"), (' {"answer": "NO", "reason": " x "}\n', None)]


def told(spark, rows, schema):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    return [r["e"] for r in df.select("i", schemas.completion_error(F.col("t"), schema).alias("e")).orderBy("i").collect()]


def test_both_documents(spark):
    assert told(spark, [json.dumps(v) for v, _ in PROFILE], schemas.PROFILE) == [e for _, e in PROFILE]
    assert told(spark, [t for t, _ in ANSWER], schemas.ANSWER) == [e for _, e in ANSWER]


def test_numbers_and_constants(spark):
    schema = {"properties": {"n": {"type": "integer", "minimum": 2, "maximum": 5}, "k": {"const": 1}, "m": {"type": ["number", "null"]}, "e": {"enum": [True, None, "a", 2.5]}}}
    rows = ['{"n": 2}', '{"n": 1}', '{"n": 6}', '{"n": 2.5}', '{"n": 3.0}', '{"n": "3"}', '{"k": 1}', '{"k": true}', '{"m": null}', '{"m": "x"}', '{"e": 2.5}', '{"e": false}', "7"]
    want = [None, "$.n: minimum", "$.n: maximum", "$.n: type", None, "$.n: type", None, "$.k: const", None, "$.m: type", None, "$.e: enum", None]
    assert told(spark, rows, schema) == want


def test_unknown_keywords_are_refused():
    with pytest.raises(ValueError, match="oneOf"):
        schemas.problem(F.col("v"), {"oneOf": []})


def test_a_text_is_parsed_once_whatever_the_schema(spark):
    plan = spark.createDataFrame([("{}",)], "t string").select(schemas.problem(F.try_parse_json("t"), schemas.ANSWER).alias("e"))._jdf.queryExecution().optimizedPlan().toString()
    count = plan.lower().replace("_", "").count("parsejson")
    assert count <= 3, (count, plan[:300])
