"""Verified export, discovery of runs, texts and generator parameters."""

from __future__ import annotations

import json
import math
import textwrap
from collections import Counter
from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.config import generator_problems
from sievewright.functions import texts, vectors
from sievewright.operators import exports, selection
from sievewright.operators import spans as sp
from sievewright.operators.ingest import ConstraintError
from sievewright.operators.lifecycle import writer_lock
from sievewright.sources import runs

RECORD = "candidate_id string, sequence long, source_id string, backend string, image_path string, pixel_sha256 string, file_sha256 string, criteria_sha256 string, export_status string, schema_version string, presentation_complete boolean"


def tables(spark, records, files=None):
    rows = spark.createDataFrame(records, RECORD)
    sources = spark.createDataFrame([("s", "train", "p0", "s.png", "g", "d"), ("v", "val", "p9", "v.png", "g", "d")], "source_id string, split string, pixel_sha256 string, image_path string, group_id string, domain string")
    stored = files or [(r[4], r[5], r[6]) for r in records]
    pairs = [(r[0], i, r[0] != "rejected") for r in records for i in range(1, 6)]
    return rows, sources, spark.createDataFrame(stored, "image_path string, pixel_sha256 string, file_sha256 string"), spark.createDataFrame(pairs, "candidate_id string, id int, passed boolean")


def record(name, sequence, pixels, source="s", backend="local", criteria="c", status="eligible", version="2.0", complete=True):
    return (name, sequence, source, backend, f"{name}.png", pixels, f"f{name}", criteria, status, version, complete)


RUN = {"schema_version": "2.0", "backend": "local", "criteria_sha256": "c"}


def test_verified_export(spark):
    good = [record("a", 1, "p1"), record("b", 2, "p2"), record("out", 3, "p1", status="none"), record("bare", 4, "p3", complete=False)]
    current, legacy = exports.verified_export(*tables(spark, good), RUN, ("local",))
    assert sorted(r["candidate_id"] for r in current.collect()) == ["a", "b"] and legacy.count() == 0
    assert current.first()["split"] == "train" and current.first()["verification_status"] == "clip_verified"
    old = [record("a", 1, "p1", criteria=None, version="1.1", complete=None)]
    current, legacy = exports.verified_export(*tables(spark, old), {**RUN, "schema_version": "1.1"}, ("local",))
    assert current.count() == 0 and legacy.first()["verification_status"] == "legacy_unverified"
    with pytest.raises(ConstraintError, match="refused"):
        exports.verified_export(*tables(spark, good), {**RUN, "backend": "fake"}, ("local",))
    bad = [("backend", record("x", 1, "p1", backend="fake")), ("split", record("x", 1, "p1", source="v")), ("split", record("x", 1, "p1", source="none")), ("decision", record("rejected", 1, "p1")), ("criteria", record("x", 1, "p1", criteria="d")), ("source", record("x", 1, "p9")), ("repeated", record("x", 5, "p2"))]
    for why, row in bad:
        with pytest.raises(ConstraintError, match=why):
            exports.verified_export(*tables(spark, [*good, row]), RUN, ("local",))
    for files in ([("a.png", "p1", "fa"), ("b.png", "other", "fb")], [("a.png", "p1", "fa"), ("b.png", "p2", "other")], [("a.png", "p1", "fa")]):
        with pytest.raises(ConstraintError, match="hash"):
            exports.verified_export(*tables(spark, good, files), RUN, ("local",))


def test_selection(spark):
    runs_ = spark.createDataFrame([(1, 1, 0, 0, 5), (1, 2, 1, 5, 9), (1, 3, 5, 0, 3), (2, 1, 0, 0, 2), (2, 2, 9, 9, 12)], "f int, s int, y int, x0 int, x1 int")
    scores = [(1, 1, 0, [0.9, 0.1, 0.1, 0.2]), (1, 1, 1, [0.9, 0.1, 0.1, 0.3]), (1, 3, 0, [0.1, 0.2, 0.9, 0.1]), (1, 3, 1, [0.2, 0.2, 0.1, 0.9]), (2, 1, 0, [0.1, 0.2, math.nan, 0.1]), (2, 1, 1, [0.1, 0.2, 0.1, 0.1])]
    got = {(r["f"], r["s"]): (r["group"], r["caption_pair"], r["selected"], r["error"]) for r in selection.decisions(runs_, spark.createDataFrame(scores, "f int, group int, view int, scores array<double>"), "f", "s").collect()}
    assert got == {(1, 1): (1, "contact_group", True, None), (1, 2): (1, "contact_group", True, None), (1, 3): (3, "single", False, None), (2, 1): (1, "single", False, "not_finite"), (2, 2): (2, "single", False, "count")}


def make_run(root, name, state="completed", **manifest):
    folder = root / name
    folder.mkdir()
    for file, value in {"manifest": {"schema_version": "2.0", "backend": "local", "run_id": name, **manifest}, "config": {}, "sources": [], "state": {"status": state}}.items():
        (folder / f"{file}.json").write_text(json.dumps(value))
    return folder


def test_runs_are_found_and_worked_on(spark, tmp_path):
    make_run(tmp_path, "a")
    make_run(tmp_path, "b", "running")
    locked = make_run(tmp_path, "c", "failed")
    make_run(tmp_path, "d", run_id="other")
    make_run(tmp_path, "e", backend="unknown")
    make_run(tmp_path, "f", schema_version="9")
    (make_run(tmp_path, "g") / "state.json").unlink()
    got = {r["run"]: r["status"] for r in runs.discover(spark, f"file://{tmp_path}", ("local",)).collect()}
    assert got == {"a": "ready", "b": "active", "c": "ready"}
    with writer_lock(locked / ".lock"):
        assert runs.each_run(spark, tmp_path, ("local",), lambda folder: folder.name) == {"a": "a", "b": "skipped_active", "c": "skipped_active"}
    assert runs.each_run(spark, tmp_path, ("local",), lambda folder: 1, exclude="a") == {"b": "skipped_active", "c": 1}


def test_texts(spark):
    assert texts.wrapped(["one two three", "x"], 7) == [*textwrap.wrap("one two three", 7), "x"]
    at = datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC)
    assert texts.utc_now(at) == "2026-01-02T03:04:05+00:00" and texts.run_id(at).startswith("run_20260102T030405Z_") and len(texts.run_id(at)) == 29
    row = spark.range(1).select(texts.number(F.lit(1.5), 4, True).alias("a"), texts.number(F.lit(None).cast("double"), 2).alias("b"), texts.point(F.lit(1), F.lit(-2.5)).alias("c"), texts.shortened(F.lit("abcdef"), 4).alias("d"), texts.shortened(F.lit("abcd"), 4).alias("e")).first()
    assert tuple(row) == ("+1.5000", None, "(1.00, -2.50)", "abc…", "abcd")
    filled = spark.range(1).select(texts.with_defaults(F.lit(None).cast("map<string,double>"), {"x": 0}).alias("a")).first()["a"]
    assert filled == {"x": 0.0}


@pytest.mark.parametrize("bad", [[0.0, 0.0], [math.inf, 1.0], [math.nan, 1.0]])
def test_vectors_without_length_are_errors(spark, bad):
    with pytest.raises(Exception, match="norm"):
        spark.createDataFrame([(bad,)], "v array<double>").select(vectors.unit(F.col("v"))).collect()


def test_generator_parameters():
    steps = {"skip_step_num": 2, "inversion_step_num": 10, "sampling_step_num": 8}
    names = (*steps, "scale")
    assert generator_problems({"scale": 1.5, "skip_step_num": 0}, steps, names) == []
    for params in ({"other": 1}, {"scale": -1}, {"scale": math.inf}, {"scale": True}, {"scale": "1"}, {"inversion_step_num": 0}, {"inversion_step_num": 2.0}, {"skip_step_num": 8}):
        assert len(generator_problems(params, steps, names)) == 1, params


def test_rounding_keeps_the_sign_of_zero_and_multiplies_first(spark):
    from sievewright.functions.vectors import rounded

    values = [-1e-7, -0.0, 1e-7, 0.0, -0.4999995, 0.1234565, 1.0000005, -2.5e-6, 0.0000025]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(rounded(F.col("x"), 6)).collect()
    want = [math.copysign(math.floor(abs(v) * 1e6 + 0.5) / 1e6, v) for v in values]
    assert [str(r[0]) for r in rows] == [str(w) for w in want]


def test_many_masks_in_few_tasks_hang_together_as_one_by_one(spark):
    rng = np.random.default_rng(2)
    rows = [(f, s, int(rng.integers(0, 6)), x, x + int(rng.integers(1, 9))) for f in range(60) for s in range(9) for x in [int(rng.integers(-5, 40))]]
    for diagonal in (True, False):
        reach, want = 0 if diagonal else 1, {}
        for frame in range(60):
            runs = [r for r in rows if r[0] == frame]
            label = {r[1]: r[1] for r in runs}
            for _ in runs:
                for p in runs:
                    for q in runs:
                        k = reach if p[2] != q[2] else 0
                        if abs(p[2] - q[2]) <= 1 and p[3] + k <= q[4] and q[3] + k <= p[4]:
                            label[p[1]] = label[q[1]] = min(label[p[1]], label[q[1]])
            sizes = Counter(label.values())
            want |= {(frame, s): (g, sizes[g]) for s, g in label.items()}
        got = sp.together(spark.createDataFrame(rows, "f int, s int, y int, x0 int, x1 int").coalesce(1), "f", "s", diagonal)
        assert {(r["f"], r["s"]): (r["group"], r["members"]) for r in got.collect()} == want


def test_a_task_gets_no_more_rows_as_tables_grow(spark):
    from sievewright.operators.joins import TASK_ROWS, dealt

    rows = dealt(spark.range(20 * TASK_ROWS), "id")
    most = max(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
    assert most < 1.1 * TASK_ROWS
