"""Operators on small tables: edge cases and properties."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from arrays import bilinear, grid_geometry, shifted, swept_support
from pyspark.sql import functions as F

from sievewright.functions import geometry as geo
from sievewright.functions import identity
from sievewright.operators import acceptance, contacts, ingest, ledger, maintenance, ordered, reporting, scoring
from sievewright.operators import spans as sp
from sievewright.sources import readers


def test_policy_covers_all_32_verdicts(spark):
    rows = [(code, i + 1, bool(code >> i & 1)) for code in range(32) for i in range(5)]
    got = {r["code"]: r["passed"] for r in scoring.decisions(spark.createDataFrame(rows, "code long, id int, passed boolean"), "code").collect()}
    assert got == {c: bin(c & 15).count("1") >= 3 and c >= 16 for c in range(32)}


def test_ties_fail_and_bad_scores_are_errors(spark):
    rows = spark.createDataFrame([(1, [0.1] * 10), (2, [float("nan")] + [0.1] * 9), (3, [0.1] * 9), (4, [1.00002] + [0.0] * 9), (5, None), (6, [None] + [0.1] * 9)], "k int, s array<double>")
    got = {r["k"]: r["e"] for r in rows.select("k", scoring.score_error(F.col("s"), 10, scoring.SCORE_BOUND).alias("e")).collect()}
    assert got == {1: None, 2: "not_finite", 3: "count", 4: "out_of_bounds", 5: "count", 6: "not_finite"}
    tie = spark.createDataFrame([(1, 0, 0.5, 0.5), (1, 1, 0.1, 0.9), (2, 0, 0.1, 0.2), (2, 1, 0.1, 0.9)], "k int, view int, uninvolved double, involved double")
    assert {r["k"]: r["selected"] for r in contacts.both_views(tie, "k").collect()} == {1: False, 2: True}


def test_a_duplicate_of_a_rejected_artifact_is_accepted(spark):
    rows = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, True), ("s", 4, True), ("b", 5, True), ("c", 6, True)], "hash string, sequence long, passed boolean")
    sources = spark.createDataFrame([("s",)], "hash string")
    assert [(r["hash"], r["sequence"]) for r in acceptance.accepted(rows, sources, 2).orderBy("rank").collect()] == [("a", 2), ("b", 5)]


def test_costs_add_up_to_the_total(spark):
    rng = random.Random(5)
    rows = spark.createDataFrame([(i * 3, rng.choice(["accepted", "error", "rejected"]), rng.randrange(100)) for i in range(500)], "n long, outcome string, spent long")
    done = F.col("outcome") == "accepted"
    costs = ledger.costs(rows, "n", "spent", done).agg(F.sum("cost")).first()[0]
    rest = ledger.pending(rows, "n", "spent", done).first()
    assert costs + rest["pending"] == rest["total"]


@pytest.mark.parametrize("width", [1, 7, 4096])
def test_running_sum_and_previous(spark, width):
    rng = random.Random(width)
    data = [(i * 2, rng.randrange(50)) for i in range(200)]
    rows = spark.createDataFrame(data, "n long, v long")
    sums = [r["s"] for r in ordered.running_sum(rows, "n", F.col("v"), "s", width).orderBy("n").collect()]
    assert sums == np.cumsum([v for _, v in data]).tolist()
    before = [r["p"] for r in ordered.previous(rows, "n", "v", "p", width).orderBy("n").collect()]
    assert before == [None, *(v for _, v in data[:-1])]


def test_three_failures_in_a_row_are_fatal(spark):
    rows = spark.createDataFrame([(i, o) for i, o in enumerate("eaeeaeeee")], "n long, o string")
    assert ledger.fatal_at(rows, "n", F.col("o") == "e").first()[0] == 7
    assert ledger.fatal_at(rows.where("n < 5"), "n", F.col("o") == "e").first()[0] is None


def test_ingest_guards(spark):
    schema = "source_id string, split string, group_id string, pixel_sha256 string, width int, height int, preserve_hint string, ord int"
    good = [("a", None, None, "p", 64, 64, None, 0), ("b", "train", "", "q", 64, 64, "x", 1), ("c", None, "g", "p", 64, 64, " ", 2), ("d", "val", None, "r", 64, 64, None, 3)]
    kept, dropped = ingest.ingest(spark.createDataFrame(good, schema))
    assert {r["source_id"]: (r["group_id"], r["group_inferred"]) for r in kept.collect()} == {"a": ("a", True), "b": ("b", True)}
    assert [(r["source_id"], r["duplicate_of"]) for r in dropped.collect()] == [("c", "a")]
    for bad in (("a", None, None, "z", 64, 64, None, 9), ("e", "no", None, "z", 64, 64, None, 9), ("e", "test", "a", "z", 64, 64, None, 9), ("e", None, None, "z", 31, 64, None, 9), ("e", "test", None, "p", 64, 64, None, 9), ("e", None, None, "z", 64, 64, " ", 9)):
        with pytest.raises(ingest.ConstraintError):
            ingest.ingest(spark.createDataFrame([*good, bad], schema))


def test_span_algebra_equals_arrays(spark):
    rng = np.random.default_rng(3)
    masks = {(k, i): rng.random((12, 20)) < 0.25 for k in range(6) for i in range(3)}
    rows = spark.createDataFrame([(k, i, *s) for (k, i), m in masks.items() for s in sp.from_mask(m)], "k int, i int, y int, x0 int, x1 int")
    frames = {k: np.any([masks[k, i] for i in range(3)], axis=0) for k in range(6)}

    def arrays(df, h=12, w=20):
        out: dict = {}
        for r in df.collect():
            out.setdefault(r["k"], []).append((r["y"], r["x0"], r["x1"]))
        return {k: sp.to_mask(v, h, w) for k, v in out.items()}

    union = sp.union(rows, "k")
    assert all((arrays(union)[k] == frames[k]).all() for k in frames)
    assert sorted((r["k"], r["y"], r["x0"], r["x1"]) for r in union.collect()) == sorted((k, *s) for k, m in frames.items() for s in sp.from_mask(m))
    for r in sp.measures(union, "k").collect():
        ys, xs = np.nonzero(frames[r["k"]])
        assert (r["area"], r["x_min"], r["x_max"], r["y_min"], r["y_max"]) == (len(xs), xs.min(), xs.max(), ys.min(), ys.max())
        assert np.allclose((r["cx"], r["cy"]), (xs.mean(), ys.mean()))
    moved = arrays(sp.translate(union, F.lit(5), F.lit(-3), F.lit(20), F.lit(12)))
    assert all((moved[k] == shifted(frames[k], 5, -3)).all() for k in frames)
    grown = arrays(sp.dilated(union, 2, "k").where("y between 0 and 11"))
    for k, m in frames.items():
        for _ in range(2):
            m = m | shifted(m, 1, 0) | shifted(m, -1, 0) | shifted(m, 0, 1) | shifted(m, 0, -1)
        assert (grown[k] == m).all()
    for diagonal in (True, False):
        want = set()
        for k in range(6):
            for i in range(3):
                for j in range(i + 1, 3):
                    a, near = masks[k, i], np.zeros((12, 20), dtype=bool)
                    for dx in (-1, 0, 1):
                        for dy in (-1, 0, 1):
                            if diagonal or not (dx and dy):
                                near |= shifted(a, dx, dy)
                    if (near & masks[k, j]).any():
                        want.add((k, i, j))
        assert {(r["k"], r["i"], r["i2"]) for r in sp.touching(rows, ["k"], "i", diagonal).collect()} == want
    assert sp.differs(union, union, "k").isEmpty() and not sp.differs(union, union.limit(1), "k").isEmpty()


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    nodes = spark.range(103).withColumnRenamed("id", "n")
    got = {r["n"]: r["component"] for r in contacts.components(nodes, edges, "a", "b", "n").collect()}
    assert all(got[i] == 0 for i in range(41)) and got[50] == 50 and got[101] == 100 and got[102] == 102
    empty = contacts.components(nodes, edges.limit(0), "a", "b", "n")
    assert empty.where("component <> n").isEmpty()


def test_components_of_a_star_and_a_path(spark):
    hub = spark.range(1, 50_001).select(F.lit(60_000).cast("long").alias("a"), F.col("id").alias("b"))
    path = spark.range(100_000, 100_300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = hub.unionByName(path)
    nodes = edges.select(F.col("a").alias("n")).union(edges.select("b")).distinct()
    got = contacts.components(nodes, edges, "a", "b", "n").groupBy("component").agg(F.count("*").alias("n")).collect()
    assert sorted(map(tuple, got)) == [(1, 50_001), (100_000, 301)]


def clocked(spark, marks, bucket=7):
    rows = spark.createDataFrame([("r", t, i, k, o) for i, (t, k, o) in enumerate(marks)], "run string, at long, tie long, kind string, overhead long")
    return ledger.active_clock(rows, "run", "at", "tie", F.floor(F.col("at") / bucket)).first()


def test_clock_over_pauses_restarts_and_crashes(spark):
    got = clocked(spark, [(0, "start", 10), (40, "end", None), (3640, "start", 5), (3690, "checkpoint", None), (3697, "end", None)])
    assert (got["active"], got["overhead"], got["segments"], got["crashes"], got["timing_complete"], got["running"]) == (112, 15, 2, 0, True, False)
    crash = clocked(spark, [(0, "start", None), (5, "checkpoint", None), (35, "start", None), (36, "end", None), (90, "checkpoint", None)])
    assert (crash["active"], crash["crashes"], crash["timing_complete"], crash["running"]) == (6, 1, False, False)
    assert clocked(spark, [(0, "checkpoint", None), (9, "end", None), (9, "start", 1)])["running"]


def test_scorer_scores_only_what_is_new(spark):
    scorer = scoring.Scorer(lambda part: part.assign(score=part["x"] * 2.0)[["k", "score"]], "k long, score double", "k")
    rows = spark.createDataFrame([(1, 1), (2, 5), (3, 7)], "k long, x int")
    assert sorted(map(tuple, scorer(rows).collect())) == [(1, 2.0), (2, 10.0), (3, 14.0)]
    cached = spark.createDataFrame([(2, -1.0)], "k long, score double")
    assert sorted(map(tuple, scorer(rows, cached).collect())) == [(1, 2.0), (2, -1.0), (3, 14.0)]


def test_scan_equals_a_loop(spark):
    rng = random.Random(2)
    at = sorted(rng.sample(range(-500, 4000), 700))
    rows = [(x, rng.choice([None, -2, 5, 7]), rng.random() < 0.01 or 1000 < x < 1100) for x in at]
    df = spark.createDataFrame(rows, "t long, v int, hit boolean").repartition(3)
    want, total, seen, last, before = [], 0, 0, None, None
    for x, v, hit in rows:
        total, seen = total + (v or 0), seen + 1
        want.append((x, total, seen, last, before))
        if hit:
            last = total
        if v == 5:
            before = seen
    for width in (3, 16, 4096):
        got = ordered.scan(df, "t", {"total": F.col("v"), "seen": F.lit(1)}, {"last": ("total", F.col("hit")), "before": ("seen", F.col("v") == 5)}, width)
        assert sorted(tuple(r[c] for c in ("t", "total", "seen", "last", "before")) for r in got.collect()) == want
    assert ordered.scan(df.limit(0), "t", {"total": F.col("v")}).count() == 0


def test_bilinear_keeps_constants_and_geometry_reports_errors():
    assert np.allclose(bilinear(np.ones((7, 9)), 4, 5), 1)
    mask = np.zeros((80, 120), dtype=bool)
    mask[20:40, 20:40] = True
    assert grid_geometry(mask, (30, 20), (1, 1))["error"] == "zero"
    assert grid_geometry(mask, (30, 20), (100, 0))["error"] == "leaving"
    assert grid_geometry(np.zeros_like(mask), (30, 20), (8, 8))["error"] == "vanished"
    assert grid_geometry(mask, (30, 20), (8, 8))["error"] is None


def test_motion_finds_the_shift_and_never_divides_by_zero():
    rng = np.random.default_rng(11)
    before, mask = rng.random((40, 48)), np.zeros((40, 48), dtype=bool)
    mask[10:20, 10:24] = True
    found = geo.motion(before, np.roll(before, (4, 6), axis=(0, 1)), mask, (6, 4))
    assert (found["status"], found["dx"], found["dy"], found["residual"]) == ("appearance_match_only", 6, 4, 0.0)
    assert geo.motion(np.zeros_like(before), before, mask, (0, 0))["status"] == "unmeasurable"


def test_identities():
    assert identity.canonical_json({"b": 1, "a": [None, "é"]}) == '{"a":[null,"é"],"b":1}'
    with pytest.raises(ValueError):
        identity.canonical_json(float("nan"))


def test_relocation_and_protection(spark):
    rows = spark.createDataFrame([("runs/1",), ("runs/1/a",), ("runs/12",)], "path string")
    assert [r[0] for r in rows.select(maintenance.relocate(F.col("path"), "runs/1", "old")).collect()] == ["old", "old/a", "runs/12"]
    references = spark.createDataFrame([("runs/1/a/b",)], "reference string")
    assert sorted(r[0] for r in maintenance.protected(rows, references).collect()) == ["runs/1", "runs/1/a"]


def test_small_json_is_written_once(tmp_path):
    target = tmp_path / "index.json"
    assert reporting.write_small_json({"b": 1, "a": 2}, target)
    assert not reporting.write_small_json({"a": 2, "b": 1}, target)
    assert reporting.write_small_json({"a": 3}, target) and json.loads(target.read_text()) == {"a": 3}


def test_manifest_and_ledger_sources(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"schema_version":"2.0","source_id":"a","image_path":"x.png"}\n\n{"schema_version":"1.1","source_id":"b","image_path":"y.png"}\n')
    assert [r["source_id"] for r in readers.manifest(spark, f"file://{tmp_path}/m.jsonl").orderBy("ord").collect()] == ["a", "b"]
    (tmp_path / "bad.jsonl").write_text('{"schema_version":"9"}\n')
    with pytest.raises(Exception, match="unknown schema version"):
        readers.manifest(spark, f"file://{tmp_path}/bad.jsonl").collect()
    (tmp_path / "l.jsonl").write_text('{"candidate_id":"c","sequence":1,"stage_seconds":{"plan":1.5}}\n')
    assert readers.ledger(spark, f"file://{tmp_path}/l.jsonl").first()["stage_seconds"] == {"plan": 1.5}
    (tmp_path / "k.jsonl").write_text('{"candidate_id":"c","extra":1}\n')
    with pytest.raises(Exception, match="unknown ledger key"):
        readers.ledger(spark, f"file://{tmp_path}/k.jsonl").collect()


def test_round_robin_and_batches(spark):
    sources = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, source_id string")
    got = acceptance.round_robin(spark.range(5).withColumnRenamed("id", "n"), sources, "n", 2).orderBy("n").collect()
    assert [r["source_id"] for r in got] == ["c", "a", "b", "c", "a"]
    assert [acceptance.batch_size(4, 10, n) for n in (0, 7, 10, 12)] == [4, 3, 0, 0]


def test_keep_first_keeps_rows_without_a_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), (None, 4, "w"), ("b", 5, "q"), ("b", 5, "p")], "key string, ord long, name string")
    got = {(r["key"], r["name"]): (r["kept"], r["duplicate_of"]) for r in ingest.keep_first(rows, "key", "ord", "name").collect()}
    assert got == {("a", "x"): (True, None), ("a", "y"): (False, "x"), (None, "z"): (True, None), (None, "w"): (False, "z"), ("b", "p"): (True, None), ("b", "q"): (False, "p")}


def test_running_values_cross_buckets(spark):
    from sievewright.operators import ledger, ordered

    n = 10_000
    rows = spark.range(n).withColumn("failed", F.col("id") % 9973 != 5)
    got = {r["id"]: (r["run"], r["nth"]) for r in ledger.failure_runs(rows, "id", F.col("failed")).collect()}
    run = nth = 0
    for i in range(n):
        if i % 9973 == 5:
            run, nth = run + 1, 0
        else:
            nth += 1
            assert got[i] == (run, nth)
    assert [r["r"] for r in ordered.ranked(spark.range(100, 9000, 7), "id", "r").orderBy("id").collect()] == list(range(1, 1273))


def test_digest_of_a_sparse_collection(spark):
    import hashlib

    from sievewright.operators.integrity import BLOCK, collection_digest

    at = [0, 1, BLOCK, BLOCK * BLOCK, BLOCK * BLOCK * 5 + 3]
    sha = lambda parts: hashlib.sha256(",".join(parts).encode()).hexdigest()
    level = {}
    for x in at:
        level.setdefault(x // BLOCK, []).append(f"v{x}")
    level = {k: sha(v) for k, v in level.items()}
    above = {}
    for k in sorted(level):
        above.setdefault(k // BLOCK, []).append(level[k])
    want = sha([sha(v) for _, v in sorted(above.items())])
    rows = spark.createDataFrame([(x, f"v{x}") for x in at], "id long, v string")
    assert collection_digest(rows, ["id"], "v").first()["digest"] == want


def test_swept_runs_equal_swept_arrays(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for key in range(12):
        mask = rng.random((20, 30)) < 0.05
        mask[5 + key % 4, 3:9] = True
        rows += [(key, y, a, b) for y, a, b in sp.from_mask(mask)]
        want[key] = swept_support(mask, [(key * 3 - 17, 9 - key), (2, 13)])
    spans = spark.createDataFrame(rows, "k long, y int, x0 int, x1 int")
    deltas = [(F.col("k") * 3 - 17, 9 - F.col("k")), (F.lit(2), F.lit(13))]
    got = {}
    for r in sp.swept(spans, deltas, F.lit(30), F.lit(20), geo.MAX_STEP, geo.REPAIR_ROUNDS, "k").collect():
        got.setdefault(r["k"], []).append((r["y"], r["x0"], r["x1"]))
    assert all(np.array_equal(sp.to_mask(got[k], 20, 30), m) for k, m in want.items())


def test_motion_of_members_at_a_smaller_size():
    rng = np.random.default_rng(13)
    coarse = rng.random((80, 100))
    before = np.kron(coarse, np.ones((8, 8)))  # 640 by 800, so it is compared at 410 by 512
    after = np.roll(before, (16, -32), axis=(0, 1))
    one, two, tiny = (np.zeros(before.shape, dtype=bool) for _ in range(3))
    one[200:300, 200:280] = True
    two[400:470, 500:600] = True
    tiny[5, 5] = True
    found = geo.motions(before, after, [one, two, tiny], (-32, 16))
    assert [f["status"] for f in found] == ["appearance_match_only", "appearance_match_only", "unmeasurable"]
    assert all(f["residual"] < 3 and f["score"] > 0.95 for f in found[:2])
    flat = np.full(before.shape, 3.0)
    assert geo.motion(flat, after, one, (0, 0))["status"] == "unmeasurable"
    assert geo.motion(before, np.zeros_like(before), one, (0, 0))["status"] == "unmeasurable"  # no score has a value
    assert geo.motion(coarse, coarse[:4, :4], np.ones_like(coarse, dtype=bool), (0, 0))["status"] == "matching_error"


def test_a_member_may_not_vanish_on_the_grid():
    mask, speck = np.zeros((80, 120), dtype=bool), np.zeros((80, 120), dtype=bool)
    mask[20:50, 30:70] = True
    speck[20, 30] = True
    assert grid_geometry(mask, (30, 20), (8, 4), (mask,))["error"] is None
    assert grid_geometry(mask, (30, 20), (8, 4), (mask, speck))["error"] == "member"


def test_components_of_boxes_equal_those_of_their_pairs(spark):
    rng = np.random.default_rng(4)
    at = [(i, i % 3, *(float(v) for v in rng.choice([rng.random(2) * 60, np.floor(rng.random(2) * 12) * 5]))) for i in range(240)]
    at += [(900, None, 1.0, 1.0), (901, None, 1.0, 1.0), (902, 0, None, 1.0)]
    rows = [(i, f, x, y, None if x is None else x + float(rng.integers(4, 9)), y + float(rng.integers(4, 7))) for i, f, x, y in at]
    boxes = spark.createDataFrame(rows, "i long, f int, x0 double, y0 double, x1 double, y1 double")
    pairs = contacts.touching_boxes(boxes, "f", "i", 5.0)
    listed = [(r["i"], r["i2"]) for r in pairs.collect()]
    good = [r for r in rows if r[1] is not None and r[2] is not None]
    want = {(p[0], q[0]) for p in good for q in good if p[0] < q[0] and p[1] == q[1] and p[2] <= q[4] and q[2] <= p[4] and p[3] <= q[5] and q[3] <= p[5]}
    assert len(listed) == len(set(listed)) and set(listed) == want
    label = {r[0]: r[0] for r in rows}
    while any(label[a] != label[b] for a, b in want):
        for a, b in want:
            label[a] = label[b] = min(label[a], label[b])
    assert {r["i"]: r["component"] for r in contacts.box_components(boxes, "f", "i", 4.0).collect()} == label
    assert len(set(label.values())) > 10


def test_no_pair_of_boxes_is_told_twice_or_shuffled_after_it_is_found(spark):
    boxes = spark.createDataFrame([(1, 1, 0.0, 0.0, 9.0, 9.0), (1, 2, 1.0, 1.0, 9.0, 9.0)], "f int, i int, x0 double, y0 double, x1 double, y1 double")
    pairs = contacts.touching_boxes(boxes, "f", "i", 2.0)
    assert pairs.count() == 1 and "Aggregate" not in pairs._jdf.queryExecution().optimizedPlan().toString()
