"""Resampling of runs and grid geometry against arrays."""

from __future__ import annotations

import arrays
import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.functions import geometry as geo
from sievewright.operators import grids
from sievewright.operators import spans as sp

SIZES = [(120, 80), (131, 97), (641, 483), (720, 560), (1100, 960), (33, 50), (64, 64), (1919, 1079)]


def masks():
    rng = np.random.default_rng(3)
    out = {}
    for k, (w, h) in enumerate(SIZES):
        out[3 * k] = rng.random((h, w)) > (0.8 if w < 1000 else 0.97)
        out[3 * k + 1] = np.zeros((h, w), dtype=bool)
        a, b = int(rng.integers(0, w - 20)), int(rng.integers(0, h - 20))
        out[3 * k + 1][b : b + int(rng.integers(2, 20)), a : a + int(rng.integers(2, 20))] = True
        out[3 * k + 2] = np.zeros((h, w), dtype=bool)
    out[900] = np.ones((40, 12), dtype=bool)  # narrower than a stride: no grid
    return out


@pytest.fixture(scope="module")
def tables(spark):
    all_ = masks()
    spans = spark.createDataFrame([(k, *s) for k, m in all_.items() for s in sp.from_mask(m)], "k long, y int, x0 int, x1 int")
    frames = spark.createDataFrame([(k, m.shape[1], m.shape[0]) for k, m in all_.items()], "k long, width int, height int")
    return all_, spans, frames


def test_resampled_runs_equal_resampled_arrays_to_the_bit(tables):
    all_, spans, frames = tables
    got = {k: np.zeros(arrays.feature_grid(m.shape[1], m.shape[0])[::-1], dtype=np.float32) for k, m in all_.items()}
    for r in grids.resampled(grids.framed(spans, frames, "k"), "k").collect():
        assert 0 <= r["g0"] < r["g1"]
        got[r["k"]][r["gy"], r["g0"] : r["g1"]] += np.float32(r["value"] / grids.ONE)
    for k, m in all_.items():
        if min(got[k].shape):
            assert np.array_equal(got[k], arrays.bilinear(m, *got[k].shape))


def test_translations_on_the_grid(spark, tables):
    all_, spans, frames = tables
    rng = np.random.default_rng(4)
    deltas = {k: [(int(a), int(b)) for a, b in rng.integers(-60, 60, (25, 2))] + [(0, 0), (1, 0), (8, -4)] for k in all_}
    members = spans.withColumn("member", F.lit(1)).unionByName(spark.createDataFrame([(4, 2, 5, 5, 6)], "k long, member int, y int, x0 int, x1 int"))
    moves = spark.createDataFrame([(k, *d) for k, ds in deltas.items() for d in ds], "k long, dx int, dy int")
    rows = grids.translated(grids.footprints(spans, frames, "k", members).join(moves, "k"), F.col("dx"), F.col("dy")).collect()
    assert len(rows) == sum(map(len, deltas.values()))
    seen = set()
    for r in rows:
        mask = all_[r["k"]]
        grid = arrays.feature_grid(mask.shape[1], mask.shape[0])
        assert (r["grid_w"], r["grid_h"]) == grid
        speck = np.zeros_like(mask)
        if r["k"] == 4:
            speck[5, 5] = True
        want = arrays.grid_geometry(mask, grid, (r["dx"], r["dy"]), (mask, speck) if r["k"] == 4 else ()) if min(grid) else {"error": "vanished"}
        got = {"error": r["error"]} | ({} if r["error"] else {n: (r[f"{n}_x"], r[f"{n}_y"]) for n in ("start", "delta", "end")})
        assert got == want
        seen.add(r["error"])
    assert seen == {None, "vanished", "member", "zero", "leaving"}


def test_a_mask_may_leave_neither_image_nor_grid(spark):
    mask = np.zeros((80, 120), dtype=bool)
    mask[2:22, 42:60] = True
    spans = spark.createDataFrame([(1, *s) for s in sp.from_mask(mask)], "k long, y int, x0 int, x1 int")
    frames = spark.createDataFrame([(1, 120, 80)], "k long, width int, height int")
    place = grids.footprints(spans, frames, "k")
    assert grids.translated(place, F.lit(44), F.lit(-4)).first()["error"] == "leaving"
    assert grids.translated(place, F.lit(44), F.lit(-2)).first()["error"] is None


def test_drawn_displacements_are_the_generators_first_valid_ones(tables):
    all_, spans, frames = tables
    for r in grids.footprints(spans, frames, "k").collect():
        mask, rng = all_[r["k"]], np.random.default_rng(100 + r["k"])
        grid, want = arrays.feature_grid(mask.shape[1], mask.shape[0]), None
        ys, xs = np.nonzero(mask)
        for _ in range(64 if len(xs) and min(grid) else 0):
            dx = int(rng.integers(-int(xs.min()), mask.shape[1] - int(xs.max())))
            dy = int(rng.integers(-int(ys.min()), mask.shape[0] - int(ys.max())))
            if arrays.grid_geometry(mask, grid, (dx, dy))["error"] is None:
                want = (dx, dy)
                break
        assert geo.drawn_displacement({c: r[c] for c in geo.FOOTPRINT}, 100 + r["k"]) == want


def test_feature_grid_takes_whole_strides(spark):
    frames = spark.createDataFrame(SIZES, "w int, h int")
    assert [tuple(r) for r in frames.select(*geo.feature_grid(F.col("w"), F.col("h"))).collect()] == [arrays.feature_grid(*s) for s in SIZES]
    assert arrays.feature_grid(120, 80) == (56, 40)
