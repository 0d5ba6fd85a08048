"""Masks on feature grids: bilinear resampling of runs, and the shared translation of a group, without pixels.

A grid cell takes two neighbouring pixels of a row, by weight, and two rows (centres aligned at the half). So a run of
pixels is, along a grid row, a run of full cells with a few partial ones at its ends: it is told by the cells where its value
changes. These changes, times the weight of the pixel row, are summed by cell, and their running sum along the grid row is
the resampled mask, as runs of equal value. Weights are single-precision fractions, whole multiples of 2^-24, so values
are whole numbers of 2^-48 and all sums are exact.

Scale: a run leaves at most eight changes for each of the few grid rows that it meets, however wide it is. A mask's changes
are made and summed in the task that holds the mask (:mod:`functions.rasters`) and are never rows of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import rasters
from sievewright.functions.geometry import feature_grid, fits, half_even
from sievewright.operators.spans import measures, packed, per_mask

#: The unit of a weight and of a value.
UNIT = 1 << 24
ONE = UNIT * UNIT
#: A value over a half, as a single-precision number is.
HALF = ONE // 2 + UNIT // 2


SIZES = ("width", "height", "grid_w", "grid_h")


def resampled(spans: DataFrame, *keys: str) -> DataFrame:
    """(keys, gy, g0, g1, value): disjoint runs [y, x0, x1) on the grid, as runs of equal value, of ONE; zeros are left out.

    ``spans`` also has width, height, grid_w and grid_h; the grid is no finer than the pixels.
    """

    def run(part, mask, y, x0, x1):
        sizes = (part.column(part.schema.get_field_index(s)).to_numpy() for s in SIZES)
        return rasters.resampled(mask, y, x0, x1, *sizes, UNIT)

    masks = packed(spans.where("grid_w > 0 and grid_h > 0"), *keys, *(F.col(s).cast("long").alias(s) for s in SIZES))
    return per_mask(masks, keys, ("gy", "g0", "g1", "value"), run, 8)


def grid_measures(runs: DataFrame, *keys: str) -> DataFrame:
    """Of each mask on the grid: cells over a half and their rounded centroid, and the box of all cells with any value."""
    seen = F.col("value") > HALF
    n = F.when(seen, F.col("g1") - F.col("g0")).otherwise(F.lit(0))
    total = F.sum(n)
    middle = lambda s: half_even(F.try_divide(F.sum(s), total)).cast("long")
    return runs.groupBy(*keys).agg(
        total.alias("cells"),
        middle(n * (F.col("g0") + F.col("g1") - 1) / 2).alias("start_x"),
        middle(n * F.col("gy")).alias("start_y"),
        F.min("g0").alias("gx_min"),
        (F.max("g1") - 1).alias("gx_max"),
        F.min("gy").alias("gy_min"),
        F.max("gy").alias("gy_max"),
    )


def framed(spans: DataFrame, frames: DataFrame, key: str) -> DataFrame:
    """Runs with the size of their frame (``frames``: key, width, height) and of its feature grid."""
    w, h = feature_grid(F.col("width"), F.col("height"))
    return spans.join(frames.select(key, "width", "height"), key).withColumns({"grid_w": w, "grid_h": h})


def footprints(spans: DataFrame, frames: DataFrame, key: str, members: DataFrame | None = None, member: str = "member") -> DataFrame:
    """One row a frame: its grid, the mask's box in pixels and on the grid, and how many members the grid doesn't show.

    ``spans`` are the disjoint runs of each frame's mask, ``members`` those of its members (also with ``member``). A frame
    without a mask has nulls.
    """
    w, h = feature_grid(F.col("width"), F.col("height"))
    out = frames.select(key, "width", "height").withColumns({"grid_w": w, "grid_h": h})
    out = out.join(measures(spans, key).select(key, "x_min", "x_max", "y_min", "y_max"), key, "left")
    out = out.join(grid_measures(resampled(framed(spans, frames, key), key), key), key, "left")
    lost = F.lit(0).cast("long").alias("lost")
    if members is None:
        return out.select("*", lost)
    shown = grid_measures(resampled(framed(members, frames, key), key, member), key, member).where("cells > 0").groupBy(key).agg(F.count("*").alias("_shown"))
    all_ = members.select(key, member).distinct().groupBy(key).agg(F.count("*").alias("_all"))
    counts = all_.join(shown, key, "left").select(key, (F.col("_all") - F.coalesce("_shown", F.lit(0))).alias("lost"))
    return out.join(counts, key, "left").withColumn("lost", F.coalesce("lost", F.lit(0)))


def translated(rows: DataFrame, dx: Column, dy: Column) -> DataFrame:
    """Footprints with the translation (dx, dy) of their mask on the grid (delta, end), or the reason why there is none.

    vanished: no cell over a half; member: one of the group isn't seen; zero: no step on the grid; leaving: the mask leaves
    the image, or any part of it the grid. Start, delta and end are null if there is an error.
    """
    step = lambda d, grid, size: half_even(d.cast("double") * F.col(grid) / F.col(size)).cast("long")
    gx, gy = step(dx, "grid_w", "width"), step(dy, "grid_h", "height")
    stays = fits(F.col("x_min"), F.col("x_max"), dx, F.col("width")) & fits(F.col("y_min"), F.col("y_max"), dy, F.col("height"))
    stays &= fits(F.col("gx_min"), F.col("gx_max"), gx, F.col("grid_w")) & fits(F.col("gy_min"), F.col("gy_max"), gy, F.col("grid_h"))
    error = F.when(F.coalesce(F.col("cells"), F.lit(0)) == 0, "vanished").when(F.col("lost") > 0, "member").when((gx == 0) & (gy == 0), "zero").when(~stays, "leaving")
    right = lambda c: F.when(F.col("error").isNull(), c)
    out = rows.withColumns({"error": error, "delta_x": gx, "delta_y": gy})
    out = out.withColumns({"end_x": right(F.col("start_x") + F.col("delta_x")), "end_y": right(F.col("start_y") + F.col("delta_y"))})
    return out.withColumns({c: right(F.col(c)) for c in ("start_x", "start_y", "delta_x", "delta_y")})
