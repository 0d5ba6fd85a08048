"""Grid and region geometry. Column expressions where Spark has them, numpy for resampling and matching."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Feature grids take whole strides of an image; the scale grows with it (mean side over 1000, over 600, else).
STRIDE, SCALES = 16, ((1000, 4), (600, 3), (0, 2))
MAX_STEP, REPAIR_ROUNDS, MOTION_SIDE, LEAST_PIXELS = 8, 8, 512, 4


def feature_grid(width: Column, height: Column) -> tuple[Column, Column]:
    """Grid columns and rows: sides floored to whole strides, divided by a scale that their mean sets."""
    full = [F.floor(side / STRIDE) * STRIDE for side in (width, height)]
    mean = (full[0] + full[1]) / 2
    scale = F.lit(SCALES[-1][1])
    for least, value in reversed(SCALES[:-1]):
        scale = F.when(mean > least, F.lit(value)).otherwise(scale)
    return F.floor(full[0] / scale), F.floor(full[1] / scale)


def half_even(c: Column) -> Column:
    """Rounding as Python does; Spark's round() goes half up."""
    return F.bround(c, 0)


def fits(lo: Column, hi: Column, delta: Column, size: Column) -> Column:
    return (lo + delta >= 0) & (hi + delta < size)


def padded(lo: Column, hi: Column, size: Column, pad: float) -> tuple[Column, Column]:
    """A half-open interval widened on both sides by a rounded-up share of its length, clamped."""
    more = F.ceil((hi - lo) * F.lit(pad))
    return F.greatest(F.lit(0), lo - more), F.least(size, hi + more)


def to_original(at: Column, grid: Column, size: Column) -> Column:
    """A coordinate on the feature grid as one of the original image."""
    return at.cast("double") * size / grid


#: What :func:`operators.grids.footprints` says of a mask in its frame.
FOOTPRINT = ("width", "height", "grid_w", "grid_h", "x_min", "x_max", "y_min", "y_max", "cells", "gx_min", "gx_max", "gy_min", "gy_max", "lost")


def drawn_displacement(place: dict[str, int | None], seed: int, tries: int = 64) -> tuple[int, int] | None:
    """The first of some uniform translations inside the frame that the feature grid takes, too; None if none does."""
    if not place["cells"] or place["lost"]:
        return None
    rng = np.random.default_rng(seed)
    sides = (("x", "width", "grid_w"), ("y", "height", "grid_h"))
    for _ in range(tries):
        drawn = [int(rng.integers(-place[f"{a}_min"], place[size] - place[f"{a}_max"])) for a, size, _ in sides]
        steps = [round(d * place[grid] / place[size]) for d, (_, size, grid) in zip(drawn, sides, strict=True)]
        inside = all(0 <= place[f"g{a}_min"] + s and place[f"g{a}_max"] + s < place[grid] for s, (a, _, grid) in zip(steps, sides, strict=True))
        if any(steps) and inside:
            return drawn[0], drawn[1]
    return None


def masked_match(image: np.ndarray, template: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Masked normalised cross-correlation of a template at every position where it fits; NaN where the image is empty."""
    h, w = template.shape
    image = image.astype(np.float64)
    m2 = mask.astype(np.float64) ** 2
    t2 = float((template.astype(np.float64) ** 2 * m2).sum())
    size = tuple(a + b - 1 for a, b in zip(image.shape, (h, w), strict=True))

    def correlated(frame: np.ndarray, kernel: np.ndarray) -> np.ndarray:
        # By Fourier transform: memory is that of the frame, whatever the template's size.
        full = np.fft.irfft2(np.fft.rfft2(frame, size) * np.fft.rfft2(kernel[::-1, ::-1], size), size)
        return full[h - 1 : image.shape[0], w - 1 : image.shape[1]]

    cross, energy = correlated(image, template * m2), np.maximum(correlated(image**2, m2), 0)
    scale = np.sqrt(t2 * energy)
    least = 1e-6 * max(t2, 1e-300)
    return np.divide(cross, scale, out=np.full_like(cross, np.nan), where=scale > least)


def _shrunk(frame: np.ndarray, height: int, width: int) -> np.ndarray:
    """A gray frame at another size; a triangle that widens as the frame shrinks weighs the pixels."""

    def weights(n: int, m: int) -> np.ndarray:
        at = (np.arange(m) + 0.5) * n / m - 0.5
        w = np.maximum(0, 1 - np.abs(at[:, None] - np.arange(n)) / max(1.0, n / m))
        return w / w.sum(axis=1, keepdims=True)

    return weights(frame.shape[0], height) @ frame.astype(np.float64) @ weights(frame.shape[1], width).T


def motions(before: np.ndarray, after: np.ndarray, members: Sequence[np.ndarray], wanted: tuple[int, int], side: int = MOTION_SIDE) -> list[dict[str, object]]:
    """Where each member's part of ``before`` (gray) is found in ``after``, and how far that is from the wanted translation.

    Frames larger than ``side`` are compared at that size. A member of fewer than four pixels there, or without contrast,
    can't be measured, nor can one whose scores are all without value; a part larger than ``after`` is an error. It is a diagnosis: nothing is accepted by it.
    """
    h, w = before.shape
    factor = min(1.0, side / max(h, w))
    size = max(1, round(h * factor)), max(1, round(w * factor))
    if factor < 1:
        before, after = _shrunk(before, *size), _shrunk(after, *size)
    rows, columns = (((np.arange(m) + 0.5) * n / m).astype(int) for n, m in ((h, size[0]), (w, size[1])))
    return [_motion(before, after, mask[rows][:, columns], wanted, (size[1] / w, size[0] / h)) for mask in members]


def motion(before: np.ndarray, after: np.ndarray, mask: np.ndarray, wanted: tuple[int, int]) -> dict[str, object]:
    """:func:`motions` of one mask."""
    return motions(before, after, [mask], wanted)[0]


def _motion(before: np.ndarray, after: np.ndarray, mask: np.ndarray, wanted: tuple[int, int], scale: tuple[float, float]) -> dict[str, object]:
    nothing = {"dx": None, "dy": None, "residual": None, "score": None}
    ys, xs = np.nonzero(mask)
    if len(xs) < LEAST_PIXELS or float(before[mask].std()) <= 1e-6:
        return {"status": "unmeasurable", **nothing}
    box = np.s_[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1]
    if any(a < b for a, b in zip(after.shape, mask[box].shape, strict=True)):
        return {"status": "matching_error", **nothing}
    scores = masked_match(after, before[box], mask[box])
    if not np.isfinite(scores).any():
        return {"status": "unmeasurable", **nothing}
    y, x = np.unravel_index(int(np.where(np.isfinite(scores), scores, -np.inf).argmax()), scores.shape)
    dx, dy = (int(x) - int(xs.min())) / scale[0], (int(y) - int(ys.min())) / scale[1]
    residual = float(np.hypot(dx - wanted[0], dy - wanted[1]))
    return {"status": "appearance_match_only", "dx": dx, "dy": dy, "residual": residual, "score": float(scores[y, x])}
