"""Mask operations on boolean arrays, to test those on runs against."""

from __future__ import annotations

import numpy as np

from sievewright.functions.geometry import MAX_STEP, REPAIR_ROUNDS


def bilinear(mask, height, width):
    """Bilinear resampling with pixel centres aligned at the half: positions in single precision, sums in double, rounded once."""

    def taps(n, m):
        at = np.clip((np.arange(m, dtype=np.float32) + np.float32(0.5)) * np.float32(n / m) - np.float32(0.5), 0, n - 1)
        low = at.astype(int)
        return low, np.minimum(low + 1, n - 1), at.astype(float) - low

    (y0, y1, fy), (x0, x1, fx) = taps(mask.shape[0], height), taps(mask.shape[1], width)
    m = mask.astype(float)
    across = m[:, x0] * (1 - fx) + m[:, x1] * fx
    return (across[y0] * (1 - fy[:, None]) + across[y1] * fy[:, None]).astype(np.float32)


def feature_grid(width, height):
    full = width - width % 16, height - height % 16
    scale = 4 if sum(full) > 2000 else 3 if sum(full) > 1200 else 2
    return full[0] // scale, full[1] // scale


def stays(mask, dx, dy):
    """No part of a mask leaves its frame."""
    ys, xs = np.nonzero(mask)
    return len(xs) > 0 and xs.min() + dx >= 0 and xs.max() + dx < mask.shape[1] and ys.min() + dy >= 0 and ys.max() + dy < mask.shape[0]


def grid_geometry(mask: np.ndarray, grid: tuple[int, int], delta: tuple[int, int], members: tuple[np.ndarray, ...] = ()) -> dict[str, object]:
    """Start and end of a shared translation on the feature grid, or the reason why there is none. (x, y) order.

    Every member of the group must be seen on the grid.
    """
    height, width = mask.shape
    values = bilinear(mask, grid[1], grid[0])
    if not (values > 0.5).any():
        return {"error": "vanished"}
    if not all((bilinear(m, grid[1], grid[0]) > 0.5).any() for m in members):
        return {"error": "member"}
    ys, xs = np.nonzero(values > 0.5)
    start = (round(float(xs.mean())), round(float(ys.mean())))
    step = (round(delta[0] * grid[0] / width), round(delta[1] * grid[1] / height))
    if step == (0, 0):
        return {"error": "zero"}
    if not stays(mask, *delta) or not stays(values > 0, *step):
        return {"error": "leaving"}
    return {"error": None, "start": start, "delta": step, "end": (start[0] + step[0], start[1] + step[1])}


def shifted(mask: np.ndarray, dx: int, dy: int) -> np.ndarray:
    """Translation with clipping."""
    out = np.zeros_like(mask)
    h, w = mask.shape
    if abs(dx) < w and abs(dy) < h:
        out[max(0, dy) : min(h, h + dy), max(0, dx) : min(w, w + dx)] = mask[max(0, -dy) : min(h, h - dy), max(0, -dx) : min(w, w - dx)]
    return out


def swept_support(mask: np.ndarray, deltas: list[tuple[int, int]]) -> np.ndarray:
    """What the mask sweeps over on its way along each delta, in steps of bounded length, grown by a diamond."""
    out = mask.copy()
    for dx, dy in deltas:
        steps = max(1, -(-max(abs(dx), abs(dy)) // MAX_STEP))
        for i in range(steps + 1):
            out |= shifted(mask, round(dx * i / steps), round(dy * i / steps))
    for _ in range(REPAIR_ROUNDS):
        out = out | shifted(out, 1, 0) | shifted(out, -1, 0) | shifted(out, 0, 1) | shifted(out, 0, -1)
    return out
