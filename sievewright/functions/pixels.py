"""Pixel operations on numpy frames: cutouts, crops, letterboxing."""

from __future__ import annotations

import numpy as np

GRAY = 127


def cutout(frame: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The masked foreground on gray."""
    return np.where(mask[..., None], frame, np.uint8(GRAY))


def padded_crop(frame: np.ndarray, mask: np.ndarray, pad: float) -> np.ndarray:
    """The mask's box, widened by a rounded-up share of its sides and clamped to the frame."""
    ys, xs = np.nonzero(mask)
    if not len(xs):
        raise ValueError("empty mask")
    out = []
    for points, size in ((ys, frame.shape[0]), (xs, frame.shape[1])):
        lo, hi = int(points.min()), int(points.max()) + 1
        more = int(np.ceil((hi - lo) * pad))
        out.append(slice(max(0, lo - more), min(size, hi + more)))
    return frame[out[0], out[1]]


def _cubic(x: np.ndarray, a: float = -0.5) -> np.ndarray:
    x = np.abs(x)
    near = (a + 2) * x**3 - (a + 3) * x**2 + 1
    far = a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


def _weights(n: int, m: int) -> np.ndarray:
    """Bicubic weights of m outputs over n inputs; shrinking widens the kernel."""
    scale = max(1.0, n / m)
    at = (np.arange(m) + 0.5) * n / m - 0.5
    w = _cubic((at[:, None] - np.arange(n)[None, :]) / scale)
    return w / w.sum(axis=1, keepdims=True)


def bicubic(frame: np.ndarray, height: int, width: int) -> np.ndarray:
    y, x = _weights(frame.shape[0], height), _weights(frame.shape[1], width)
    out = np.einsum("ah,hwc,bw->abc", y, frame.astype(np.float64), x)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def letterbox(frame: np.ndarray, side: int) -> np.ndarray:
    """The whole frame, scaled to fit a gray square and centred."""
    h, w = frame.shape[:2]
    scale = side / max(h, w)
    inner = max(1, round(h * scale)), max(1, round(w * scale))
    out = np.full((side, side, frame.shape[2]), GRAY, dtype=np.uint8)
    top, left = (side - inner[0]) // 2, (side - inner[1]) // 2
    out[top : top + inner[0], left : left + inner[1]] = bicubic(frame, *inner)
    return out


def arrow(start: tuple[float, float], end: tuple[float, float], size: tuple[int, int], head: float = 12.0, spread: float = np.pi / 7) -> list[tuple[float, float]]:
    """Shaft and wings of an arrow, clamped to the frame: start, end, wing, wing."""
    angle = np.arctan2(end[1] - start[1], end[0] - start[0])
    points = [start, end, *((end[0] - head * np.cos(angle + s), end[1] - head * np.sin(angle + s)) for s in (-spread, spread))]
    return [(float(np.clip(x, 0, size[0] - 1)), float(np.clip(y, 0, size[1] - 1))) for x, y in points]
