"""Outline simplification of one ring; used inside an Arrow batch function."""

from __future__ import annotations

import numpy as np


def simplify_ring(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Drop vertices that lie within ``tolerance`` of the simplified line.

    Ramer-Douglas-Peucker with an explicit stack. A ring that would keep
    fewer than four vertices is returned unchanged.
    """
    n = len(points)
    if n < 3:
        return points
    keep = np.zeros(n, dtype=bool)
    keep[0] = keep[-1] = True
    spans = [(0, n - 1)]
    while spans:
        first, last = spans.pop()
        if last - first < 2:
            continue
        inner = points[first + 1 : last] - points[first]
        chord = points[last] - points[first]
        length = float(np.hypot(chord[0], chord[1]))
        if length > 0:
            away = np.abs(chord[0] * inner[:, 1] - chord[1] * inner[:, 0]) / length
        else:
            away = np.hypot(inner[:, 0], inner[:, 1])
        far = int(np.argmax(away))
        if away[far] > tolerance:
            split = first + 1 + far
            keep[split] = True
            spans += [(first, split), (split, last)]
    return points[keep] if int(keep.sum()) >= 4 else points
