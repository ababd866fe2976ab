"""T-3: seasonal-trend decomposition by locally weighted regression (Cleveland and others, 1990), in numpy over one block.

All points of a smoother are fitted at once: windows of `span` neighbours are rows of one array, and a local line needs
five weighted sums of each row.
"""

from functools import lru_cache

import numpy as np

DAY, PIECE, ROUNDING = 24, 2048, 1e-12
SEASONAL, INNER, OUTER = 7, 2, 15


def odd_from(x: float) -> int:
    """The least odd number that is not below x."""
    k = int(np.ceil(x))
    return k + 1 - k % 2


@lru_cache(maxsize=32)
def neighbours(n: int, span: int, beyond: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the points from first to last (0: `beyond` before the series): their places, their windows, tricube weights."""
    width = min(span, n)
    at = np.arange(first, last) - beyond
    window = np.clip(at - (width - 1) // 2, 0, n - width)[:, None] + np.arange(width)
    far = np.abs(window - at[:, None])
    reach = far.max(1, keepdims=True) + (max(span - n, 0)) // 2
    ratio = far / np.maximum(reach, 1)
    return at, window, np.where(far <= 0.001 * reach, 1.0, np.where(far <= 0.999 * reach, (1 - ratio**3) ** 3, 0.0))


def loess(y: np.ndarray, span: int, weights: np.ndarray, beyond: int = 0) -> np.ndarray:
    """Local lines along the last axis of y (series in rows), each by its `span` nearest points with tricube weights times
    `weights`; `beyond` points are added at either end. Where all weights are zero the value itself stands (beyond the
    ends: the nearest one). PIECE points are fitted at once, so memory does not grow with the series."""
    n = y.shape[-1]
    return np.concatenate([_lines(y, weights, *neighbours(n, span, beyond, k, min(k + PIECE, n + 2 * beyond))) for k in range(0, n + 2 * beyond, PIECE)], axis=-1)


def _lines(y, weights, at, window, near):
    n = y.shape[-1]
    w, v = weights[..., window] * near, y[..., window]
    total = w.sum(-1)
    some = np.where(total > 0, total, 1.0)
    first = np.einsum("...k,...k->...", w, np.broadcast_to(window - at[:, None], w.shape).astype(float)) / some
    off = (window - at[:, None]) - first[..., None]  # from the weighted centre
    lean = w * off
    spread = np.einsum("...k,...k->...", lean, off) / some
    tilted = np.sqrt(spread) > 0.001 * (n - 1)
    turn = np.where(tilted, -first / np.where(tilted, spread, 1.0), 0.0)
    fit = (np.einsum("...k,...k->...", w, v) + turn * np.einsum("...k,...k->...", lean, v)) / some
    return np.where(total > 0, fit, y[..., np.clip(at, 0, n - 1)])


def moving(y: np.ndarray, width: int) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(y)])
    return (total[width:] - total[:-width]) / width


def cycles(y: np.ndarray, period: int, span: int, weights: np.ndarray) -> np.ndarray:
    """Each phase's own series smoothed and led on by one cycle at either end: n + 2 * period values. Phases of one length
    are the rows of one call; there are two lengths at most."""
    n = len(y)
    out = np.empty(n + 2 * period)
    cut = n % period or period
    for phases in (np.arange(cut), np.arange(cut, period)):
        if len(phases):
            at = phases[:, None] + period * np.arange((n - 1 - phases[0]) // period + 1)
            goal = phases[:, None] + period * np.arange(at.shape[1] + 2)
            out[goal] = loess(y[at], span, weights[at], 1)
    return out


def bisquare(rest: np.ndarray, unit: float) -> np.ndarray:
    """Weights by the size of residuals against six times their median. Residuals within ROUNDING of the largest value are
    none: a series of two periods is fitted exactly, and its weights would be those of rounding errors."""
    size = np.abs(rest)
    size = np.where(size <= ROUNDING * unit, 0.0, size)
    limit = 6 * np.median(size)
    u = size / limit if limit > 0 else np.where(size > 0, 1.0, 0.0)
    return np.where(size <= 0.001 * limit, 1.0, np.where(size <= 0.999 * limit, (1 - u * u) ** 2, 0.0))


def decompose(y: np.ndarray, period: int = DAY, seasonal: int = SEASONAL, inner: int = INNER, outer: int = OUTER) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Trend, season and rest of evenly spaced values without gaps; None below two periods."""
    y = np.asarray(y, float)
    n = len(y)
    if n < 2 * period:
        return None
    slow, low = odd_from(1.5 * period / (1 - 1.5 / seasonal)), odd_from(period + 1)
    weights, even = np.ones(n), np.ones(n)
    trend = np.zeros(n)
    for _ in range(outer + 1):
        for _ in range(inner):
            turns = cycles(y - trend, period, seasonal, weights)
            drift = loess(moving(moving(moving(turns, period), period), 3), low, even)
            season = turns[period:-period] - drift
            trend = loess(y - season, slow, weights)
        weights = bisquare(y - trend - season, float(np.abs(y).max()))
    return trend, season, y - trend - season


def hourly(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Means of each hour since the first reading, gaps filled along lines; of readings at one time the first counts."""
    x, keep = np.unique(x, return_index=True)
    hour = np.floor(x - x[0]).astype(np.int64)
    sums, n = np.bincount(hour, y[keep]), np.bincount(hour)
    there = np.flatnonzero(n)
    return np.interp(np.arange(len(n)), there, sums[there] / n[there])
