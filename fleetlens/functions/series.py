"""Numerics of one time series, as small numpy functions for use inside grouped pandas functions. Times are hours."""

from dataclasses import dataclass, field

import numpy as np

from fleetlens.functions import decompose as D

HORIZONS = {"1h": 1, "6h": 6, "24h": 24, "7d": 168, "30d": 720}
DAY = 24
BOOTSTRAPS, SEED, Z = 200, 42, 1.28
LEAST_TRAIN, LEAST_HOLDOUT, MOST_HOLDOUT, HOLDOUT = 8, 3, 14, 0.2
FOLDS, TIE, FLOOR, SEASONAL_GATE = 4, 0.02, 0.01, 0.3
FALLBACK = "naive_persistence_fallback"
LONG = 72


def line(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """T-1: slope and intercept by least squares; flat without a spread of times."""
    if len(x) < 2 or np.ptp(x) < 1e-9:
        return 0.0, float(y.mean()) if len(y) else 0.0
    dx = x - x.mean()
    slope = float(dx @ (y - y.mean()) / (dx @ dx))
    return slope, float(y.mean() - slope * x.mean())


def bootstrap_slope(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """T-2: median, 5th and 95th percentile of slopes over resamples, all drawn at once."""
    if len(x) < 4 or np.ptp(x) < 1e-9:
        return (line(x, y)[0],) * 3
    pick = np.random.default_rng(SEED).integers(0, len(x), (BOOTSTRAPS, len(x)))
    xs, ys = x[pick], y[pick]
    dx = xs - xs.mean(1, keepdims=True)
    ok = np.ptp(xs, axis=1) >= 1e-9
    slopes = (dx * ys).sum(1)[ok] / (dx * dx).sum(1)[ok]
    return (float(np.median(slopes)), *map(float, np.percentile(slopes, [5, 95]))) if ok.any() else (line(x, y)[0],) * 3


def smoothed(y: np.ndarray, alpha: float) -> np.ndarray:
    """T-4: exponentially smoothed levels, the first being the first value."""
    out = np.array(y, float)
    for i in range(1, len(out)):
        out[i] += (1 - alpha) * (out[i - 1] - out[i])
    return out


def phase(x: np.ndarray) -> np.ndarray:
    return np.mod(np.rint(x).astype(np.int64), DAY)


def seasonal(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """T-5: median, p10 and p90 of each target hour's phase; the overall median for a phase seen less than twice."""
    own, middle = phase(x), float(np.median(y))
    rows = [np.percentile(v, [50, 10, 90]) if len(v := y[own == p]) >= 2 else (middle,) * 3 for p in phase(at)]
    return tuple(np.array(rows).reshape(-1, 3).T)


def drift(y: np.ndarray, share: float = 0.2) -> str:
    """W-10: how the second half's median stands to the first's."""
    if len(y) < 8:
        return "stable"
    a, b = np.median(y[: len(y) // 2]), np.median(y[len(y) // 2 :])
    change = (b - a) / max(abs(a), 1e-6)
    return "increasing" if change > share else "decreasing" if change < -share else "stable"


def holdout(n: int) -> int:
    """W-7: points to hold out, 0 where too few would be left."""
    k = int(np.clip(np.rint(n * HOLDOUT), LEAST_HOLDOUT, MOST_HOLDOUT))
    return k if n - k >= LEAST_TRAIN else 0


def scale(y: np.ndarray, season: int | None = None) -> tuple[float | None, bool]:
    """T-17: mean absolute step (seasonal with two seasons of data), floored at 1 % of the mean size; whether floored."""
    lag = season if season and len(y) >= 2 * season else 1
    steps = np.abs(y[lag:] - y[:-lag])
    if not len(steps):
        return None, False
    raw, size = float(steps.mean()), float(np.abs(y).mean())
    if size <= 1e-9:
        return (raw, False) if raw > 1e-9 else (None, False)
    return (FLOOR * size, True) if raw < FLOOR * size else (raw, False)


def quality(mase: float | None, coverage: float | None) -> float:
    """T-18."""
    a = 50.0 if mase is None else float(np.clip(100 - 50 * mase, 0, 100))
    if coverage is None:
        b = 50.0
    else:
        b = 100.0 if 60 <= coverage <= 95 else max(0.0, 100 - 4 * (coverage - 95)) if coverage > 95 else coverage / 0.6
    return round(0.7 * a + 0.3 * b, 1)


# ---------------------------------------------------------------- candidates: (train x, train y, target x) -> Guess


@dataclass
class Guess:
    point: np.ndarray
    noise: float = 0.0
    #: Of the linear family: lowest and highest slope, and where lines start.
    fan: tuple | None = None
    band: tuple | None = None


def naive(x, y, at):
    """T-6."""
    return Guess(np.full(len(at), y[-1]), float(np.std(np.diff(y))) if len(y) > 1 else 0.0)


def moving_average(x, y, at):
    """T-7."""
    tail = y[-int(np.clip(len(y) // 2, 3, 7)) :]
    return Guess(np.full(len(at), tail.mean()), float(tail.std()))


def regression(x, y, at):
    """T-8: a line through the last value."""
    mid, low, high = bootstrap_slope(x, y)
    return Guess(y[-1] + mid * (at - x[-1]), float(np.std(y - y[-1] - mid * (x - x[-1]))), (low, high, y[-1], x[-1]))


def holt(x, y, at, alpha=0.3, beta=0.1):
    """T-9."""
    if len(y) < 2:
        return None
    level, slope, ahead = y[0], y[1] - y[0], [y[0]]
    for value in y[1:]:
        ahead.append(level + slope)
        new = ahead[-1] + alpha * (value - ahead[-1])
        level, slope = new, slope + beta * (new - level - slope)
    step = float(np.median(np.diff(x)))
    return Guess(level + slope * (at - x[-1]) / (step if step > 1e-9 else 1.0), float(np.std(y - np.array(ahead))))


def theta(x, y, at, alpha=0.2):
    """T-10: half a trend line, half the smoothed curve of doubled deviations from it."""
    if len(y) < 4:
        return None
    slope, start = line(x, y)
    trend = start + slope * x
    levels = smoothed(2 * y - trend, alpha)
    before = np.concatenate([levels[:1], levels[:-1]])
    return Guess((start + slope * at + levels[-1]) / 2, float(np.std(y - (trend + before) / 2)))


def croston(x, y, at, alpha=0.1):
    """T-11: mean demand over mean interval, for series with many zeros but not nearly all."""
    sales = np.flatnonzero(y)
    if len(sales) < 3 or not 0.3 <= 1 - len(sales) / len(y) <= 0.9:
        return None
    size, wait = smoothed(y[sales], alpha)[-1], smoothed(np.diff(sales, prepend=-1).astype(float), alpha)[-1]
    rate = size / wait if wait > 1e-9 else 0.0
    return Guess(np.full(len(at), rate), float(np.std(y - rate)))


def trend(x, y, at):
    """T-12: a line along the decomposed trend (T-3) of hourly means, for long series."""
    if len(y) < LONG:
        return None
    parts = D.decompose(D.hourly(x, y), DAY)
    if parts is None:
        return None
    slow, _, rest = parts
    own = np.linspace(x[0], x[-1], len(slow))
    mid, low, high = bootstrap_slope(own, slow)
    return Guess(slow[-1] + mid * (at - x[-1]), float(np.std(rest)), (low, high, float(slow[-1]), x[-1]))


def seasonal_naive(x, y, at):
    if len(y) < 2 * DAY:
        return None
    point, low, high = seasonal(x, y, at)
    return Guess(point, band=(np.minimum(low, high), np.maximum(low, high)))


#: The simplest first; among near-equals the first wins.
CANDIDATES = {"naive_persistence": naive, "moving_average": moving_average, "croston": croston, "linear_regression": regression, "theta": theta, "ets_trend": holt, "trend": trend, "seasonal_naive": seasonal_naive}


def band(guess: Guess, y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """T-13: lower and upper bounds, and whether the noise was raised to its floor."""
    if guess.band is not None:
        return *guess.band, False
    size = float(np.abs(y).mean())
    floored = size > 1e-9 and guess.noise < FLOOR * size
    margin = Z * (FLOOR * size if floored else guess.noise)
    if guess.fan:
        low, high, base, start = guess.fan
        a, b = base + low * (at - start) - margin, base + high * (at - start) + margin
    else:
        a, b = guess.point - margin, guess.point + margin
    return np.minimum(a, b), np.maximum(a, b), floored


def autocorrelation(y: np.ndarray, lag: int) -> float:
    if len(y) < lag + 2:
        return 0.0
    a, b = y[:-lag], y[lag:]
    return 0.0 if a.std() < 1e-9 or b.std() < 1e-9 else float(np.corrcoef(a, b)[0, 1])


def level_break(x: np.ndarray, y: np.ndarray, season: int | None = None, edge: int = 8, reach: int = 6, sure: float = 4.0, still: float = 2.5, left: int = 16) -> int | None:
    """T-14: where the level shifts most, if that is sure, lasts to the end and leaves enough points; else None.

    Means of up to `reach` points on either side of every split are compared at once through running sums, in units of
    a robust noise of the detrended steps. A season that shows in the residual makes the test abstain.
    """
    n = len(y)
    if n < 2 * edge:
        return None
    slope, start = line(x, y)
    res = y - start - slope * x
    if season and len(res) > season and autocorrelation(res, season) > SEASONAL_GATE:
        return None
    steps = np.diff(res)
    noise = 1.4826 * float(np.median(np.abs(steps - np.median(steps))))
    noise = noise if noise >= 1e-9 else 1e-6
    at = np.arange(edge, n - edge)
    if not len(at):
        return None
    width = np.minimum(reach, np.minimum(at, n - at))
    total = np.concatenate([[0.0], np.cumsum(res)])
    before, after = (total[at] - total[at - width]) / width, (total[at + width] - total[at]) / width
    strength = np.abs(before - after) / (noise * np.sqrt(2 / width))
    k = int(strength.argmax())
    if strength[k] < sure or n - at[k] < left:
        return None
    end = float(res[-reach:].mean())
    lasting = abs(end - before[k]) / (noise * np.sqrt(1 / width[k] + 1 / reach))
    return int(at[k]) if lasting >= still and (end - before[k]) * (after[k] - before[k]) >= 0 else None


@dataclass
class Choice:
    method: str
    point: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    floored: bool
    skill: float | None = None
    trimmed: int = 0
    folds: int = 0
    errors: dict = field(default_factory=dict)


def fold_starts(n: int, size: int) -> list[int]:
    """W-8: up to four expanding folds, the earliest first; one at least."""
    return [s for s in range(n - size, LEAST_TRAIN - 1, -size)][:FOLDS][::-1] or [n - size]


def choose(x: np.ndarray, y: np.ndarray, at: np.ndarray, season: int = DAY) -> Choice:
    """T-15: the candidate with the least mean error over folds inside the data, refitted on all of it. What lies before
    a break is left out if enough is left to validate on."""
    trimmed = level_break(x, y, season) or 0
    if trimmed and not holdout(len(x) - trimmed):
        trimmed = 0
    x, y = x[trimmed:], y[trimmed:]
    size = holdout(len(x))
    if not size:
        guess = regression(x, y, at)
        return Choice("trend_fallback_insufficient_data", guess.point, *band(guess, y, at))
    starts = fold_starts(len(x), size)
    errors = {}
    for name, candidate in CANDIDATES.items():
        tries = [(candidate(x[:s], y[:s], x[s : s + size]), y[s : s + size]) for s in starts]
        found = [float(np.abs(truth - g.point).mean()) for g, truth in tries if g is not None]
        if found:
            errors[name] = float(np.mean(found))
    best = min(errors.values())
    method = next(m for m in CANDIDATES if errors.get(m, np.inf) <= max(best * (1 + TIE), best + 1e-9))
    guess = CANDIDATES[method](x, y, at)
    if guess is None:  # it suits the folds, not the whole
        method, guess = FALLBACK, naive(x, y, at)
    base = errors.get("naive_persistence", 0.0)
    skill = float(np.clip(1 - best / base, 0, 1)) if base > 1e-12 else None
    return Choice(method, guess.point, *band(guess, y, at), skill, trimmed, len(starts), errors)


def backtest(x: np.ndarray, y: np.ndarray, bursty: bool = False) -> dict | None:
    """T-16: errors of the chosen method on held-out last points; None where too few are there."""
    k = holdout(len(x))
    if not k:
        return None
    choice = choose(x[:-k], y[:-k], x[-k:])
    unit, unit_floored = scale(y[:-k], DAY if bursty and len(y) - k >= 2 * DAY else None)
    miss = y[-k:] - choice.point
    mae = float(np.abs(miss).mean())
    mase = None if unit is None else mae / unit
    coverage = float(((y[-k:] >= choice.lower) & (y[-k:] <= choice.upper)).mean() * 100)
    return {
        "holdout_n": k, "mae": mae, "rmse": float(np.sqrt((miss**2).mean())), "mase": mase, "coverage_pct": coverage,
        "low_variance": unit_floored or choice.floored, "method": choice.method, "trimmed": choice.trimmed, "folds": choice.folds, "quality": quality(mase, coverage),
    }


# ---------------------------------------------------------------- live forecast


@dataclass
class Prior:
    slope: float | None = None
    pool: int = 0
    populated: bool = False

    def tier(self) -> str:
        """T-21."""
        return "type_pooled" if self.populated else "category_pooled"

    def shrink(self, slope: float, n: int, spread: float) -> float:
        """T-20: towards the pool's slope while points are few."""
        if self.slope is None or n >= 20:
            return slope
        w = n / (n + 15)
        return w * slope + (1 - w) * self.slope * spread


def trimmed_zeros(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, str]:
    """W-13: trailing zeros go where zeros are common but not nearly all."""
    zeros = float((y == 0).mean())
    if zeros > 0.8:
        return x, y, "idle"
    if zeros <= 0.2:
        return x, y, "ok"
    real = np.flatnonzero(y)
    end = real[-1] + 1 if len(real) >= 5 else len(y)
    return x[:end], y[:end], "cleaned"


def three(point, lower, upper, method, r2=0.0, trend="stable", reliability="low", tier="individual", note="ok") -> dict:
    return {"point": np.asarray(point, float), "lower": np.asarray(lower, float), "upper": np.asarray(upper, float), "method": method, "r2": float(r2), "trend": trend, "reliability": reliability, "tier": tier, "note": note}


def direction(change: float, limit: float) -> str:
    return "increasing" if change > limit else "decreasing" if change < -limit else "stable"


def pool_trust(pool: int) -> str:
    return "high" if pool >= 10 else "medium-high" if pool >= 5 else "medium"


def fit_share(y: np.ndarray, fitted: np.ndarray, flat: float = 0.0) -> float:
    total = float(((y - y.mean()) ** 2).sum())
    return flat if total < 1e-9 else float(np.clip(1 - ((y - fitted) ** 2).sum() / total, 0, 1))


def live(x: np.ndarray, y: np.ndarray, bursty: bool, percent: bool, mixed: bool, prior: Prior) -> dict:
    """T-22: forecast at the five horizons. The branches, the first that holds: too few points (with or without a
    prior), flat, bursty by season, bursty by smoothing, the chosen candidate, a shrunk line."""
    hours = np.array(list(HORIZONS.values()), float)
    now = float(y[-1])
    flat = np.full(len(hours), now)
    if len(y) < 5:
        if prior.slope is None:
            return three(flat, flat, flat, "none", note=f"insufficient_points_{len(y)}")
        spread = float(np.ptp(y)) if len(y) > 1 else abs(now) * 0.1
        slope = prior.slope * (spread or abs(now) * 0.1 or 1.0)
        margin = np.abs(slope * hours * 0.25)
        return three(now + slope * hours, now + slope * hours - margin, now + slope * hours + margin, "pooled_type_prior", min(0.85, 0.3 + prior.pool / 20), direction(slope, 0.01), pool_trust(prior.pool), prior.tier(), f"insufficient_points_{len(y)}_pooled")
    x, y, note = trimmed_zeros(x, y)
    if len(y) < 2:
        return three(flat, flat, flat, "none", note="all_zeros_after_cleaning")
    spread, current = float(np.ptp(y)), float(y[-1])
    unit = (y - y.min()) / spread if spread > 0 else np.zeros(len(y))
    if unit.std(ddof=1) < 0.01:
        note = "mixed_stat_fields" if mixed else note
        if prior.slope is not None and spread > 0:
            margin = abs(prior.slope * spread * 0.5)
            return three(flat, flat - margin, flat + margin, "flat_signal", min(0.75, 0.2 + prior.pool / 25), "stable", pool_trust(prior.pool), prior.tier(), note)
        idle = note == "idle"
        return three(flat, flat, flat, "flat_signal", float(idle), "stable", "high" if idle else "low", note=note)
    top = 100.0 if percent else np.inf
    trust = lambda c: "high" if c >= 0.65 else "moderate" if c >= 0.25 else "low"
    if bursty and not mixed and len(y) >= 48:
        point, low, high = (np.clip(v, 0, top) for v in seasonal(x, y, x[-1] + hours))
        own = phase(x)
        fitted = np.array([np.median(y[own == p]) for p in range(DAY)] if len(own) else [])[own]
        r2 = fit_share(y, fitted)
        return three(point, np.minimum(low, high), np.maximum(low, high), "seasonal_naive_baseline", r2, drift(y), trust(r2), note=note)
    if bursty and not mixed:
        level = smoothed(y, 0.3)[-1]
        tail = y[-max(3, len(y) // 4) :]
        index = np.arange(len(tail), dtype=float)
        _, low, high = bootstrap_slope(index, tail)
        mid, low, high = (prior.shrink(s, len(y), spread) for s in (line(index, tail)[0], low, high))
        steps = hours / max(float(x[-1] - x[-2]), 0.001)
        pooled = prior.slope is not None and len(y) < 20
        r2 = fit_share(unit, smoothed(unit, 0.3))
        trend = direction(mid, 0.05 * (level if level > 0 else 1))
        return three(*(np.clip(level + s * steps, 0, top) for s in (mid, low, high)), "shrunk_slope_xgboost_prior" if pooled else "exponential_smoothing", r2, trend, trust(r2), prior.tier() if pooled else "individual", note)
    least = max(0.0, float(y.min()) * 0.9) if percent else 0.0
    clip = lambda v: np.clip(v, least, top)
    limit = 0.02 if len(y) >= 72 else 0.05
    room = max(spread, 1.0)
    if holdout(len(y)):
        c = choose(x, y, x[-1] + hours)
        point, a, b = clip(c.point), clip(c.lower), clip(c.upper)
        skill = 0.5 if c.skill is None else c.skill
        return three(point, np.minimum(a, b), np.maximum(a, b), f"adaptive_{c.method}" + "_post_break" * bool(c.trimmed), skill, direction((point[2] - current) / room, limit), trust(skill), note="adaptive_selection_no_pooling_shrink")
    slopes = [prior.shrink(s, len(y), spread) for s in bootstrap_slope(x, y)]
    pooled = prior.slope is not None and len(y) < 20
    slope, start = line(x, unit)
    r2 = fit_share(unit, start + slope * x, 1.0)
    trend = direction(slopes[0] / room, limit)
    if trend == "stable":
        wobble = float(y.std()) / max(abs(float(y.mean())), 1.0)
        r2 = max(r2, 1 - wobble / 0.05 * 0.2) if wobble < 0.05 else r2
    margin = Z * float(np.std(y - current - slopes[0] * (x - x[-1])))
    point, a, b = (clip(current + s * hours + m) for s, m in zip(slopes, (0, -margin, margin), strict=True))
    return three(point, np.minimum(a, b), np.maximum(a, b), "shrunk_slope_xgboost_prior" if pooled else "linear_regression_bootstrap", r2, trend, trust(r2), prior.tier() if pooled else "individual", note)
