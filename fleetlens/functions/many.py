"""The numerics of functions/series.py for many series of one length at once: a series is a row of x and of y.

Steps follow those of series.py, so results are the same but for the last digits of a sum. Resamples are drawn from one seed, so
those of a length are drawn once. Series longer than MOST, or with values that aren't below FAR, are left to series.py, one
by one; so are decompositions and seasonal medians, which need 72 and 48 points.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from fleetlens.functions import series as S

#: Longer series, and those with values of that size or none, aren't for this module; BLOCK values of resamples are held at once.
MOST, FAR, BLOCK = 256, 1e100, 1 << 17


def line(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """T-1."""
    mean_x, mean_y = x.mean(1), y.mean(1)
    flat = np.ptp(x, axis=1) < 1e-9
    dx = x - mean_x[:, None]
    slope = np.where(flat, 0.0, (dx * (y - mean_y[:, None])).sum(1) / np.where(flat, 1.0, (dx * dx).sum(1)))
    return slope, mean_y - slope * mean_x


@lru_cache(maxsize=64)
def resamples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places drawn for a series of n points, and the first and last place of each resample."""
    pick = np.random.default_rng(S.SEED).integers(0, n, (S.BOOTSTRAPS, n))
    return pick, pick.min(1), pick.max(1)


def quantile(ranked: np.ndarray, n: np.ndarray, q: float) -> np.ndarray:
    """The q quantile of the first n values of each ranked row, between neighbours as numpy has it."""
    at = (n - 1) * q
    low = np.floor(at).astype(np.int64)
    row = np.arange(len(ranked))
    a, b, t = ranked[row, low], ranked[row, np.minimum(low + 1, n - 1)], at - low
    return np.where(t >= 0.5, b - (b - a) * (1 - t), a + (b - a) * t)


def bootstrap_slope(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """T-2, for times in ascending order."""
    m, n = x.shape
    out = np.repeat(line(x, y)[0][None], 3, axis=0)
    if n < 4:
        return tuple(out)
    pick, first, last = resamples(n)
    rows = np.flatnonzero(np.ptp(x, axis=1) >= 1e-9)
    step = max(1, BLOCK // pick.size)
    for k in range(0, len(rows), step):
        own = rows[k : k + step]
        a, b = x[own], y[own]
        dx, ys = np.take(a, pick, axis=1), np.take(b, pick, axis=1)
        dx -= dx.mean(2, keepdims=True)
        ok = a[:, last] - a[:, first] >= 1e-9
        ys *= dx
        dx *= dx
        slopes = np.where(ok, ys.sum(2) / np.where(ok, dx.sum(2), 1.0), np.inf)
        slopes.sort(axis=1)
        some = ok.sum(1)
        got, slopes, some = own[some > 0], slopes[some > 0], some[some > 0]
        at = np.arange(len(got))
        out[0, got] = (slopes[at, (some - 1) // 2] + slopes[at, some // 2]) / 2
        out[1, got], out[2, got] = quantile(slopes, some, 0.05), quantile(slopes, some, 0.95)
    return tuple(out)


def smoothed(y: np.ndarray, alpha: float) -> np.ndarray:
    """T-4."""
    out = np.array(y, float)
    for i in range(1, out.shape[1]):
        out[:, i] += (1 - alpha) * (out[:, i - 1] - out[:, i])
    return out


def direction(change: np.ndarray, limit) -> np.ndarray:
    return np.where(change > limit, "increasing", np.where(change < -np.asarray(limit), "decreasing", "stable")).astype(object)


def scale(y: np.ndarray, season: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """T-17; NaN where series.py has None."""
    m, n = y.shape
    lag = season if season and n >= 2 * season else 1
    if n <= lag:
        return np.full(m, np.nan), np.zeros(m, bool)
    raw, size = np.abs(y[:, lag:] - y[:, :-lag]).mean(1), np.abs(y).mean(1)
    none = size <= 1e-9
    floored = ~none & (raw < S.FLOOR * size)
    return np.where(none, np.where(raw > 1e-9, raw, np.nan), np.where(floored, S.FLOOR * size, raw)), floored


def quality(mase: np.ndarray, coverage: np.ndarray) -> np.ndarray:
    """T-18."""
    a = np.where(np.isnan(mase), 50.0, np.clip(100 - 50 * mase, 0, 100))
    b = np.where((coverage >= 60) & (coverage <= 95), 100.0, np.where(coverage > 95, np.maximum(0.0, 100 - 4 * (coverage - 95)), coverage / 0.6))
    return np.array([round(v, 1) for v in (0.7 * a + 0.3 * b).tolist()])


# ---------------------------------------------------------------- candidates: (train x, train y, target x) -> Guess or None


@dataclass
class Guess:
    """As in series.py, a row for each series; there: which series have the candidate at all."""

    point: np.ndarray
    noise: np.ndarray | None = None
    fan: tuple | None = None
    band: tuple | None = None
    there: np.ndarray | None = None

    def of(self, rows: np.ndarray) -> "Guess":
        side = lambda v: v and tuple(part[rows] for part in v)
        return Guess(self.point[rows], None if self.noise is None else self.noise[rows], side(self.fan), side(self.band))


def naive(x, y, at):
    """T-6."""
    return Guess(np.repeat(y[:, -1:], at.shape[1], axis=1), np.std(np.diff(y, axis=1), axis=1) if y.shape[1] > 1 else np.zeros(len(y)))


def moving_average(x, y, at):
    """T-7."""
    tail = y[:, -int(np.clip(y.shape[1] // 2, 3, 7)) :]
    return Guess(np.repeat(tail.mean(1)[:, None], at.shape[1], axis=1), tail.std(1))


def regression(x, y, at):
    """T-8."""
    mid, low, high = bootstrap_slope(x, y)
    end, now = x[:, -1:], y[:, -1:]
    return Guess(now + mid[:, None] * (at - end), np.std(y - now - mid[:, None] * (x - end), axis=1), (low, high, y[:, -1], x[:, -1]))


def holt(x, y, at, alpha=0.3, beta=0.1):
    """T-9."""
    m, n = y.shape
    if n < 2:
        return None
    level, slope, ahead = y[:, 0], y[:, 1] - y[:, 0], np.empty((m, n))
    ahead[:, 0] = level
    for k in range(1, n):
        ahead[:, k] = level + slope
        new = ahead[:, k] + alpha * (y[:, k] - ahead[:, k])
        level, slope = new, slope + beta * (new - level - slope)
    step = np.median(np.diff(x, axis=1), axis=1)
    step = np.where(step > 1e-9, step, 1.0)
    return Guess(level[:, None] + slope[:, None] * (at - x[:, -1:]) / step[:, None], np.std(y - ahead, axis=1))


def theta(x, y, at, alpha=0.2):
    """T-10."""
    if y.shape[1] < 4:
        return None
    slope, start = (v[:, None] for v in line(x, y))
    trend = start + slope * x
    levels = smoothed(2 * y - trend, alpha)
    before = np.concatenate([levels[:, :1], levels[:, :-1]], axis=1)
    return Guess((start + slope * at + levels[:, -1:]) / 2, np.std(y - (trend + before) / 2, axis=1))


def croston(x, y, at, alpha=0.1):
    """T-11."""
    m, n = y.shape
    sold = y != 0
    zeros = 1 - sold.sum(1) / n
    there = (sold.sum(1) >= 3) & (zeros >= 0.3) & (zeros <= 0.9)
    if not there.any():
        return None
    size, wait, since, rate = np.zeros(m), np.zeros(m), np.full(m, -1), np.zeros(m)
    for k in range(n):
        hit, gap = sold[:, k], (k - since).astype(float)
        first = since < 0
        size = np.where(hit, np.where(first, y[:, k], y[:, k] + (1 - alpha) * (size - y[:, k])), size)
        wait = np.where(hit, np.where(first, gap, gap + (1 - alpha) * (wait - gap)), wait)
        since = np.where(hit, k, since)
    np.divide(size, wait, out=rate, where=wait > 1e-9)
    return Guess(np.repeat(rate[:, None], at.shape[1], axis=1), np.std(y - rate[:, None], axis=1), there=there)


def each(candidate, least: int):
    """A candidate of series.py, series by series, for those of `least` points or more."""

    def run(x, y, at):
        if y.shape[1] < least:
            return None
        found = [candidate(*row) for row in zip(x, y, at)]
        there = np.array([g is not None for g in found])
        if not there.any():
            return None
        some = next(g for g in found if g is not None)
        none = S.Guess(np.full(at.shape[1], np.nan), np.nan, some.fan and (np.nan,) * 4, some.band and (np.full(at.shape[1], np.nan),) * 2)
        found = [g or none for g in found]
        side = lambda of: tuple(np.array(v) for v in zip(*of))
        return Guess(np.array([g.point for g in found]), np.array([g.noise for g in found]), some.fan and side([g.fan for g in found]), some.band and side([g.band for g in found]), there)

    return run


CANDIDATES = {
    "naive_persistence": naive, "moving_average": moving_average, "croston": croston, "linear_regression": regression, "theta": theta, "ets_trend": holt,
    "trend": each(S.trend, S.LONG), "seasonal_naive": each(S.seasonal_naive, 2 * S.DAY),
}


def band(guess: Guess, y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """T-13."""
    if guess.band is not None:
        return *guess.band, np.zeros(len(y), bool)
    size = np.abs(y).mean(1)
    floored = (size > 1e-9) & (guess.noise < S.FLOOR * size)
    margin = (S.Z * np.where(floored, S.FLOOR * size, guess.noise))[:, None]
    if guess.fan:
        low, high, base, start = (v[:, None] for v in guess.fan)
        a, b = base + low * (at - start) - margin, base + high * (at - start) + margin
    else:
        a, b = guess.point - margin, guess.point + margin
    return np.minimum(a, b), np.maximum(a, b), floored


def autocorrelation(y: np.ndarray, lag: int) -> np.ndarray:
    if y.shape[1] < lag + 2:
        return np.zeros(len(y))
    a, b = y[:, :-lag], y[:, lag:]
    flat = (a.std(1) < 1e-9) | (b.std(1) < 1e-9)
    a, b = a - a.mean(1, keepdims=True), b - b.mean(1, keepdims=True)
    return np.where(flat, 0.0, (a * b).sum(1) / np.where(flat, 1.0, np.sqrt((a * a).sum(1) * (b * b).sum(1))))


def level_break(x: np.ndarray, y: np.ndarray, season: int | None = None, edge: int = 8, reach: int = 6, sure: float = 4.0, still: float = 2.5, left: int = 16) -> np.ndarray:
    """T-14; 0 where series.py has None."""
    m, n = y.shape
    at = np.arange(edge, n - edge)
    if n < 2 * edge or not len(at):
        return np.zeros(m, np.int64)
    slope, start = line(x, y)
    res = y - start[:, None] - slope[:, None] * x
    steps = np.diff(res, axis=1)
    noise = 1.4826 * np.median(np.abs(steps - np.median(steps, axis=1, keepdims=True)), axis=1)
    noise = np.where(noise >= 1e-9, noise, 1e-6)
    width = np.minimum(reach, np.minimum(at, n - at))
    total = np.concatenate([np.zeros((m, 1)), np.cumsum(res, axis=1)], axis=1)
    before, after = (total[:, at] - total[:, at - width]) / width, (total[:, at + width] - total[:, at]) / width
    strength = np.abs(before - after) / (noise[:, None] * np.sqrt(2 / width))
    k, row = strength.argmax(1), np.arange(m)
    end, was, then = res[:, -reach:].mean(1), before[row, strength.argmax(1)], after[row, strength.argmax(1)]
    lasting = np.abs(end - was) / (noise * np.sqrt(1 / width[k] + 1 / reach))
    found = (strength[row, k] >= sure) & (n - at[k] >= left) & (lasting >= still) & ((end - was) * (then - was) >= 0)
    if season and n > season and found.any():
        found &= ~(autocorrelation(res, season) > S.SEASONAL_GATE)
    return np.where(found, at[k], 0)


@dataclass
class Choice:
    """As in series.py, a row for each series; skill is NaN where there is none."""

    method: np.ndarray
    point: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    floored: np.ndarray
    skill: np.ndarray
    trimmed: np.ndarray


def choose(x: np.ndarray, y: np.ndarray, at: np.ndarray, season: int = S.DAY) -> Choice:
    """T-15."""
    m, n = y.shape
    cut = level_break(x, y, season)
    for k in np.unique(cut):
        if k and not S.holdout(n - k):
            cut[cut == k] = 0
    shape = at.shape
    out = Choice(np.empty(m, object), np.empty(shape), np.empty(shape), np.empty(shape), np.zeros(m, bool), np.full(m, np.nan), cut)
    for k in np.unique(cut):
        own = np.flatnonzero(cut == k)
        _choose(x[own, k:], y[own, k:], at[own], out, own)
    return out


def _choose(x, y, at, out: Choice, rows: np.ndarray) -> None:
    """Fills rows of out with the choice for series that need no more trimming."""

    def put(name, guess, own):
        to = rows[own]
        out.method[to], out.point[to] = name, guess.point
        out.lower[to], out.upper[to], out.floored[to] = band(guess, y[own], at[own])

    m, n = y.shape
    size = S.holdout(n)
    if not size:
        return put("trend_fallback_insufficient_data", regression(x, y, at), np.arange(m))
    errors = np.full((len(CANDIDATES), m), np.inf)
    for place, candidate in enumerate(CANDIDATES.values()):
        total, found = np.zeros(m), np.zeros(m, np.int64)
        for s in S.fold_starts(n, size):
            g = candidate(x[:, :s], y[:, :s], x[:, s : s + size])
            if g is not None:
                there = np.ones(m, bool) if g.there is None else g.there
                total += np.where(there, np.abs(y[:, s : s + size] - g.point).mean(1), 0.0)
                found += there
        np.divide(total, found, out=errors[place], where=found > 0)
    best = errors.min(0)
    first = (errors <= np.maximum(best * (1 + S.TIE), best + 1e-9)).argmax(0)
    for place, (name, candidate) in enumerate(CANDIDATES.items()):
        own = np.flatnonzero(first == place)
        if not len(own):
            continue
        put(S.FALLBACK, naive(x[own], y[own], at[own]), own)  # for those that it suits in the folds only
        guess = candidate(x[own], y[own], at[own])
        if guess is not None:
            there = np.flatnonzero(np.ones(len(own), bool) if guess.there is None else guess.there)
            put(name, guess.of(there), own[there])
    base = errors[0]
    out.skill[rows] = np.where(base > 1e-12, np.clip(1 - best / np.where(base > 1e-12, base, 1.0), 0, 1), np.nan)


def backtest(x: np.ndarray, y: np.ndarray, bursty: np.ndarray) -> dict | None:
    """T-16."""
    n = y.shape[1]
    k = S.holdout(n)
    if not k:
        return None
    choice = choose(x[:, :-k], y[:, :-k], x[:, -k:])
    unit, unit_floored = scale(y[:, :-k])
    if n - k >= 2 * S.DAY and bursty.any():
        unit[bursty], unit_floored[bursty] = scale(y[bursty, :-k], S.DAY)
    miss = y[:, -k:] - choice.point
    mae = np.abs(miss).mean(1)
    mase = mae / unit
    coverage = ((y[:, -k:] >= choice.lower) & (y[:, -k:] <= choice.upper)).mean(1) * 100
    return {"holdout_n": k, "mae": mae, "mase": mase, "coverage_pct": coverage, "low_variance": unit_floored | choice.floored, "method": choice.method, "trimmed": choice.trimmed, "quality": quality(mase, coverage)}


# ---------------------------------------------------------------- live forecast


@dataclass
class Series:
    """What is known of each series beside its readings; slope is NaN without a prior."""

    bursty: np.ndarray
    percent: np.ndarray
    mixed: np.ndarray
    slope: np.ndarray
    pool: np.ndarray
    populated: np.ndarray

    def of(self, rows: np.ndarray) -> "Series":
        return Series(self.bursty[rows], self.percent[rows], self.mixed[rows], self.slope[rows], self.pool[rows], self.populated[rows])

    def prior(self, row: int) -> S.Prior:
        slope = float(self.slope[row])
        return S.Prior(None if np.isnan(slope) else slope, int(self.pool[row]), bool(self.populated[row]))

    def tier(self) -> np.ndarray:
        """T-21."""
        return np.where(self.populated, "type_pooled", "category_pooled").astype(object)

    def trust(self) -> np.ndarray:
        return np.where(self.pool >= 10, "high", np.where(self.pool >= 5, "medium-high", "medium")).astype(object)

    def shrink(self, slope: np.ndarray, n: int, spread: np.ndarray) -> np.ndarray:
        """T-20."""
        if n >= 20:
            return slope
        w = n / (n + 15)
        return np.where(np.isnan(self.slope), slope, w * slope + (1 - w) * self.slope * spread)


@dataclass
class Live:
    """Forecasts, filled branch by branch."""

    point: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    method: np.ndarray
    r2: np.ndarray
    trend: np.ndarray
    reliability: np.ndarray
    tier: np.ndarray
    note: np.ndarray

    @staticmethod
    def empty(m: int) -> "Live":
        wide = lambda: np.empty((m, len(S.HORIZONS)))
        text = lambda v=None: np.full(m, v, object)
        return Live(wide(), wide(), wide(), text(), np.zeros(m), text("stable"), text("low"), text("individual"), text("ok"))

    def put(self, rows: np.ndarray, **values) -> None:
        for name, value in values.items():
            getattr(self, name)[rows] = value


def trust(share: np.ndarray) -> np.ndarray:
    return np.where(share >= 0.65, "high", np.where(share >= 0.25, "moderate", "low")).astype(object)


def fit_share(y: np.ndarray, fitted: np.ndarray, flat: float = 0.0) -> np.ndarray:
    total = ((y - y.mean(1, keepdims=True)) ** 2).sum(1)
    none = total < 1e-9
    return np.where(none, flat, np.clip(1 - ((y - fitted) ** 2).sum(1) / np.where(none, 1.0, total), 0, 1))


def live(x: np.ndarray, y: np.ndarray, known: Series) -> Live:
    """T-22, with the branches of series.py."""
    m, n = y.shape
    out = Live.empty(m)
    if n < 5:
        _few(y, known, out)
        return out
    sold = y != 0
    zeros = (~sold).mean(1)
    cleaned = (zeros > 0.2) & (zeros <= 0.8)
    out.note[zeros > 0.8], out.note[cleaned] = "idle", "cleaned"
    end = np.where(cleaned & (sold.sum(1) >= 5), n - sold[:, ::-1].argmax(1), n)
    for e in np.unique(end):
        own = np.flatnonzero(end == e)
        _live(x[own, :e], y[own, :e], y[own, -1], known.of(own), out, own)
    return out


def _few(y, known: Series, out: Live) -> None:
    m, n = y.shape
    now, hours, rows = y[:, -1], np.array(list(S.HORIZONS.values()), float), np.arange(m)
    flat = np.repeat(now[:, None], len(hours), axis=1)
    out.put(rows, point=flat, lower=flat, upper=flat, method="none", note=f"insufficient_points_{n}")
    own = np.flatnonzero(~np.isnan(known.slope))
    if not len(own):
        return
    k, now, flat = known.of(own), now[own], flat[own]
    spread = np.ptp(y[own], axis=1) if n > 1 else np.abs(now) * 0.1
    spread = np.where(spread != 0, spread, np.where(np.abs(now) * 0.1 != 0, np.abs(now) * 0.1, 1.0))
    slope = k.slope * spread
    ahead = flat + slope[:, None] * hours
    margin = np.abs(slope[:, None] * hours * 0.25)
    out.put(own, point=ahead, lower=ahead - margin, upper=ahead + margin, method="pooled_type_prior", r2=np.minimum(0.85, 0.3 + k.pool / 20), trend=direction(slope, 0.01), reliability=k.trust(), tier=k.tier(), note=f"insufficient_points_{n}_pooled")


def _live(x, y, now, known: Series, out: Live, rows: np.ndarray) -> None:
    """Series of five points or more, without trailing zeros; now: their last values before those went."""
    m, n = y.shape
    hours = np.array(list(S.HORIZONS.values()), float)
    spread = np.ptp(y, axis=1)
    unit = np.where(spread[:, None] > 0, (y - y.min(1, keepdims=True)) / np.where(spread > 0, spread, 1.0)[:, None], 0.0)
    still = unit.std(axis=1, ddof=1) < 0.01
    burst = ~still & known.bursty & ~known.mixed
    for own, branch in ((still, _flat), (burst, _bursty), (~still & ~burst, _steady)):
        own = np.flatnonzero(own)
        if len(own):
            branch(x[own], y[own], unit[own], spread[own], now[own], known.of(own), hours, out, rows[own])


def _flat(x, y, unit, spread, now, known, hours, out, rows):
    flat = np.repeat(now[:, None], len(hours), axis=1)
    out.put(rows[known.mixed], note="mixed_stat_fields")
    pooled = ~np.isnan(known.slope) & (spread > 0)
    idle = out.note[rows] == "idle"
    margin = np.where(pooled, np.abs(known.slope * spread * 0.5), 0.0)[:, None]
    out.put(
        rows, point=flat, lower=flat - margin, upper=flat + margin, method="flat_signal", r2=np.where(pooled, np.minimum(0.75, 0.2 + known.pool / 25), idle.astype(float)),
        reliability=np.where(pooled, known.trust(), np.where(idle, "high", "low")), tier=np.where(pooled, known.tier(), "individual"),
    )


def _bursty(x, y, unit, spread, now, known, hours, out, rows):
    n = y.shape[1]
    if n >= 2 * S.DAY:
        for k, row in enumerate(rows):
            got = S.live(x[k], y[k], True, bool(known.percent[k]), False, known.prior(k))
            out.put([row], **{name: [v] for name, v in got.items() if name != "note"})
        return
    top = np.where(known.percent, 100.0, np.inf)[:, None]
    level = smoothed(y, 0.3)[:, -1]
    tail = y[:, -max(3, n // 4) :]
    index = np.repeat(np.arange(tail.shape[1], dtype=float)[None], len(y), axis=0)
    _, low, high = bootstrap_slope(index, tail)
    mid, low, high = (known.shrink(s, n, spread) for s in (line(index, tail)[0], low, high))
    steps = hours / np.maximum(x[:, -1] - x[:, -2], 0.001)[:, None]
    pooled = ~np.isnan(known.slope) & (n < 20)
    r2 = fit_share(unit, smoothed(unit, 0.3))
    point, lower, upper = (np.clip(level[:, None] + s[:, None] * steps, 0, top) for s in (mid, low, high))
    out.put(
        rows, point=point, lower=lower, upper=upper, method=np.where(pooled, "shrunk_slope_xgboost_prior", "exponential_smoothing"), r2=r2,
        trend=direction(mid, 0.05 * np.where(level > 0, level, 1.0)), reliability=trust(r2), tier=np.where(pooled, known.tier(), "individual"),
    )


def _steady(x, y, unit, spread, now, known, hours, out, rows):
    n = y.shape[1]
    least, top = np.where(known.percent, np.maximum(0.0, y.min(1) * 0.9), 0.0)[:, None], np.where(known.percent, 100.0, np.inf)[:, None]
    clip = lambda v: np.clip(v, least, top)
    limit, room, current = 0.02 if n >= 72 else 0.05, np.maximum(spread, 1.0), y[:, -1]
    if S.holdout(n):
        c = choose(x, y, x[:, -1:] + hours)
        point, a, b = clip(c.point), clip(c.lower), clip(c.upper)
        skill = np.where(np.isnan(c.skill), 0.5, c.skill)
        method = np.array([f"adaptive_{name}" + "_post_break" * bool(k) for name, k in zip(c.method, c.trimmed)], object)
        out.put(rows, point=point, lower=np.minimum(a, b), upper=np.maximum(a, b), method=method, r2=skill, trend=direction((point[:, 2] - current) / room, limit), reliability=trust(skill), note="adaptive_selection_no_pooling_shrink")
        return
    slopes = [known.shrink(s, n, spread) for s in bootstrap_slope(x, y)]
    pooled = ~np.isnan(known.slope) & (n < 20)
    slope, start = (v[:, None] for v in line(x, unit))
    r2 = fit_share(unit, start + slope * x, 1.0)
    trend = direction(slopes[0] / room, limit)
    wobble = y.std(1) / np.maximum(np.abs(y.mean(1)), 1.0)
    r2 = np.where((trend == "stable") & (wobble < 0.05), np.maximum(r2, 1 - wobble / 0.05 * 0.2), r2)
    margin = S.Z * np.std(y - current[:, None] - slopes[0][:, None] * (x - x[:, -1:]), axis=1)
    point, a, b = (clip(current[:, None] + s[:, None] * hours + m[:, None]) for s, m in zip(slopes, (np.zeros(len(y)), -margin, margin), strict=True))
    out.put(rows, point=point, lower=np.minimum(a, b), upper=np.maximum(a, b), method=np.where(pooled, "shrunk_slope_xgboost_prior", "linear_regression_bootstrap"), r2=r2, trend=trend, reliability=trust(r2), tier=np.where(pooled, known.tier(), "individual"))
