"""Many series at once against the functions of one series; whole series out of batches, wherever these are cut."""

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from fleetlens.functions import many as M
from fleetlens.functions import series as S
from fleetlens.operators import forecast

T0 = dt.datetime(2024, 1, 1)


def drawn(n, m=40, seed=0):
    """Series of n points of many kinds: noise, lines, steps, constants, zeros and short bursts; some times are equal."""
    rng = np.random.default_rng([n, seed])
    x = np.sort(rng.uniform(0, 720, (m, n)), axis=1)
    x -= x[:, :1]
    y = rng.lognormal(2, 1, (m, n))
    k = np.arange(n)
    y[::8] = 5 + 0.3 * x[::8] + rng.normal(0, 0.2, y[::8].shape)
    y[1::8] = np.where(k < n // 2, 10.0, 60.0) + rng.normal(0, 0.3, y[1::8].shape)
    y[2::8] = 7.0
    y[3::8] = np.where(rng.random(y[3::8].shape) < 0.5, 0.0, y[3::8])
    y[4::8, n - n // 3 :] = 0.0
    y[5::8] = 0.0
    y[6::8] = 20 + 10 * np.sin(k / 24 * 2 * np.pi) + rng.normal(0, 0.1, y[6::8].shape)
    x[7::8] = np.floor(x[7::8] / 300) * 300
    x[7] = 0.0
    return x - x[:, :1], y


def same(a, b):
    assert np.allclose(np.asarray(a, float), np.asarray(b, float), rtol=1e-9, atol=1e-9, equal_nan=True), (a, b)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 13, 19, 27, 60, 90])
def test_candidates_and_choice(n):
    x, y = drawn(n, 24)
    at = x[:, -1:] + np.array([1.0, 24, 168])
    for name, candidate in M.CANDIDATES.items():
        got = candidate(x, y, at)
        for k in range(len(y)):
            want = S.CANDIDATES[name](x[k], y[k], at[k])
            assert (want is not None) == (got is not None and (got.there is None or bool(got.there[k]))), (name, k)
            if want is not None:
                same(got.point[k], want.point)
                low, high, floored = S.band(want, y[k], at[k])
                lows, highs, floors = M.band(got, y, at)
                same(lows[k], low), same(highs[k], high)
                assert floored == floors[k]
    if n >= 2:
        got = M.choose(x, y, at)
        for k in range(len(y)):
            want = S.choose(x[k], y[k], at[k])
            assert (got.method[k], got.trimmed[k], got.floored[k]) == (want.method, want.trimmed, want.floored), k
            same(got.point[k], want.point), same(got.lower[k], want.lower), same(got.upper[k], want.upper)
            same(got.skill[k], np.nan if want.skill is None else want.skill)


@pytest.mark.parametrize("n", [1, 3, 5, 9, 12, 16, 22, 33, 50])
@pytest.mark.parametrize("seed", range(4))
def test_live_and_backtest(n, seed):
    x, y = drawn(n, 40, seed)
    rng = np.random.default_rng([seed, n])
    m = len(y)
    flag = lambda: rng.random(m) < 0.5
    known = M.Series(flag(), flag(), rng.random(m) < 0.2, np.where(flag(), rng.normal(0, 0.01, m), np.nan), rng.integers(0, 15, m), flag())
    got, test = M.live(x, y, known), M.backtest(x, y, known.bursty)
    for k in range(m):
        want = S.live(x[k], y[k], bool(known.bursty[k]), bool(known.percent[k]), bool(known.mixed[k]), known.prior(k))
        for part in ("method", "trend", "reliability", "tier", "note"):
            assert getattr(got, part)[k] == want[part], (k, part)
        for part in ("point", "lower", "upper", "r2"):
            same(getattr(got, part)[k], want[part])
        want = S.backtest(x[k], y[k], bool(known.bursty[k]))
        assert (want is None) == (test is None)
        if want:
            assert (test["holdout_n"], test["method"][k], test["trimmed"][k], test["low_variance"][k]) == (want["holdout_n"], want["method"], want["trimmed"], want["low_variance"])
            for part in ("mae", "mase", "coverage_pct", "quality"):
                same(test[part][k], np.nan if want[part] is None else want[part])


@pytest.mark.parametrize("cut", [1, 3, 7, 100])
def test_whole_series_wherever_batches_end(cut):
    sizes = {("a", None): 5, ("a", "x"): 1, ("b", "x"): 20, (None, None): 2, (None, "x"): 3, ("c", "c"): 4}
    rows = [(*key, k) for key, n in sizes.items() for k in range(n)]
    table = pa.table({name: pa.array([r[i] for r in rows]) for i, name in enumerate(("p", "q", "k"))})
    found = []
    for part, starts in forecast.whole_series(iter(table.to_batches(max_chunksize=cut)), ["p", "q"], 6):
        ends = [*starts[1:], part.num_rows]
        found += [(part["p"][int(a)].as_py(), part["q"][int(a)].as_py(), part["k"][int(a) : int(b)].to_pylist()) for a, b in zip(starts, ends)]
    assert found == [(*key, list(range(n))) for key, n in sizes.items()]
    assert list(forecast.whole_series(iter([]), ["p"])) == []


def series_rows():
    """Short and long series, equal times, a null value, a null key."""
    rng = np.random.default_rng(5)
    sizes = {"one": 1, "few": 4, "mid": 13, "zeros": 30, "long": 300, None: 12, "null": 9}
    out = []
    for name, n in sizes.items():
        for k, h in enumerate(np.sort(rng.integers(0, 400, n))):
            value = None if name == "null" and k == 4 else 0.0 if name == "zeros" and k % 2 else round(float(rng.lognormal(2, 0.5)), 2)
            out.append((name, "c", "f_pct", "t", T0 + dt.timedelta(hours=int(h)), len(out), value))
    return out


def test_candidates_come_in_batches_of_many_series(spark):
    """No Python call for a single series; each gets what the functions of one series give."""
    df = spark.createDataFrame(series_rows(), "resource_id string, category string, feature string, rtype string, ts timestamp_ntz, event_id long, value double").repartition(5)
    hours = [1, 24, 168]
    out = forecast.candidates(df, list(S.CANDIDATES), hours)
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
    got = {(r.resource_id, r.method, r.hours): (r.point, r.lower, r.upper) for r in out.collect()}
    want = {}
    for name, own in pd.DataFrame(series_rows(), columns=["id", "c", "f", "t", "ts", "e", "v"]).groupby("id", dropna=False):
        own = own.sort_values(["ts", "e"])
        x, y = (own["ts"] - own["ts"].iloc[0]).dt.total_seconds().to_numpy() / 3600, own["v"].to_numpy(float)
        for method, candidate in S.CANDIDATES.items():
            guess = candidate(x, y, x[-1] + np.array(hours, float))
            if guess is not None:
                low, high, _ = S.band(guess, y, x[-1] + np.array(hours, float))
                want |= {(None if pd.isna(name) else name, method, h): v for h, *v in zip(hours, guess.point, low, high)}
    assert set(got) == set(want)
    for key, values in got.items():
        same([np.nan if v is None else v for v in values], want[key])


def test_forecasts_come_in_batches_of_many_series(spark):
    df = spark.createDataFrame(series_rows(), "resource_id string, category string, feature string, rtype string, ts timestamp_ntz, event_id long, value double").repartition(5)
    priors = spark.createDataFrame([("t", "c", "f_pct", 0.001, 7)], "rtype string, category string, feature string, prior double, pool long")
    out = forecast.forecasts(df, priors)
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
    got = {r.resource_id: r for r in out.collect()}
    assert len(got) == 7
    for name, own in pd.DataFrame(series_rows(), columns=["id", "c", "f", "t", "ts", "e", "v"]).groupby("id", dropna=False):
        own = own.sort_values(["ts", "e"])
        x, y = (own["ts"] - own["ts"].iloc[0]).dt.total_seconds().to_numpy() / 3600, own["v"].to_numpy(float)
        r, live, test = got[None if pd.isna(name) else name], S.live(x, y, False, True, False, S.Prior(0.001, 7, True)), S.backtest(x, y)
        assert (r.n, r.method, r.trend, r.note, r.tier) == (len(y), live["method"], live["trend"], live["note"], live["tier"])
        same([np.nan if v is None else v for v in (r.f_1h, r.f_24h_lower, r.f_30d_upper)], np.round([live["point"][0], live["lower"][2], live["upper"][4]], 3))
        assert (r.backtest_method, r.trimmed, r.backtest_n) == ((test["method"], test["trimmed"], test["holdout_n"]) if test else (None,) * 3)
        same([np.nan if v is None else v for v in (r.backtest_mase, r.backtest_quality)], [np.nan if not test or test[k] is None else test[k] for k in ("mase", "quality")])
