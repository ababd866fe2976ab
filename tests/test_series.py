import numpy as np
import pytest

from fleetlens.functions import series as S


def shapes():
    """The synthetic series whose breaks are known; one generator, drawn in order."""
    rng = np.random.default_rng(42)
    n60 = np.arange(60.0)
    spike = 10 + rng.normal(0, 0.3, 60)
    spike[40:48] += 15
    level = np.where(n60 < 40, 10.0, 25.0) + rng.normal(0, 0.3, 60)
    slope = 0.5 * n60 + rng.normal(0, 0.5, 60)
    noise = 10 + rng.normal(0, 1.0, 60)
    n96 = np.arange(96.0)
    sine = 10 + 3 * np.sin(2 * np.pi * n96 / 24) + rng.normal(0, 0.3, 96)
    late = 10 + rng.normal(0, 0.3, 60)
    late[46:] += 15
    trend_step = 0.1 * n60 + np.where(n60 >= 35, 12.0, 0.0) + rng.normal(0, 0.3, 60)
    return [(n60, spike, False), (n60, level, True), (n60, slope, False), (n60, noise, False), (n96, sine, False), (n60, late, False), (n60, trend_step, True)]


@pytest.mark.parametrize("case", range(7))
def test_breaks(case):
    x, y, broken = shapes()[case]
    assert (S.level_break(x, y, S.DAY) is not None) == broken


def test_line_agrees_with_numpy_and_is_flat_without_time():
    rng = np.random.default_rng(1)
    x, y = np.sort(rng.uniform(0, 50, 30)), rng.normal(0, 1, 30)
    assert np.allclose(S.line(x, y), np.polyfit(x, y, 1))
    assert S.line(np.zeros(3), np.array([1.0, 2, 3])) == (0.0, 2.0)


def test_bootstrap_is_deterministic_and_ordered():
    x = np.arange(20.0)
    y = 2 * x + np.random.default_rng(0).normal(0, 1, 20)
    mid, low, high = S.bootstrap_slope(x, y)
    assert low <= mid <= high and abs(mid - 2) < 0.2
    assert S.bootstrap_slope(x, y) == (mid, low, high)


def test_candidates_on_simple_series():
    x, at = np.arange(30.0), np.array([30.0, 31.0])
    assert S.naive(x, x, at).point.tolist() == [29, 29]
    assert S.moving_average(x, np.full(30, 4.0), at).point.tolist() == [4, 4]
    assert np.allclose(S.regression(x, 3 * x, at).point, [90, 93])
    assert np.allclose(S.holt(x, 3 * x, at).point, [90, 93])
    assert S.croston(x, np.ones(30), at) is None
    demand = np.where(np.arange(30) % 3 == 2, 6.0, 0.0)
    assert np.allclose(S.croston(x, demand, at).point, 2.0)
    assert S.seasonal_naive(x, x, at) is None


def test_choice_prefers_the_simplest_of_equals_and_finds_trends():
    x = np.arange(40.0)
    assert S.choose(x, np.full(40, 5.0), np.array([41.0])).method == "naive_persistence"
    trend = S.choose(x, 2 * x + np.random.default_rng(3).normal(0, 0.2, 40), np.array([50.0]))
    assert trend.method in ("linear_regression", "ets_trend", "theta") and abs(trend.point[0] - 100) < 8


def test_holdout_and_quality_limits():
    assert [S.holdout(n) for n in (5, 10, 11, 40, 200)] == [0, 0, 3, 8, 14]
    assert S.quality(0.0, 80) == 100.0 and S.quality(3.0, 0.0) == 0.0 and S.quality(None, None) == 50.0


def test_live_branches():
    none, prior = S.Prior(), S.Prior(0.1, 12, True)
    x = np.arange(4.0)
    assert S.live(x, x, False, False, False, none)["method"] == "none"
    assert S.live(x, x, False, False, False, prior)["method"] == "pooled_type_prior"
    x = np.arange(30.0)
    assert S.live(x, np.full(30, 7.0), False, False, False, none)["method"] == "flat_signal"
    assert S.live(x, x, True, False, False, none)["method"] == "exponential_smoothing"
    assert S.live(x, x, False, True, False, none)["method"].startswith("adaptive_")
    assert S.live(np.arange(60.0), np.sin(np.arange(60.0)) + 2, True, False, False, none)["method"] == "seasonal_naive_baseline"
    short = S.live(np.arange(8.0), 2 * np.arange(8.0), False, False, False, prior)
    assert short["method"] == "shrunk_slope_xgboost_prior" and short["tier"] == "type_pooled"
    assert (short["lower"] <= short["upper"]).all()
