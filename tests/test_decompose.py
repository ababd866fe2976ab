"""Decomposition against the textbook's loops, point by point, and blocks against whole series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.functions import decompose as D
from fleetlens.functions import series as S
from fleetlens.operators import decompose


def point(ys, ws, span, at):
    """One local line: ys at 1..n, fitted at `at`."""
    n = len(ys)
    q = min(span, n)
    left = min(max(at - (q - 1) // 2, 1), n - q + 1)
    places = range(left, left + q)
    reach = max(abs(at - left), abs(left + q - 1 - at)) + max(span - n, 0) // 2
    weights = []
    for j in places:
        far = abs(j - at)
        near = 1.0 if far <= 0.001 * reach else (1 - (far / reach) ** 3) ** 3 if far <= 0.999 * reach else 0.0
        weights.append(near * ws[j - 1])
    total = sum(weights)
    if total <= 0:
        return ys[min(max(at, 1), n) - 1]
    weights = [w / total for w in weights]
    mean = sum(w * j for w, j in zip(weights, places, strict=True))
    spread = sum(w * (j - mean) ** 2 for w, j in zip(weights, places, strict=True))
    if spread**0.5 > 0.001 * (n - 1):
        weights = [w * (1 + (at - mean) * (j - mean) / spread) for w, j in zip(weights, places, strict=True)]
    return sum(w * ys[j - 1] for w, j in zip(weights, places, strict=True))


def textbook(y, period, seasonal=7, inner=2, outer=15):
    n = len(y)
    slow, low = D.odd_from(1.5 * period / (1 - 1.5 / seasonal)), D.odd_from(period + 1)
    trend, weights = [0.0] * n, [1.0] * n
    average = lambda v, k: [sum(v[i : i + k]) / k for i in range(len(v) - k + 1)]
    for _ in range(outer + 1):
        for _ in range(inner):
            turns = [0.0] * (n + 2 * period)
            for p in range(period):
                own = [y[i] - trend[i] for i in range(p, n, period)]
                ws = [weights[i] for i in range(p, n, period)]
                for k in range(len(own) + 2):
                    turns[p + k * period] = point(own, ws, seasonal, k)
            smooth = average(average(average(turns, period), period), 3)
            drift = [point(smooth, [1.0] * n, low, i) for i in range(1, n + 1)]
            season = [turns[i + period] - drift[i] for i in range(n)]
            left = [y[i] - season[i] for i in range(n)]
            trend = [point(left, weights, slow, i) for i in range(1, n + 1)]
        rest = [r if abs(r) > 1e-12 * max(map(abs, y)) else 0.0 for r in (y[i] - trend[i] - season[i] for i in range(n))]
        h = 6 * float(np.median(np.abs(rest)))
        weights = [1.0 if abs(r) <= 0.001 * h else (1 - (r / h) ** 2) ** 2 if abs(r) <= 0.999 * h else 0.0 for r in rest]
    return trend, season


@pytest.mark.parametrize("n, period, noise", [(50, 12, 1.0), (61, 6, 0.2), (24, 12, 0.5), (90, 24, 2.0), (40, 4, 0.0)])
def test_equals_the_textbook(n, period, noise):
    r = np.random.default_rng(n)
    t = np.arange(n)
    y = 5 + 0.1 * t + 2 * np.sin(2 * np.pi * t / period) + noise * r.normal(size=n)
    y[n // 3] += 25
    got = D.decompose(y, period, outer=4)
    want = textbook(list(y), period, outer=4)
    for a, b in zip(got, want, strict=False):
        np.testing.assert_allclose(a, b, atol=1e-8)
    np.testing.assert_allclose(got[0] + got[1] + got[2], y, atol=1e-12)


def test_pieces_do_not_change_a_fit(monkeypatch):
    y, w = np.random.default_rng(3).normal(size=(2, 300)), np.random.default_rng(4).uniform(size=(2, 300))
    whole = D.loess(y, 47, w, 1)
    monkeypatch.setattr(D, "PIECE", 37)
    np.testing.assert_allclose(D.loess(y, 47, w, 1), whole, atol=1e-12)


def test_odd_series():
    assert D.decompose(np.ones(47)) is None
    for y in (np.zeros(48), np.full(100, 7.5)):
        trend, season, rest = D.decompose(y)
        np.testing.assert_allclose(trend, y, atol=1e-9)
        np.testing.assert_allclose(season, 0, atol=1e-9)
        np.testing.assert_allclose(rest, 0, atol=1e-9)
    np.testing.assert_allclose(D.hourly(np.array([0.5, 0.5, 0.9, 3.6]), np.array([1.0, 100.0, 3.0, 8.0])), [2, 4, 6, 8])


def test_trend_is_a_candidate():
    t = np.arange(240.0)
    y = 50 + 0.2 * t + 8 * np.sin(2 * np.pi * t / 24) + np.random.default_rng(5).normal(0, 0.5, 240)
    at = t[-1] + np.array([24.0, 168.0])
    guess = S.CANDIDATES["trend"](t, y, at)
    np.testing.assert_allclose(guess.point, 50 + 0.2 * at, rtol=0.03)
    assert S.CANDIDATES["trend"](t[:71], y[:71], at) is None
    assert list(S.CANDIDATES).index("trend") == len(S.CANDIDATES) - 2


def readings(spark, n, **columns):
    rows = spark.range(n).select(F.lit("a").alias("resource_id"), F.lit("Compute").alias("category"), F.lit("cpu").alias("feature"), F.col("id").alias("event_id"), (F.lit(1_700_000_000) + F.col("id") * 3600).cast("timestamp").alias("ts"), (10 + 0.01 * F.col("id") + 3 * F.sin(F.col("id") * 2 * 3.141592653589793 / 24) + F.pmod(F.hash("id"), F.lit(100)) / 100).alias("value"))
    return rows.select("*", *[v.alias(k) for k, v in columns.items()])


def test_one_block_equals_the_whole_series(spark):
    rows = readings(spark, 300, trend=F.lit("clash"))
    got = decompose.decomposed(decompose.hourly(rows)).toPandas().sort_values("hour")
    want = D.decompose(got["value"].to_numpy())
    for name, part in zip(("trend", "seasonal", "rest"), want, strict=True):
        np.testing.assert_allclose(got[name], part, atol=1e-9)


def test_blocks_are_close_to_the_whole_series(spark):
    got = decompose.decomposed(decompose.hourly(readings(spark, 1500)), block=480).toPandas().sort_values("hour")
    want = D.decompose(got["value"].to_numpy())
    assert list(got["hour"]) == list(range(1500))
    assert np.abs(got["trend"] - want[0]).max() < 0.1 and np.abs(got["seasonal"] - want[1]).max() < 0.25
    assert np.abs(got["trend"] - want[0]).mean() < 0.01 and np.abs(got["seasonal"] - want[1]).mean() < 0.05


def test_nulls_gaps_repeats_and_no_rows(spark):
    rows = readings(spark, 200)
    gaps = rows.where("event_id % 5 <> 2").withColumn("value", F.when(F.col("event_id") % 7 == 1, None).otherwise(F.col("value")))
    twice = gaps.union(gaps.withColumn("event_id", F.col("event_id") + 1000).withColumn("value", F.lit(1e9)))
    hours = decompose.hourly(twice.where("value is not null"))
    got = hours.toPandas().sort_values("hour")
    assert list(got["hour"]) == list(range(200)) and got["filled"].sum() == 40
    assert set(got.loc[got["value"] == 1e9, "hour"]) == {n for n in range(200) if n % 7 == 1 and n % 5 != 2}  # a null gives way to a repeat
    assert decompose.decomposed(hours).count() == 200
    assert decompose.decomposed(decompose.hourly(rows.limit(0))).count() == 0
    assert decompose.decomposed(decompose.hourly(rows.limit(30))).count() == 0
