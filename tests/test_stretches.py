"""Series mathematics on stretches against the functions on whole series."""

import datetime
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.functions import series as S
from fleetlens.operators import stretches as T

KEYS = ["resource_id", "category", "feature"]
SCHEMA = "resource_id string, category string, feature string, ts timestamp_ntz, event_id long, value double, m string, n string"
DAY = datetime.datetime(2024, 1, 1)


def made(seed):
    """Series of 1 to 120 readings, trends, zeros, ties of time, nulls, repeated rows."""
    rng, rows = random.Random(seed), []
    for k in range(24):
        n = [1, 2, 3, 4, 5, 30, 70, 120][k % 8]
        for j in range(n):
            at = DAY + datetime.timedelta(minutes=rng.randrange(60 * 24 * 12) // (40 if k % 5 == 0 else 1))
            value = rng.gauss(50, 10) + j * (k % 3 - 1) if k % 4 != 2 else float(rng.choice([0, 0, 0, 7, 9]))
            rows.append((f"r{k}", "c", "f", at, 1000 * k + j, value, "x", "y"))
        rows.append((f"r{k}", "c", "f", DAY, 1000 * k + 999, None, "x", "y"))
    return rows


def series(rows):
    out = {}
    for r in rows:
        if r[5] is not None:
            out.setdefault(r[0], []).append((r[3], r[4], r[5]))
    for k, v in out.items():
        v.sort()
        yield k, np.array([(t - v[0][0]).total_seconds() / 3600 for t, *_ in v]), np.array([y for *_, y in v])


@pytest.mark.parametrize("hours", [0.5, 24, 24 * 400])
def test_equal_to_whole_series(spark, hours):
    rows = made(int(hours))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    ahead = [1, 24, 168]
    got = {}
    for f in (T.holt, T.theta, T.croston):
        for r in f(df, ahead, hours=hours).collect():
            got[r.resource_id, r.method, r.hours] = (r.point, r.lower, r.upper)
    levels = {r.resource_id: r.level for r in T.level(df, hours=hours).collect()}
    want = {}
    for k, x, y in series(rows):
        assert abs(levels[k] - S.smoothed(y, 0.3)[-1]) < 1e-9
        at = x[-1] + np.array(ahead, float)
        for name in ("ets_trend", "theta", "croston"):
            guess = S.CANDIDATES[name](x, y, at)
            if guess is not None:
                low, high, _ = S.band(guess, y, at)
                want |= {(k, name, h): (p, a, b) for h, p, a, b in zip(ahead, guess.point, low, high, strict=True)}
    assert set(got) == set(want) and {m for _, m, _ in want} == {"ets_trend", "theta", "croston"}
    for key, values in want.items():
        assert np.allclose(got[key], values, rtol=1e-7, atol=1e-7), (key, got[key], values)


def test_a_long_series(spark):
    """A million readings of one series: stretches are spread over tasks, and no row holds more than one's readings."""
    n = 1_000_000
    rows = spark.range(n).select(F.lit("r").alias("resource_id"), F.lit("c").alias("category"), F.lit("f").alias("feature"), F.timestamp_micros(F.col("id") * 60_000_000).cast("timestamp_ntz").alias("ts"), F.col("id").alias("event_id"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0).alias("value"))
    parts = T.stretches(rows)
    assert parts.select(F.max(F.size("r"))).first()[0] <= 24 * 60
    began = time.perf_counter()
    level = T.level(rows).first().level
    got = T.holt(rows, [1]).first()
    y = np.array([r.value for r in rows.tail(400)])
    assert abs(level - S.smoothed(y, 0.3)[-1]) < 1e-9 and abs(got.point - 50) < 50 and time.perf_counter() - began < 120


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert all(f(empty, [1]).count() == 0 for f in (T.holt, T.theta, T.croston)) and T.level(empty).count() == 0
