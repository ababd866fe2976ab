"""As-of merging and whole predictions: brute force, skew, ties, nulls, empty tables, incremental versions."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.functions import series as S
from fleetlens.operators import prediction
from fleetlens.plans import predict_queries, prediction_queries

SF = "/root/testdata/sf0.001"
DAY = datetime.datetime(2024, 1, 1)


def at(hours):
    return DAY + datetime.timedelta(hours=hours)


@pytest.mark.parametrize("slices", [1, 16])
def test_as_of_against_brute_force(spark, slices):
    """One key has most of the rows; some rows share times with versions, some come before any, some have no key or time."""
    rng = random.Random(slices)
    rows = [(k, "hot" if k % 3 else rng.choice(["a", "b", None]), at(rng.randrange(60)), {"m": "x"}) for k in range(400)] + [(900, "hot", None, None), (901, "cold", at(3), None)]
    one = [(key, at(h), f"{key}{h}") for key in ("hot", "a", None) for h in (5, 20, 33)]
    two = [(key, at(h), float(h)) for key in ("hot", "b") for h in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "id long, key string, ts timestamp_ntz, tags map<string,string>").repartition(5)
    sources = {"one": spark.createDataFrame(one, "key string, valid_from timestamp_ntz, name string"), "two": spark.createDataFrame(two, "key string, valid_from timestamp_ntz, size double")}
    got = prediction.as_of(df, sources, ["key"], slices=slices).collect()
    assert len(got) == len(rows)

    def newest(versions, key, ts):
        fit = [(t, v) for k, t, v in versions if k == key and ts is not None and t <= ts]
        return max(fit)[1] if fit else None

    for r in got:
        assert (r.one.name if r.one else None) == newest(one, r.key, r.ts) and (r.two.size if r.two else None) == newest(two, r.key, r.ts), r
    assert prediction.as_of(df.limit(0), sources, ["key"]).count() == 0
    assert {r.one for r in prediction.as_of(df, {"one": sources["one"].limit(0)}, ["key"]).collect()} == {None}


def test_profiles_come_in_versions(spark):
    """Each version is the statistics of all readings before it; one more day leaves earlier versions as they are."""
    rng = random.Random(1)
    rows = [(f"r{k % 7}", "t", "c", "f", at(rng.randrange(24 * 25)), rng.gauss(10, 3) + 40 * (k % 11 == 0)) for k in range(500)] + [("r1", "t", "c", "f", at(1), None), ("r1", "u", "c", "f", at(1), 1.0)]
    df = spark.createDataFrame(rows, "resource_id string, rtype string, category string, feature string, ts timestamp_ntz, value double")
    found = {(r.rtype, r.valid_from): r for r in prediction.profile_versions(df).collect()}
    assert all(rtype == "t" for rtype, _ in found)
    for (_, when), r in found.items():
        own = [x[5] for x in rows if x[1] == "t" and x[5] is not None and x[4] < when]
        mean = sum(own) / len(own)
        assert r.n == len(own) and abs(r.mean - mean) < 1e-9 and abs(r.sd - (sum((v - mean) ** 2 for v in own) / len(own)) ** 0.5) < 1e-6
    cut = at(24 * 12)
    before = {(r.rtype, r.valid_from): r for r in prediction.profile_versions(df.where(F.col("ts") < F.lit(cut))).collect()}
    assert before == {k: v for k, v in found.items() if k[1] <= cut}


def test_a_lasting_shift_shows(spark):
    rows = [("r", "t", "c", "f", at(6 * k), 10.0 + k % 3 + (50 if k >= 84 else 0)) for k in range(96)]
    df = spark.createDataFrame(rows, "resource_id string, rtype string, category string, feature string, ts timestamp_ntz, value double")
    shifted = {r.valid_from: r.shifted for r in prediction.profile_versions(df, sigmas=1.5).collect()}
    assert not any(v for k, v in shifted.items() if k <= at(84 * 6)) and shifted[max(shifted)]


def test_priors_are_medians_of_slopes(spark):
    """Series that rise by their range over the span, by half of it, and not at all; the next week's prior has them all."""
    rows = [(f"r{s}", "t", "c", "f", at(5 * k), float(k * s)) for s in range(3) for k in range(20)] + [("few", "t", "c", "f", at(k), 1.0) for k in range(3)]
    df = spark.createDataFrame(rows, "resource_id string, rtype string, category string, feature string, ts timestamp_ntz, value double")
    r = prediction.prior_versions(df).collect()
    assert [(x.valid_from, x.pool) for x in r] == [(at(24 * 7), 3)] and abs(r[0].prior - 1 / 95) < 1e-12


def test_every_metric_is_predicted_once(spark):
    rows = prediction_queries.readings(spark, SF)
    got = prediction_queries.assembled(spark, SF).select("resource_id", "category", "feature", "method", "advice", "gate", "f_1h", "failures").collect()
    keys = {(r.resource_id, r.category, r.feature) for r in rows.select("resource_id", "category", "feature").distinct().collect()}
    assert len(got) == len(keys) and {(r.resource_id, r.category, r.feature) for r in got} == keys
    assert all(r.advice and len(r.advice) == 1 for r in got if r.gate != "normal") and all(r.method for r in got)
    for r in got:
        soon = [f for f in r.failures if f.failure == "CPU_80_PERCENT_BREACH"]
        assert bool(soon) == (r.category == "Compute" and r.feature == "canonical_cpu_pct" and r.f_1h >= 80)


def test_odd_readings(spark):
    """Null values, one reading, equal times, clashing columns; a table without rows."""
    base = prediction_queries.readings(spark, SF)
    odd = base.limit(1).withColumn("resource_id", F.lit("lone")).unionByName(base.limit(1).withColumn("resource_id", F.lit("nulls")).withColumn("value", F.lit(None).cast("double")))
    rows = base.where("resource_id in ('r1', 'r2')").unionByName(odd).unionByName(odd).withColumn("score", F.lit("clash")).withColumn("gate", F.lit(1))
    make = lambda df: prediction.predictions(df, prediction.profile_versions(df), prediction.prior_versions(df), prediction_queries.models(df), predict_queries.order(), df.agg(F.max("ts").alias("now")))
    got = {r.resource_id: r for r in make(rows).collect()}
    assert {"r1", "r2", "lone"} == set(got) and got["lone"].gate == "thin" or got["lone"].gate == "stale"
    assert make(base.limit(0)).count() == 0


def test_forecasts_of_predictions_have_no_call_a_series(spark):
    """Neither the whole nor the live predictions hand single series to Python; nothing of them is left out."""
    for query in (prediction_queries.whole_predictions, prediction_queries.live_predictions):
        out = query(spark, SF)
        plan = out._jdf.queryExecution().toString()
        assert "FlatMapGroups" not in plan and "MapInArrow" in plan


def test_live_predictions_against_one_series_at_a_time(spark):
    x = prediction_queries.assembled(spark, SF).select("resource_id", "category", "feature", "method", "note", "trend", "f_24h", "f_7d_upper", "backtest_method", "backtest_mae", "mixed").collect()
    rows = prediction_queries.readings(spark, SF)
    known = prediction.known(rows, prediction.profile_versions(rows), prediction.prior_versions(rows), prediction_queries.models(rows), predict_queries.order(), rows.agg(F.max("ts").alias("now")), prediction_queries.MINUTES, prediction_queries.HOURS)
    priors = {(r.resource_id, r.feature): S.Prior(r.prior, r.pool or 0, not r.rtype.startswith("other_")) for r in known.select("resource_id", "feature", "rtype", "prior", "pool").collect()}
    series = {}
    for r in rows.select("resource_id", "feature", "ts", "event_id", "value").orderBy("ts", "event_id").collect():
        series.setdefault((r.resource_id, r.feature), []).append(((r.ts - DAY).total_seconds() / 3600, r.value))
    assert len(x) == len(series)
    for r in x:
        t, y = np.array(series[r.resource_id, r.feature]).T
        noisy = r.feature in ("canonical_dns_queries", "canonical_db_connections")
        live, test = S.live(t - t[0], y, noisy, r.feature.endswith("_pct"), r.mixed, priors[r.resource_id, r.feature]), S.backtest(t - t[0], y, noisy)
        assert (r.method, r.note, r.trend, r.backtest_method) == (live["method"], live["note"], live["trend"], test and test["method"]), r
        assert abs(r.f_24h - live["point"][2]) < 0.0011 and abs(r.f_7d_upper - live["upper"][3]) < 0.0011 and (not test or abs(r.backtest_mae - test["mae"]) < 1e-6), r
