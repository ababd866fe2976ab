"""Incremental pools against one run over all rows: replaced and deleted rows, broken runs, summing up, null keys."""

import datetime as dt

from pyspark.sql import functions as F

from fleetlens.operators import incremental, profiles

T0 = dt.datetime(2024, 1, 1)
KIND = "event_id long, resource_id string, rtype string, category string, feature string, ts timestamp_ntz, value double, merged int, note string"


def make(spark, n=600, late=lambda k: 0):
    rows = [(k, f"r{k % 12}", "vm" if k % 12 < 8 else None, "Compute", f"f{k % 2}", T0 + dt.timedelta(minutes=37 * k), None if k % 50 == 7 else float((k * 7919) % 101) / 4, late(k), "x") for k in range(n)]
    return spark.createDataFrame(rows, KIND)


def states(spark, path):
    found = [f(spark, path) for f in (incremental.profile_stats, incremental.diurnal, incremental.cadence, incremental.slope_priors)]
    return [sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in t.collect()) for t in found]


def test_runs_equal_one_run_and_the_plain_pools(spark, tmp_path):
    rows = make(spark, late=lambda k: 1 if k % 12 == 3 and k > 300 else 0).withColumn("id", F.col("event_id"))
    parts, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    wrong = rows.where("id < 100 and id % 12 = 3").withColumn("value", F.lit(900.0))
    first = rows.where("merged = 0 and not (id < 100 and id % 12 = 3)").unionByName(wrong)
    gone = rows.where("id = 2")
    now = rows.where("id <> 2").withColumn("merged", F.when(F.expr("id < 100 and id % 12 = 3"), 1).otherwise(F.col("merged")))
    assert incremental.run(first, parts) == "full" and incremental.run(first, parts) == "none"
    assert incremental.run(now, parts, before=wrong.unionByName(gone)) == "changed"
    assert incremental.run(now, whole) == "full"
    assert states(spark, parts) == states(spark, whole)
    plain = {(r.feature, r.n, round(r.p5, 9)) for r in profiles.profile_stats(now.where("rtype is not null")).collect()}
    assert plain == {(r.feature, r.n, round(r.p5, 9)) for r in incremental.profile_stats(spark, parts).where("rtype is not null").collect()}
    assert incremental.profile_stats(spark, parts).where("rtype is null").count() == 2


def test_many_changed_series_mean_a_full_sweep(spark, tmp_path):
    rows, path = make(spark, late=lambda k: k // 300), str(tmp_path / "p")
    assert incremental.run(rows.where("merged = 0"), path) == "full"
    assert incremental.run(rows, path) == "full"
    assert incremental.last(spark, path).base == 1


def test_a_run_that_broke_off_leaves_no_trace(spark, tmp_path):
    rows, path, clean = make(spark, late=lambda k: int(k % 12 == 5 and k > 400)), str(tmp_path / "p"), str(tmp_path / "c")
    incremental.run(rows.where("merged = 0"), path)
    incremental.counts(rows).write.parquet(f"{path}/counts/run=1")  # written, never committed
    assert incremental.last(spark, path).run == 0
    assert incremental.run(rows, path) == "changed"
    incremental.run(rows, clean)
    assert states(spark, path) == states(spark, clean)


def test_runs_are_summed_up(spark, tmp_path):
    rows, path, clean = make(spark, late=lambda k: k // 120 if k % 12 == 5 else 0), str(tmp_path / "p"), str(tmp_path / "c")
    kinds = [incremental.run(rows.where(F.col("merged") <= m), path, most=2) for m in range(5)]
    assert kinds == ["full", "changed", "changed", "changed", "changed"] and incremental.last(spark, path).base == 4
    incremental.run(rows, clean)
    assert states(spark, path) == states(spark, clean)


def test_empty_tables_and_rows_without_a_merge_time(spark, tmp_path):
    rows, path = make(spark), str(tmp_path / "p")
    assert incremental.run(rows.limit(0), path) == "none" and incremental.last(spark, path) is None
    assert incremental.run(rows.withColumn("merged", F.lit(None).cast("int")), path) == "none"
