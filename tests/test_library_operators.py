"""Operators on literals, where the registered queries don't reach."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from fleetlens.operators import anomaly, decisions, details, ingest, normalize, pools, serve
from fleetlens.sources.shared import cut
from fleetlens.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def test_null_versions_are_older_than_any(spark):
    inv = spark.createDataFrame([("e", "a", None, "x"), ("e", "a", 3, "y"), ("e", "b", None, "z")], "element_id string, account_id string, version long, project string")
    got = {(r.element_id, r.account_id): r.project for r in ingest.latest_inventory(inv).collect()}
    assert got == {("e", "a"): "y", ("e", "b"): "z"}


def test_conflicts_prefer_an_average_then_scan_order(spark):
    rows = [("r", "Compute", "AWS", T0, "m", 1.0, "maximum", T0, 1), ("r", "Compute", "AWS", T0, "m", 2.0, "average", T0, 2), ("r", "Compute", "AWS", T0, "m", 3.0, "average", T0, 3), ("r", "Compute", "AWS", T0, "k", 4.0, "sum", T0, 4)]
    df = spark.createDataFrame(rows, "resource_id string, category string, provider string, ts timestamp_ntz, metric string, value double, stat string, from_date timestamp_ntz, _id long")
    assert {(r.metric, r.value) for r in normalize.resolve_conflicts(df).collect()} == {("m", 2.0), ("k", 4.0)}


def test_points_of_a_document_without_readings(spark):
    df = spark.createDataFrame([(1, [{"Average": "2"}, {"average": "x", "Sum": "5"}], T0, None), (2, None, None, T0)], "_id long, metric_value array<map<string,string>>, from_date timestamp_ntz, created_at timestamp_ntz")
    got = sorted((r._id, r.value, r.stat, r.ts) for r in normalize.points(df).where("value is not null").collect())
    assert got == [(1, 2.0, "average", T0), (1, 5.0, "sum", T0)]
    assert normalize.points(df).where("_id = 2").first().ts == T0


def test_next_breach_interpolates_and_sees_a_present_one(spark):
    rows = [("a", float(h), v, "gte", 10.0) for h, v in ((0, 4.0), (6, 8.0), (24, 14.0))] + [("b", 0.0, 12.0, "gte", 10.0), ("c", 0.0, 1.0, "gte", 10.0)]
    got = {r.k: r.eta_hours for r in decisions.next_breach(spark.createDataFrame(rows, "k string, hours double, value double, operator string, limit double"), ["k"]).collect()}
    assert got == {"a": 12.0, "b": 0.0, "c": None}


def test_upsert_keeps_the_newest_and_may_repeat(spark):
    old = spark.createDataFrame([(1, 1, "o"), (2, 1, "o")], "id long, v long, s string")
    new = spark.createDataFrame([(2, 2, "n"), (2, 3, "m"), (3, 1, "n")], "id long, v long, s string")
    once = decisions.upsert(old, new, ["id"], "v")
    want = {(1, 1, "o"), (2, 3, "m"), (3, 1, "n")}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in decisions.upsert(once, new, ["id"], "v").collect()}


def test_redaction(spark):
    m = F.create_map(*[F.lit(x) for x in ("DB_Password", "x", "home", "https://a.example", "note", "word " * 100, "key", "A" * 40)])
    got = spark.range(1).select(serve.redact(m).alias("m")).first().m
    assert "DB_Password" not in got and got["home"] == got["key"] == "[hidden]" and len(got["note"]) == 403


def test_token_chunks_stay_in_budget(spark):
    rows = [("p", c, f"r{k}", "f", 30, k) for c in "ABC" for k in range(5)] + [("p", "Z", "big", "f", 500, 0)]
    got = serve.token_chunks(spark.createDataFrame(rows, "project string, category string, resource_id string, feature string, tokens long, rank int"), 160).toPandas()
    sizes = got.groupby("chunk").tokens.sum()
    assert (sizes[sizes < 500] <= 160).all() and got.groupby("category").chunk.nunique().max() == 1


def test_failing_summaries_become_error_rows(spark):
    def call(project, lines):
        if project == "bad":
            raise ValueError("no")
        return f"{project}:{len(lines)}"

    rows = spark.createDataFrame([("bad", 0, "x"), ("ok", 0, "a"), ("ok", 0, "b")], "project string, chunk int, digest string")
    got = {r.project: (r.summary, r.error) for r in serve.summarise(rows, call).collect()}
    assert got == {"bad": (None, "no"), "ok": ("ok:2", None)}


def test_forest_ranks_outliers_first():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (500, 2)), [[9, 9], [-8, 9]]])
    score = anomaly.isolation_score(anomaly.grow(x, trees=60), x, 502)
    assert set(np.argsort(-score)[:2]) == {500, 501}


def test_payload_by_category(spark):
    df = spark.createDataFrame([("Compute", "canonical_mem_used_pct", 85.0), ("Storage", "canonical_burst_balance_pct", 15.0), ("Other", "x", 1.0)], "c string, f string, v double")
    got = [r.m for r in df.select(details.payload(F.col("c"), F.col("f"), F.col("v"), F.lit(10.0)).alias("m")).collect()]
    assert got == [{"memory_class": "WARNING", "oom_probability": "0.5"}, {"burst_risk": "0.5"}, {}]


def test_streams_roll_up_and_fan_out(spark, tmp_path):
    rows = [("a", T0 + dt.timedelta(minutes=20 * k), float(k)) for k in range(12)]
    spark.createDataFrame(rows, "k string, ts timestamp, value double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, ts timestamp, value double").parquet(str(tmp_path / "in"))
    seen = []
    jobs.fan_out(stream, [lambda b, n: seen.append(b.count()), lambda b, n: seen.append(b.agg(F.sum("value")).first()[0])], str(tmp_path / "c1")).awaitTermination()
    assert seen == [12, 66.0]
    jobs.run_once(jobs.hourly_rollup(stream, ["k"]), str(tmp_path / "out"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 1


def test_quantiles_are_those_of_all_values(spark):
    rng = np.random.default_rng(4)
    rows = [(k, float(v)) for k, values in {"a": rng.normal(0, 100, 500).round(1), "b": rng.lognormal(0, 8, 300), "c": [5.0], "d": [-2.0, -2.0, 0.0, 1e-300]}.items() for v in values] + [("a", None), ("e", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in pools.quantiles(df, ["k"], "v", {"lo": 0.05, "mid": 0.5, "top": 1 - 5 / (F.col("n") + 5)}).collect()}
    assert set(got) == {"a", "b", "c", "d", None} and got[None].mid == 1.5
    for k in "abcd":
        own = np.array([v for x, v in rows if x == k and v is not None])
        want = np.quantile(own, [0.05, 0.5, 1 - 5 / (len(own) + 5)])
        assert got[k].n == len(own) and np.allclose([got[k].lo, got[k].mid, got[k].top], want, rtol=1e-12)


def test_every_tree_draws_from_the_whole_pool(spark):
    rows = spark.range(3000).select(F.lit("t").alias("rtype"), F.col("id").cast("string").alias("resource_id"), F.lit("c").alias("category"), F.lit(T0).cast("timestamp_ntz").alias("ts"), F.lit(3000).cast("long").alias("pool"), F.array(F.when(F.col("id") < 5, 50.0).otherwise(F.rand(1))).alias("z"))
    rows = cut(rows)
    model = cut(anomaly.trees(rows, count=20, sample=64))
    got = anomaly.forest_scores(rows, model).groupBy((F.col("resource_id").cast("int") < 5).alias("far")).agg(F.min("raw").alias("lo"), F.avg("raw").alias("m")).collect()
    by = {r.far: r for r in got}
    assert model.count() == 20 and by[True].lo > by[False].m + 0.1
    wide = anomaly.trees(rows, count=2, sample=100).toPandas()
    assert {np.frombuffer(n).reshape(-1, 5)[0, 4] > 60 for n in wide.nodes} == {True}
