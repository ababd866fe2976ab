"""Facts for explanations, replies of providers, summaries of summaries, saved models."""

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import explain, risk_models, serve


@pytest.mark.parametrize(
    ("feature", "current", "daily", "health", "growth", "warning", "critical"),
    [
        ("canonical_cpu_pct", 70.0, 5.0, "HEALTHY", "steadily increasing", 2.0, 4.0),
        ("canonical_cpu_pct", 85.0, 5.0, "WARNING", "rapidly increasing", 0.0, 1.0),
        ("canonical_cpu_pct", 70.0, -0.5, "HEALTHY", "slowly decreasing", None, None),
        ("canonical_cpu_pct", 10.0, 0.01, "HEALTHY", "slowly increasing", None, None),
        ("canonical_cpu_pct", 70.0, 0.001, "HEALTHY", "stable", None, None),
        ("canonical_burst_balance_pct", 15.0, -1.0, "WARNING", "steadily declining", 0.0, 5.0),
        ("canonical_burst_balance_pct", 5.0, 1.0, "CRITICAL", "recovering", None, None),
        ("canonical_dns_queries", 10.0, 3.0, "UNKNOWN", "rapidly increasing", None, None),
        ("canonical_dns_queries", 0.0, 3.0, "UNKNOWN", "increasing", None, None),
        ("canonical_cpu_pct", None, None, "UNKNOWN", None, None, None),
    ],
)
def test_facts(spark, feature, current, daily, health, growth, warning, critical):
    row = spark.createDataFrame([(feature, current, daily)], "f string, c double, d double")
    f, c, d = F.col("f"), F.col("c"), F.col("d")
    got = row.select(explain.health(f, c), explain.growth(f, c, d), explain.days_to(f, c, d, 0), explain.days_to(f, c, d, 1)).first()
    assert (got[0], got[1]) == (health, growth)
    assert [got[2], got[3]] == pytest.approx([warning, critical]) if warning is not None else got[2] is None and got[3] is None


def test_spans_and_grades(spark):
    rows = spark.createDataFrame([(0.0, 81.0, 0.75), (0.5, 60.0, 1.2), (3.0, 20.0, None), (14.0, None, None), (60.0, 50.0, 1.0), (None, 79.9, 0.0)], "d double, q double, m double")
    marks = explain.evaluation(F.col("q"), F.col("m"), F.col("m") > 0)
    got = rows.select(explain.span(F.col("d")), *marks.values()).collect()
    assert [r[0] for r in got] == ["already breached", "12 h", "about 3.0 days", "about 2.0 weeks", "about 2.0 months", None]
    assert [r[2] for r in got] == ["excellent", "acceptable", "poor", None, "acceptable", "acceptable"]
    assert [r[3] for r in got] == [25.0, None, None, None, None, 100.0]
    assert [r[1] == "in_sample_fit" for r in got] == [False, False, True, True, False, True]


def test_replies():
    assert serve.parse_reply('<think>so</think>\n```json\n{"a": 1}\n```') == {"a": 1}
    assert serve.parse_reply('{"a": 1}') == {"a": 1}
    assert serve.parse_reply("no object")["parse_error"] and serve.parse_reply("[1]")["narrative"] == "[1]"


def test_retries():
    seen = []

    def call(x):
        seen.append(x)
        if len(seen) < 3:
            raise ValueError("again")
        return x

    assert serve.with_retries(call, wait=0)(7) == 7 and len(seen) == 3
    with pytest.raises(ZeroDivisionError):
        serve.with_retries(lambda: 1 / 0, retries=1, wait=0)()


def test_summaries_of_summaries(spark):
    rows = [("a", n, f"t{n}", None) for n in range(20)] + [("b", 0, "only", None), ("c", 0, None, "broken"), ("d", 0, "x", None), ("d", 1, None, "lost")]
    parts = spark.createDataFrame(rows, "project string, chunk int, summary string, error string")
    got = {r.project: r for r in serve.reduce_summaries(parts, fan_in=3).collect()}
    assert got["a"].summary.split("\n") == [f"t{n}" for n in range(20)] and got["a"].chunks == 20
    assert got["b"].summary == "only" and (got["c"].summary, got["c"].error) == (None, "broken")
    assert (got["d"].summary, got["d"].error) == ("x", "lost")
    most = serve.reduce_summaries(parts, lambda project, texts: f"{len(texts)}", fan_in=3)
    assert {r.project: r.summary for r in most.collect()}["a"] == "3"
    assert serve.reduce_summaries(parts.limit(0)).count() == 0


def test_search_and_latest(spark):
    rows = spark.createDataFrame([("r1", "aws", "Compute", "eu", 10.0, 1, "p1"), ("r1", "aws", "Compute", "eu", 90.0, 2, "p2"), ("r2", None, "Storage", "us", 50.0, 1, "p3")], "resource_id string, provider string, category string, location string, risk double, ts int, prediction_id string")
    projects = spark.createDataFrame([("AWS-x",), ("other",)], "project string")
    assert sorted(explain.find(projects, rows, "aws").collect()) == [("project", "AWS-x", None), ("resource", "r1", 90.0)]
    told = rows.withColumn("narrative", F.when(F.col("prediction_id") != "p2", F.col("prediction_id")))
    assert sorted(r.narrative for r in explain.latest_explanations(told).collect()) == ["p1", "p3"]
    assert explain.profile_of(rows.withColumn("rtype", F.lit("vm")), "Compute", "db").count() == 0


def test_models_saved_and_measured(spark, tmp_path):
    rows = spark.createDataFrame([(float(n), None if n % 7 == 0 else float(n % 5), "ab"[n % 2], int(n > 30)) for n in range(60)], "x double, y double, kind string, label int")
    model = risk_models.train_classifier(rows, ["x", "y"], ["kind"], trees=5)
    risk_models.save_models({"Compute": model}, str(tmp_path))
    again = risk_models.load_models(str(tmp_path), ["Compute"])["Compute"]
    ask = lambda m: [r.model_risk for r in risk_models.risk(m, rows).orderBy("x").collect()]
    assert ask(again) == ask(model)
    scored = risk_models.risk(model, rows).withColumn("label", F.col("label").cast("double"))
    assert risk_models.area_under_roc(scored, "model_risk") > 0.95
    at = spark.createDataFrame([(0.12,), (-0.12,), (0.0,), (1.0,)], "s double").select(risk_models.risk_of_anomaly(F.col("s"))).collect()
    assert [r[0] for r in at] == pytest.approx([0, 100, 50, 0])
