"""Registered queries of the smaller operators."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import details, forecast, normalize, profiles, quality, risk_models, serve
from fleetlens.plans.base_queries import N_SQL, P_SQL, SPARSE, nested_documents, r6, typed
from fleetlens.plans.decision_queries import FEED_SQL, NEW_SQL, labelled, newest
from fleetlens.plans.forecast_queries import KEY_SQL, KEYS, OVER, PRED_SQL, X_SQL, predictions
from fleetlens.plans.registration import query

@query(f"""WITH {NEW_SQL} SELECT resource_id, category, metric, CASE WHEN category = 'Compute' AND metric = 'canonical_mem_used_pct' THEN CASE WHEN value >= 90 THEN 'CRITICAL' WHEN value >= 75 THEN 'WARNING' ELSE 'OK' END END AS memory_class,
CASE WHEN category = 'Storage' AND metric = 'canonical_burst_balance_pct' THEN {r6('greatest(0.0, (30 - value) / 30)')} END AS burst_risk, CASE WHEN category = 'Compute' AND metric = 'canonical_mem_used_pct' THEN {r6('least(1.0, greatest(0.0, (value - 70) / 30))')} END AS oom FROM nw""")
def category_payload(spark, d):
    x = newest(spark, d).withColumn("m", details.payload(F.col("category"), F.col("metric"), F.col("value"), F.lit(0.0)))
    burst, oom = F.greatest(F.lit(0.0), (30 - F.col("value")) / 30), F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("value") - 70) / 30))
    near = lambda text, exact: F.when(F.abs(text.cast("double") - exact) < 1e-3, C.r(exact))  # noqa: E731  the payload holds four places
    return x.select("resource_id", "category", "metric", F.col("m")["memory_class"].alias("memory_class"), near(F.col("m")["burst_risk"], burst).alias("burst_risk"), near(F.col("m")["oom_probability"], oom).alias("oom"))


@query(f"WITH {PRED_SQL} SELECT prediction_id, resource_id || ' is ' || lower(severity) || ', ' || feature || ' at ' || printf('%.2f', value) || ', trend stable' AS summary, CASE WHEN score >= 0.6 THEN 'anomaly' ELSE 'steady' END AS kind FROM pr")
def summary_text(spark, d):
    p = predictions(spark, d)
    return p.select("prediction_id", details.summary(F.col("resource_id"), F.col("feature"), F.col("value"), F.col("severity"), F.lit("stable")).alias("summary"), details.prediction_type(F.col("score"), F.lit("stable")).alias("kind"))


@query(f"WITH {PRED_SQL} SELECT prediction_id, resource_id, category, feature AS metric, risk, severity, badge, coalesce(project, 'UNASSIGNED') AS project, strftime(ts, '%Y-%m-%d %H:%M') AS at FROM pr")
def cards(spark, d):
    return details.card(predictions(spark, d))


FEATURES = ["click", "error", "purchase", "signup", "view", "refund"]


@query(f"WITH {P_SQL}, a AS (SELECT resource_id, category, " + ", ".join(f"max((feature = '{f}')::INT) AS {f}" for f in FEATURES) + " FROM p GROUP BY ALL) SELECT *, round_even((" + " + ".join(FEATURES) + ") / 6, 3) AS completeness FROM a")
def availability(spark, d):
    return details.availability(typed(spark, d), FEATURES)


@query(f"WITH {P_SQL} SELECT event_id, resource_id, ts, value FROM p WHERE project = 'p3' AND (SELECT arg_min(project, (ts, event_id)) FROM p WHERE account_id = 'a13') = 'p3'")
def authorised_view(spark, d):
    return details.authorised(typed(spark, d), "a13", "p3").select("event_id", "resource_id", "ts", "value")


@query(f"WITH {P_SQL} SELECT event_id, resource_id FROM p WHERE project = 'p4' AND (SELECT arg_min(project, (ts, event_id)) FROM p WHERE account_id = 'a13') = 'p4'")
def denied_view(spark, d):
    return details.authorised(typed(spark, d), "a13", "p4").select("event_id", "resource_id")


@query(f"WITH {P_SQL} SELECT DISTINCT project FROM p")
def projects(spark, d):
    return typed(spark, d).select("project").distinct()


K = "least(14, greatest(3, round_even(n * 0.2, 0)::INT))"


@query(f"WITH {P_SQL}, c AS (SELECT {KEY_SQL}, count(*) AS n FROM p GROUP BY ALL), b AS (SELECT *, unnest([1, 2, 3, 4]) AS back FROM c WHERE n - {K} >= 8) SELECT {KEY_SQL}, n, n - back * {K} AS start FROM b WHERE n - back * {K} >= 8 OR back = 1")
def fold_points(spark, d):
    return details.fold_points(typed(spark, d).groupBy(*KEYS).agg(F.count("*").alias("n")))


@query(f"""WITH {P_SQL}, z AS (SELECT * REPLACE ({SPARSE} AS value) FROM p), k AS (SELECT *, row_number() OVER {OVER} AS k FROM z), w AS (SELECT *, avg((value = 0)::INT) OVER q AS zf, sum((value <> 0)::INT) OVER q AS re, max(CASE WHEN value <> 0 THEN k END) OVER q AS la FROM k WINDOW q AS (PARTITION BY {KEY_SQL}))
SELECT event_id, resource_id, feature, value FROM w WHERE NOT (zf <= 0.8 AND zf > 0.2 AND re >= 5) OR k <= la""")
def trailing_trim(spark, d):
    return details.trimmed(typed(spark, d).withColumn("value", F.expr(SPARSE)), KEYS).select("event_id", "resource_id", "feature", "value")


@query(f"""WITH {X_SQL}, m AS (SELECT {KEY_SQL}, avg(value) AS m, min(value) AS lo, max(value) AS hi FROM x WHERE back > 3 GROUP BY ALL), e AS (SELECT x.resource_id, x.category, x.feature, avg(abs(value - m)) / avg(abs(m)) AS mase, avg((value BETWEEN lo AND hi)::INT) * 100 AS cov FROM x JOIN m ON x.resource_id = m.resource_id AND x.category = m.category AND x.feature = m.feature WHERE back <= 3 GROUP BY ALL)
SELECT {KEY_SQL}, {r6("0.7 * greatest(0.0, least(100.0, 100 - 50 * mase)) + 0.3 * CASE WHEN cov BETWEEN 60 AND 95 THEN 100.0 WHEN cov > 95 THEN greatest(0.0, 100 - 4 * (cov - 95)) ELSE cov / 0.6 END")} AS quality FROM e""")
def backtest_quality(spark, d):
    """The score of a flat forecast (the mean) of each series' last three points."""
    from pyspark.sql import Window

    x = typed(spark, d).withColumn("back", F.row_number().over(Window.partitionBy(*KEYS).orderBy(F.desc("ts"), F.desc("event_id"))))
    m = x.where("back > 3").groupBy(*KEYS).agg(F.avg("value").alias("m"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    e = x.where("back <= 3").join(m, KEYS).groupBy(*KEYS).agg((F.avg(F.abs(F.col("value") - F.col("m"))) / F.avg(F.abs("m"))).alias("mase"), (F.avg(F.col("value").between(F.col("lo"), F.col("hi")).cast("double")) * 100).alias("cov"))
    return e.select(*KEYS, C.r(details.quality_score(F.col("mase"), F.col("cov"))).alias("quality"))


@query(f"WITH {NEW_SQL} SELECT resource_id, feature, metric, CASE WHEN metric LIKE '%\\_pct' ESCAPE '\\' THEN '%' WHEN metric LIKE '%\\_bytes' ESCAPE '\\' THEN 'bytes' WHEN metric LIKE '%\\_ms' ESCAPE '\\' THEN 'ms' WHEN metric LIKE '%\\_iops' ESCAPE '\\' THEN 'ops/s' ELSE 'count' END AS unit, CASE WHEN metric LIKE '%\\_pct' ESCAPE '\\' THEN printf('%.1f%%', round(value + 3.7e-8, 1)) ELSE printf('%.2f', value) END AS shown FROM nw")
def metric_units(spark, d):
    x = newest(spark, d)
    value = F.when(F.col("metric").endswith("_pct"), C.r(F.col("value"), 1)).otherwise(F.col("value"))
    return x.select("resource_id", "feature", "metric", details.metric_unit(F.col("metric")).alias("unit"), C.format_value(F.col("metric"), value).alias("shown"))


@query(f"WITH {PRED_SQL}, q AS (SELECT resource_id, feature, {'CASE severity ' + ' '.join(f'WHEN {chr(39)}{s}{chr(39)} THEN {k}' for k, s in enumerate(('CRITICAL', 'HIGH', 'WARNING', 'INFO'))) + ' END'} AS s, -risk AS r FROM pr) SELECT resource_id, array_to_string(list(feature ORDER BY s, r, feature)[1:6], ',') AS dominant FROM q GROUP BY 1")
def dominant_metrics(spark, d):
    return details.top_dominant(predictions(spark, d))


@query(f"WITH {P_SQL} SELECT category, feature, {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS sd FROM p GROUP BY ALL")
def label_stats(spark, d):
    return details.label_stats(typed(spark, d)).select("category", "feature", C.r(F.col("mean")).alias("mean"), C.r(F.col("sd")).alias("sd"))


@query(f"WITH {FEED_SQL} SELECT category, max(outcome_at) AS newest, coalesce((epoch_us((SELECT max(ts) FROM p)) - epoch_us(max(outcome_at))) / 1e6 / 3600 > 48, true) AS stale FROM fb GROUP BY 1")
def feedback_staleness(spark, d):
    now = typed(spark, d).agg(F.max("ts").alias("now"))
    return details.stale_feedback(labelled(spark, d), now)


@query(f"""WITH {P_SQL}, ps AS (SELECT rtype, category, feature, avg(value) AS mean, quantile_cont(value, 0.05) AS p5 FROM (SELECT * REPLACE ({SPARSE} AS value) FROM p) GROUP BY ALL HAVING count(*) >= 5)
SELECT z.event_id, CASE WHEN z.value <> 0 THEN 'nonzero' WHEN p5 IS NULL THEN 'unknown' WHEN p5 <= 0 THEN 'idle' WHEN mean > 0 THEN 'suspect' ELSE 'unknown' END AS kind FROM (SELECT * REPLACE ({SPARSE} AS value) FROM p) z LEFT JOIN ps USING (rtype, category, feature)""")
def zero_kinds(spark, d):
    rows = typed(spark, d).withColumn("value", F.expr(SPARSE))
    return rows.join(profiles.profile_stats(rows), profiles.POOL, "left").select("event_id", profiles.classify_zero(F.col("value"), F.col("p5"), F.col("mean")).alias("kind"))


@query(f"WITH {P_SQL}, n AS (SELECT max(ts) AS now FROM p) SELECT event_id, CASE WHEN (epoch_us(now) - epoch_us(ts)) / 1e6 / 60 > 0 AND (epoch_us(now) - epoch_us(ts)) / 1e6 / 60 <= 15 THEN now ELSE ts END AS ts FROM p, n")
def late_arrivals(spark, d):
    t = typed(spark, d)
    return t.select("event_id", quality.late_arrival(F.col("ts"), t.agg(F.max("ts")).scalar()).alias("ts"))


@query(f"WITH {N_SQL}, q AS (SELECT category, provider, metric, count(*) AS documents FROM pt GROUP BY ALL) SELECT q.metric, sum(documents)::BIGINT AS documents FROM q WHERE NOT EXISTS (SELECT 1 FROM reg WHERE reg.category = q.category AND reg.provider = q.provider AND reg.raw_metric = q.metric) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def top_unmapped(spark, d):
    c = normalize.coverage(normalize.points(nested_documents(spark, d)), normalize.rule_table(spark))
    return c.where("not mapped").groupBy("metric").agg(F.sum("documents").alias("documents")).orderBy(F.desc("documents"), "metric").limit(50)


@query(f"WITH {P_SQL} SELECT event_id, ts, feature, value FROM p WHERE resource_id = 'r7' ORDER BY ts DESC, event_id DESC LIMIT 25")
def resource_history(spark, d):
    return typed(spark, d).where("resource_id = 'r7'").orderBy(F.desc("ts"), F.desc("event_id")).limit(25).select("event_id", "ts", "feature", "value")


TAGS = [("Env", "prod"), ("team", "a")]


@query(f"WITH {P_SQL}, e AS (SELECT DISTINCT resource_id, CAST(substr(resource_id, 2) AS INT) % 3 AS m FROM p) SELECT resource_id, m = 0 AS matched FROM e")
def tag_filter(spark, d):
    """Every third resource is tagged env=prod and team=a, the next misses a tag, the last has another value."""
    m = F.substring("resource_id", 2, 9).cast("int") % 3
    e = typed(spark, d).select("resource_id").distinct()
    tags = F.when(m == 0, F.create_map(F.lit("ENV"), F.lit("prod"), F.lit("Team"), F.lit("a"))).when(m == 1, F.create_map(F.lit("env"), F.lit("prod"))).otherwise(F.create_map(F.lit("env"), F.lit("test"), F.lit("team"), F.lit("a")))
    wanted = F.create_map(*[F.lit(x) for pair in TAGS for x in pair])
    return e.select("resource_id", serve.tag_match(tags, wanted).alias("matched"))


@query(f"WITH {P_SQL} SELECT event_id, resource_id, (vmax IS NULL)::INT AS vmax_missing, (CASE WHEN sample_count > 50 THEN sample_count END IS NULL)::INT AS count_missing FROM p")
def missingness(spark, d):
    t = typed(spark, d)
    return t.select("event_id", "resource_id", F.col("vmax").isNull().cast("int").alias("vmax_missing"), F.when(F.col("sample_count") > 50, F.col("sample_count")).isNull().cast("int").alias("count_missing"))


@query(f"""WITH {P_SQL}, ts0 AS (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY ts, event_id) <= greatest(1, floor(0.8 * count(*) OVER (PARTITION BY resource_id))) AS train FROM p),
st AS (SELECT category, feature, avg(value) AS mean, stddev_samp(value) AS sd FROM ts0 WHERE train GROUP BY ALL), sc AS (SELECT vmax > mean + sd AS a, value > mean + sd AS b FROM ts0 JOIN st USING (category, feature) WHERE NOT train),
c AS (SELECT count(*) FILTER (a AND b)::DOUBLE AS tp, count(*) FILTER (a AND NOT b)::DOUBLE AS fp, count(*) FILTER (NOT a AND b)::DOUBLE AS fn, count(*) FILTER (NOT a AND NOT b)::DOUBLE AS tn FROM sc)
SELECT tp + fp + fn + tn AS n, {r6('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy, {r6('greatest(tp + fn, tn + fp) / (tp + fp + fn + tn)')} AS majority, {r6('tp / greatest(1, tp + fp)')} AS precision, {r6('tp / greatest(1, tp + fn)')} AS recall, {r6('2 * tp / greatest(1, 2 * tp + fp + fn)')} AS f1 FROM c""")
def classifier_metrics(spark, d):
    """A-21 of a rule: high readings of the first 80 percent's scale predict outliers."""
    x = forecast.time_split(typed(spark, d))
    stats = details.label_stats(x.where("train"))
    y = x.where("not train").join(stats, ["category", "feature"])
    scored = y.select((F.col("vmax") > F.col("mean") + F.col("sd")).cast("int").alias("prediction"), (F.col("value") > F.col("mean") + F.col("sd")).cast("int").alias("label"))
    return risk_models.classifier_metrics(scored).select("n", *[C.r(F.col(c)).alias(c) for c in ("accuracy", "majority", "precision", "recall", "f1")])


@query(f"WITH {PRED_SQL} SELECT project, category, count(*) AS n, {r6('sum(risk)')} AS risk FROM pr GROUP BY ALL")
def by_project_layout(spark, d):
    """K-9, K-3: written by project and read back, as the old per-project collections were."""
    from fleetlens.plans.decision_queries import scratch

    path = scratch(spark)
    predictions(spark, d).select("project", "category", "risk").write.partitionBy("project").parquet(path)
    return spark.read.parquet(path).groupBy("project", "category").agg(F.count("*").alias("n"), C.r(F.sum("risk")).alias("risk"))


@query(f"WITH {PRED_SQL} SELECT prediction_id, greatest(1, length(resource_id || ' | ' || category || ' | risk ' || printf('%.1f', round(risk + 3.7e-8, 1)) || ' | ' || severity || ' | ' || printf('%.2f', value)) // 4) AS tokens FROM pr")
def token_estimates(spark, d):
    p = predictions(spark, d).withColumn("risk", C.r(F.col("risk"), 1))
    return serve.digest_line(p).select("prediction_id", "tokens")

