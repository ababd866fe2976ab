"""Registered queries of explanations, searches and measures. Their SQL states every limit itself."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import explain, risk_models, serve
from fleetlens.plans.base_queries import r6
from fleetlens.plans.forecast_queries import PRED_SQL, predictions
from fleetlens.plans.predict_queries import LINE_SQL, SERIES, S, forecasted, metrics
from fleetlens.plans.registration import query

CONTEXT_SQL = f"""{LINE_SQL}, hw AS (SELECT {S}, 1.28 * stddev_samp(value) AS half FROM mm GROUP BY ALL),
lim(feature, warn, crit) AS (VALUES ('canonical_cpu_pct', 80.0::DOUBLE, 90.0::DOUBLE), ('canonical_mem_used_pct', 80.0, 90.0), ('canonical_storage_used_pct', 80.0, 90.0), ('canonical_node_cpu_pct', 80.0, 90.0), ('canonical_node_mem_pct', 80.0, 90.0),
 ('canonical_db_cpu_pct', 80.0, 90.0), ('canonical_db_storage_pct', 85.0, 95.0), ('canonical_subnet_util_pct', 75.0, 90.0), ('canonical_burst_balance_pct', 20.0, 10.0), ('canonical_health_pct', 90.0, 80.0)),
c0 AS (SELECT fc.resource_id, fc.category, fc.feature, current, f1, f6, f24, f168, half, warn, crit, coalesce(crit < warn, false) AS low, (f168 - current) / 7 AS daily
 FROM fc LEFT JOIN lim ON lim.feature = fc.feature JOIN hw ON hw.resource_id = fc.resource_id AND hw.category = fc.category AND hw.metric = fc.feature),
c1 AS (SELECT *, CASE WHEN low THEN current <= warn ELSE current >= warn END AS at_w, CASE WHEN low THEN current <= crit ELSE current >= crit END AS at_c, CASE WHEN low THEN current - warn ELSE warn - current END AS to_w, CASE WHEN low THEN current - crit ELSE crit - current END AS to_c,
 CASE WHEN feature LIKE '%\\_pct' ESCAPE '\\' THEN CASE WHEN low THEN current ELSE 100 - current END END AS head, CASE WHEN low THEN -daily ELSE daily END AS toward, 2 * half / abs(nullif(current, 0)) AS share FROM c0),
c2 AS (SELECT *, CASE WHEN warn IS NULL THEN 'UNKNOWN' WHEN at_c THEN 'CRITICAL' WHEN at_w THEN 'WARNING' ELSE 'HEALTHY' END AS health, abs(daily) / greatest(head, 0.1) * 100 AS taken,
 CASE WHEN toward > 0 AND head IS NOT NULL THEN CASE WHEN at_w THEN 0 WHEN to_w / toward < 3650 THEN to_w / toward END END AS dw, CASE WHEN toward > 0 AND head IS NOT NULL THEN CASE WHEN at_c THEN 0 WHEN to_c / toward < 3650 THEN to_c / toward END END AS dc FROM c1),
cx AS (SELECT *, CASE WHEN daily IS NULL THEN NULL WHEN abs(daily) < 0.005 THEN 'stable'
 WHEN head IS NULL THEN CASE WHEN current <> 0 AND abs(daily) / abs(current) > 0.2 THEN 'rapidly ' ELSE '' END || CASE WHEN daily > 0 THEN 'increasing' ELSE 'decreasing' END
 WHEN low AND daily > 0 THEN 'recovering' ELSE CASE WHEN taken > 20 THEN 'rapidly ' WHEN taken > 5 THEN 'steadily ' ELSE 'slowly ' END || CASE WHEN low THEN 'declining' WHEN daily > 0 THEN 'increasing' ELSE 'decreasing' END END AS growth,
 CASE WHEN share < 0.05 THEN 'very stable' WHEN share < 0.15 THEN 'moderately stable' WHEN share < 0.4 THEN 'moderately volatile' WHEN share IS NOT NULL THEN 'highly volatile' END AS volatility FROM c2)"""


def contexts(spark, d):
    half = metrics(spark, d).groupBy(*SERIES).agg((1.28 * F.stddev_samp("value")).alias("half")).withColumnRenamed("metric", "feature")
    return explain.context(forecasted(spark, d).join(half, ["resource_id", "category", "feature"]))


@query(f"""WITH {CONTEXT_SQL} SELECT resource_id, category, feature, health, growth, volatility, {r6('CASE WHEN NOT coalesce(at_w, false) THEN to_w END')} AS gap_to_warning, {r6('CASE WHEN at_w THEN -to_w END')} AS exceeded_by,
 {r6('CASE WHEN NOT coalesce(at_w, false) THEN current / warn * 100 END')} AS of_warning_pct, {r6('head')} AS headroom_pct, {r6('100 - head')} AS consumed_pct, {r6('daily')} AS daily_change, round(dw + 3.7e-8, 3) AS days_to_warning, round(dc + 3.7e-8, 3) AS days_to_critical FROM cx""")
def explanation_context(spark, d):
    rounded = ["gap_to_warning", "exceeded_by", "of_warning_pct", "headroom_pct", "consumed_pct", "daily_change"]
    days = [C.r(F.col(c), 3).alias(c) for c in ("days_to_warning", "days_to_critical")]
    return contexts(spark, d).select("resource_id", "category", "feature", "health", "growth", "volatility", *[C.r(F.col(c)).alias(c) for c in rounded], *days)


@query(f"""WITH {CONTEXT_SQL}, h AS (SELECT *, unnest([1, 6, 24, 168]) AS hours, unnest([f1, f6, f24, f168]) AS v FROM cx)
SELECT resource_id, category, feature, hours, {r6('v')} AS value, {r6('v - half')} AS lower, {r6('v + half')} AS upper,
 CASE WHEN warn IS NULL OR v IS NULL THEN 'UNKNOWN' WHEN low AND v <= crit OR NOT low AND v >= crit THEN 'CRITICAL' WHEN low AND v <= warn OR NOT low AND v >= warn THEN 'WARNING' ELSE 'HEALTHY' END AS health FROM h WHERE v IS NOT NULL""")
def explanation_horizons(spark, d):
    each = contexts(spark, d).select("resource_id", "category", "feature", F.explode("horizons").alias("h"))
    return each.select("resource_id", "category", "feature", "h.hours", "h.health", *[C.r(F.col(f"h.{c}")).alias(c) for c in ("value", "lower", "upper")])


@query()
def explanation_prompts(spark, d):
    """E-4: printed numbers, so rows only."""
    return contexts(spark, d).select("resource_id", "category", "feature", explain.prompt().alias("prompt"))


@query(f"""WITH {PRED_SQL}, pj AS (SELECT 'project' AS kind, project AS key, NULL::DOUBLE AS risk FROM (SELECT DISTINCT project FROM pr) WHERE lower(project) LIKE '%1%' ORDER BY project LIMIT 10),
re AS (SELECT 'resource' AS kind, resource_id AS key, arg_max(risk, (ts, prediction_id)) AS risk FROM pr WHERE lower(resource_id) LIKE '%1%' OR lower(provider) LIKE '%1%' OR lower(category) LIKE '%1%' OR lower(location) LIKE '%1%' GROUP BY resource_id ORDER BY 3 DESC, 2 LIMIT 50)
SELECT * FROM pj UNION ALL SELECT * FROM re""")
def unified_search(spark, d):
    rows = predictions(spark, d)
    return explain.find(rows.select("project").distinct(), rows, "1")


@query(f"""WITH {PRED_SQL}, k AS (SELECT risk, is_anomalous AND severity <> 'INFO' AS hit, value > 50 AS label FROM pr), rk AS (SELECT *, rank() OVER (ORDER BY risk) + (count(*) OVER (PARTITION BY risk) - 1) / 2 AS place FROM k),
n AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (hit AND label) AS tp, count(*) FILTER (hit AND NOT label) AS fp, count(*) FILTER (NOT hit AND label) AS fn, count(*) FILTER (NOT hit AND NOT label) AS tn, sum(place) FILTER (label) AS places FROM rk)
SELECT n, {r6('(tp + tn) / n')} AS accuracy, {r6('greatest(tp + fn, tn + fp) / n')} AS majority, {r6('tp / greatest(1, tp + fp)')} AS precision, {r6('tp / greatest(1, tp + fn)')} AS recall, {r6('CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END')} AS f1,
 {r6('(places - (tp + fn) * (tp + fn + 1) / 2) / ((tp + fn) * (tn + fp))')} AS auc FROM n""")
def risk_measures(spark, d):
    """A-21 for the rule-based risk; whether a value is above 50 stands for the outcome."""
    hit = F.col("is_anomalous") & (F.col("severity") != "INFO")
    scored = predictions(spark, d).select(F.col("risk"), hit.cast("double").alias("prediction"), (F.col("value") > 50).cast("double").alias("label"))
    got = risk_models.classifier_metrics(scored).withColumn("auc", F.lit(risk_models.area_under_roc(scored, "risk")))
    return got.select("n", *[C.r(F.col(c)).alias(c) for c in ("accuracy", "majority", "precision", "recall", "f1", "auc")])


@query()
def project_digest(spark, d):
    """L-3: one text per project of all its chunks' texts."""
    from fleetlens.plans.decision_queries import project_summaries

    return serve.reduce_summaries(project_summaries(spark, d))
