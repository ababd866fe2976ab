"""Registered queries: series mathematics, forecasts and predictions."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import anomaly, forecast, profiles, risk_models, stretches
from fleetlens.plans.base_queries import P_SQL, SCORE_SQL, SLOPE_SQL, r6, typed
from fleetlens.plans.registration import query

KEYS = forecast.KEYS
KEY_SQL = "resource_id, category, feature"
OVER = f"(PARTITION BY {KEY_SQL} ORDER BY ts, event_id)"
BACK = f"(PARTITION BY {KEY_SQL} ORDER BY ts DESC, event_id DESC)"
X_SQL = f"{P_SQL}, x AS (SELECT *, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY {KEY_SQL}))) / 1e6 / 3600 AS x, row_number() OVER {BACK} AS back, row_number() OVER {OVER} AS k, count(*) OVER (PARTITION BY {KEY_SQL}) AS n FROM p)"
OLS_SQL = f"{X_SQL}, o AS (SELECT {KEY_SQL}, count(value) AS n, CASE WHEN count(value) < 2 OR max(x) - min(x) < 1e-9 THEN 0.0 ELSE regr_slope(value, x) END AS slope, CASE WHEN count(value) < 2 OR max(x) - min(x) < 1e-9 THEN avg(value) ELSE regr_intercept(value, x) END AS intercept FROM x GROUP BY ALL)"


@query(f"WITH {OLS_SQL} SELECT {KEY_SQL}, n, {r6('slope')} AS slope, {r6('intercept')} AS intercept FROM o")
def ols_slope(spark, d):
    return forecast.ols(typed(spark, d)).select(*KEYS, "n", C.r(F.col("slope")).alias("slope"), C.r(F.col("intercept")).alias("intercept"))


@query(f"WITH {P_SQL}, l AS (SELECT {KEY_SQL}, list(value ORDER BY ts, event_id) AS v FROM p GROUP BY ALL) SELECT {KEY_SQL}, {r6('list_reduce(v, lambda a, b: 0.3 * b + 0.7 * a)')} AS level FROM l")
def exp_smoothing(spark, d):
    return stretches.level(typed(spark, d)).withColumn("level", C.r(F.col("level")))


@query(f"WITH {P_SQL} SELECT {KEY_SQL}, arg_max(value, (ts, event_id)) AS last FROM p GROUP BY ALL")
def naive_last(spark, d):
    return forecast.naive_last(typed(spark, d))


@query(f"WITH {X_SQL} SELECT {KEY_SQL}, {r6('avg(value)')} AS level FROM x WHERE back <= least(7, greatest(3, n // 2)) GROUP BY ALL")
def moving_average(spark, d):
    return forecast.moving_average(typed(spark, d)).withColumn("level", C.r(F.col("level")))


@query(f"""WITH {X_SQL}, b AS (SELECT {KEY_SQL}, round_even(x, 0)::BIGINT % 24 AS phase, median(value) AS m, quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi FROM x GROUP BY ALL HAVING count(*) >= 2),
w AS (SELECT {KEY_SQL}, median(value) AS mid, max(x) AS last FROM x GROUP BY ALL), h AS (SELECT w.*, unnest([1, 6, 24]) AS hours FROM w)
SELECT h.resource_id, h.category, h.feature, hours, {r6('coalesce(m, mid)')} AS point, {r6('coalesce(lo, mid)')} AS lower, {r6('coalesce(hi, mid)')} AS upper
FROM h LEFT JOIN b ON h.resource_id = b.resource_id AND h.category = b.category AND h.feature = b.feature AND round_even(last + hours, 0)::BIGINT % 24 = b.phase""")
def seasonal_phase(spark, d):
    out = forecast.seasonal_phase(typed(spark, d), [1, 6, 24])
    return out.select(*KEYS, "hours", *[C.r(F.col(c)).alias(c) for c in ("point", "lower", "upper")])


@query(f"""WITH {P_SQL}, s AS (SELECT *, abs(value - lag(value) OVER {OVER}) AS step FROM p), a AS (SELECT {KEY_SQL}, avg(step) AS raw, avg(abs(value)) AS size FROM s GROUP BY ALL)
SELECT {KEY_SQL}, {r6('CASE WHEN size <= 1e-9 THEN CASE WHEN raw > 1e-9 THEN raw END ELSE greatest(raw, 0.01 * size) END')} AS scale, size > 1e-9 AND raw < 0.01 * size AS floored FROM a WHERE raw IS NOT NULL""")
def mase_scale(spark, d):
    return forecast.mase_scale(typed(spark, d)).withColumn("scale", C.r(F.col("scale")))


@query(f"""WITH {X_SQL}, a AS (SELECT {KEY_SQL}, max(n) AS n, median(value) FILTER (k <= n // 2) AS a, median(value) FILTER (k > n // 2) AS b FROM x GROUP BY ALL)
SELECT {KEY_SQL}, CASE WHEN n < 8 THEN 'stable' WHEN (b - a) / greatest(abs(a), 1e-6) > 0.2 THEN 'increasing' WHEN (b - a) / greatest(abs(a), 1e-6) < -0.2 THEN 'decreasing' ELSE 'stable' END AS trend FROM a""")
def drift_halves(spark, d):
    return forecast.drift_halves(typed(spark, d))


@query(f"WITH {X_SQL} SELECT event_id, resource_id, feature, (n - least(14, greatest(3, round_even(n * 0.2, 0)::INT)) >= 8) AND back <= least(14, greatest(3, round_even(n * 0.2, 0)::INT)) AS held_out FROM x")
def holdout_split(spark, d):
    return forecast.holdout_split(typed(spark, d)).select("event_id", "resource_id", "feature", "held_out")


@query(f"WITH {P_SQL} SELECT event_id, resource_id, row_number() OVER (PARTITION BY resource_id ORDER BY ts, event_id) <= greatest(1, floor(0.8 * count(*) OVER (PARTITION BY resource_id))) AS train FROM p")
def time_split(spark, d):
    return forecast.time_split(typed(spark, d)).select("event_id", "resource_id", "train")


@query(f"""WITH {OLS_SQL}, la AS (SELECT {KEY_SQL}, arg_max(value, (ts, event_id)) AS last FROM p GROUP BY ALL)
SELECT {KEY_SQL}, last, {r6('slope')} AS slope, {r6('CASE WHEN last >= 150 THEN 0.0 WHEN slope > 0 AND (150 - last) / slope <= 87600 THEN (150 - last) / slope END')} AS hours FROM o JOIN la USING ({KEY_SQL}) WHERE n >= 2""")
def breach_eta(spark, d):
    return forecast.breach_eta(typed(spark, d), 150.0).select(*KEYS, "last", C.r(F.col("slope")).alias("slope"), C.r(F.col("hours")).alias("hours"))


@query(f"""WITH {SLOPE_SQL}, pr AS (SELECT rtype, category, feature, median(norm_slope) AS prior FROM sl WHERE n >= 5 GROUP BY ALL),
s AS (SELECT resource_id, rtype, category, feature, count(value) AS n, CASE WHEN max(x) - min(x) < 1e-9 THEN 0.0 ELSE regr_slope(value, x) END AS slope, max(value) - min(value) AS rng FROM x GROUP BY ALL HAVING count(value) >= 5)
SELECT resource_id, category, feature, n, {r6('CASE WHEN prior IS NOT NULL AND n < 20 THEN n / (n + 15) * slope + (1 - n / (n + 15)) * prior * rng ELSE slope END')} AS shrunk,
 CASE WHEN prior IS NULL OR n >= 20 THEN 'individual' WHEN starts_with(rtype, 'other_') THEN 'category_pooled' ELSE 'type_pooled' END AS tier FROM s LEFT JOIN pr USING (rtype, category, feature)""")
def shrinkage(spark, d):
    rows = typed(spark, d)
    slopes = profiles.series_slopes(rows).withColumn("slope", F.when(F.col("x_range") < 1e-9, 0.0).otherwise(F.col("slope")))
    return forecast.shrunk(slopes, profiles.slope_priors(rows).drop("pool"), profiles.POOL).select(*KEYS, "n", C.r(F.col("shrunk")).alias("shrunk"), "tier")


PROXY_SQL = f"""{X_SQL}, f AS (SELECT {KEY_SQL}, count(*) AS c, regr_slope(value, (k - 1)::DOUBLE) AS s, regr_intercept(value, (k - 1)::DOUBLE) AS i, greatest(avg(abs(value)), 1.0) AS size FROM x GROUP BY ALL HAVING count(*) >= 5),
e AS (SELECT x.resource_id, x.category, x.feature, size, value - s * (k - 1) - i AS e FROM x JOIN f ON x.resource_id = f.resource_id AND x.category = f.category AND x.feature = f.feature),
px AS (SELECT {KEY_SQL}, avg(abs(e)) / any_value(size) AS mae, sqrt(avg(e * e)) / any_value(size) AS rmse FROM e GROUP BY ALL)"""


@query(f"WITH {PROXY_SQL} SELECT {KEY_SQL}, {r6('mae')} AS mae, {r6('rmse')} AS rmse, {r6('least(1000.0, mae * 100)')} AS mape FROM px")
def error_proxies(spark, d):
    out = forecast.error_proxies(typed(spark, d))
    return out.select(*KEYS, *[C.r(F.col(c)).alias(c) for c in ("mae", "rmse", "mape")])


@query(f"""WITH {PROXY_SQL}, q AS (SELECT {KEY_SQL}, regr_r2(value, x) AS r2 FROM x GROUP BY ALL)
SELECT {KEY_SQL}, {r6("least(100.0, greatest(0.0, 45 * coalesce(r2, 0) + 25 * CASE WHEN r2 >= 0.65 THEN 0.9 WHEN r2 >= 0.25 THEN 0.6 ELSE 0.3 END + 15 * 0.85 + 0.15 * coalesce((greatest(0.0, 100 - least(100.0, mae * 100)) + greatest(0.0, 100 - least(100.0, rmse * 100)) + greatest(0.0, 100 - least(100.0, least(1000.0, mae * 100)))) / 3, 50)))")} AS confidence FROM px JOIN q USING ({KEY_SQL})""")
def confidence_score(spark, d):
    rows = typed(spark, d)
    r2 = forecast.with_hours(rows).groupBy(*KEYS).agg(F.regr_r2("value", "x").alias("r2"))
    reliability = F.when(F.col("r2") >= 0.65, "high").when(F.col("r2") >= 0.25, "moderate").otherwise("low")
    x = forecast.error_proxies(rows).join(r2, KEYS)
    return x.select(*KEYS, C.r(forecast.confidence(F.coalesce("r2", F.lit(0.0)), reliability, F.lit("linear_regression_bootstrap"), F.col("mae"), F.col("rmse"), F.col("mape"))).alias("confidence"))


@query()
def candidate_forecasts(spark, d):
    return forecast.candidates(typed(spark, d), list(forecast.S.CANDIDATES), [1, 24, 168])


@query()
def structural_breaks(spark, d):
    """One series per resource: all its readings in time order."""
    rows = typed(spark, d).withColumn("feature", F.lit("all"))
    return forecast.breaks(rows)


@query()
def behavioral_forecast(spark, d):
    rows = typed(spark, d)
    return forecast.forecasts(rows, profiles.slope_priors(rows), ("click", "view"))


@query()
def holdout_backtest(spark, d):
    rows = typed(spark, d).withColumn("feature", F.lit("all"))
    out = forecast.forecasts(rows, profiles.slope_priors(rows), ("all",))
    return out.select(*KEYS, "n", "method", *[c for c in out.columns if c.startswith("backtest")], "trimmed", "confidence")


def predictions(spark, d):
    """D-1: one prediction per series: its newest reading, score, forecast-free labels, context."""
    from fleetlens.operators import decisions, ingest

    rows = typed(spark, d)
    newest = ingest.latest_rows(rows, KEYS)
    scores = anomaly.scored(rows).select("resource_id", "category", "ts", "score", "dominant", "z_signal", "burst_signal")
    joined = newest.join(scores, ["resource_id", "category", "ts"])
    keyed = joined.withColumn("prediction_id", C.hash_key(F.col("resource_id"), F.col("feature"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return decisions.alert_gate(keyed)


PRED_SQL = f"""{SCORE_SQL}, nw AS (SELECT * FROM p QUALIFY row_number() OVER {BACK} = 1),
pd0 AS (SELECT nw.*, z_signal, burst_signal, round(100 * score + 3.7e-8, 2) AS risk, score, dominant FROM nw JOIN sc ON nw.resource_id = sc.resource_id AND nw.category = sc.category AND nw.ts = sc.ts),
pr AS (SELECT *, score >= 0.6 OR dominant AS is_anomalous, CASE WHEN risk >= 90 THEN 'CRITICAL' WHEN risk >= 75 THEN 'HIGH' WHEN risk >= 50 THEN 'WARNING' ELSE 'INFO' END AS severity,
 CASE WHEN risk >= 75 THEN 'red' WHEN risk >= 50 THEN 'amber' WHEN risk >= 25 THEN 'blue' ELSE 'green' END AS badge, substr(sha256(resource_id || '::' || feature || '::' || strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 24) AS prediction_id FROM pd0)"""


@query(f"WITH {PRED_SQL} SELECT prediction_id, resource_id, category, feature, provider, location, project, ts, value, risk, is_anomalous, severity, badge, (risk >= 40 OR dominant) AND severity <> 'INFO' AS trigger, CASE severity WHEN 'CRITICAL' THEN 'pagerduty' WHEN 'HIGH' THEN 'pagerduty' WHEN 'WARNING' THEN 'slack' ELSE 'suppressed' END AS channel FROM pr")
def scored_predictions(spark, d):
    return predictions(spark, d).select("prediction_id", *KEYS, "provider", "location", "project", "ts", "value", "risk", "is_anomalous", "severity", "badge", "trigger", "channel")


@query()
def risk_classifier(spark, d):
    """M-3: trained on the first 80 percent of each resource's rows, its probabilities over the others."""
    rows = forecast.time_split(anomaly.residuals(typed(spark, d))).withColumn("label", C.is_true(F.col("residual") > 2 * F.col("sd")).cast("int"))
    model = risk_models.train_classifier(rows.where("train"), ["vmax", "sample_count"], ["category", "feature"])
    test = rows.where("not train")
    out = risk_models.risk(model, test) if model else test.withColumn("model_risk", F.lit(None).cast("double"))
    return out.select("event_id", "resource_id", "feature", "label", F.round("model_risk", 4).alias("model_risk"))


@query()
def learned_slope_prior(spark, d):
    table = profiles.slope_training_table(typed(spark, d), 5)
    model = risk_models.train_slope_prior(table)
    out = model.transform(table.withColumn("n", F.col("n").cast("double"))) if model else table.withColumn("prediction", F.lit(None).cast("double"))
    return out.select(*KEYS, "norm_slope", F.round("prediction", 6).alias("prediction"))
