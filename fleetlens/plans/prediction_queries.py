"""Registered queries of whole predictions: versions, the assembly as of each resource's last report, and all of it live."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import prediction
from fleetlens.plans.base_queries import r6
from fleetlens.plans.predict_queries import MM_SQL, metrics, order
from fleetlens.plans.registration import query

#: A reading in seventeen is a maximum, so that some series mix statistics.
STAT_SQL = "CASE WHEN sample_count % 17 = 0 THEN 'maximum' ELSE 'average' END"
MINUTES, HOURS = 600, 690


def readings(spark, d):
    """Readings under their registry feature, with the statistic they are."""
    stat = F.when(F.col("sample_count") % 17 == 0, "maximum").otherwise("average")
    return metrics(spark, d).drop("feature").withColumnRenamed("metric", "feature").withColumn("stat", stat)


def models(rows):
    """A model of each category for each week in which it was trained, from the next week on."""
    week = F.date_trunc("week", "ts").cast("timestamp_ntz")
    return rows.select("category", week.alias("week")).distinct().select("category", (F.col("week") + F.expr("INTERVAL 7 DAY")).alias("valid_from"), F.concat_ws("-", F.lower("category"), F.date_format("week", "yyyyMMdd")).alias("model_version"))


RD_SQL = f"{MM_SQL}, rd AS (SELECT * EXCLUDE (feature, metric), metric AS feature, {STAT_SQL} AS stat FROM mm)"
POOL_SQL = "rtype, category, feature"
PROFILE_SQL = f"""{RD_SQL}, pd AS (SELECT {POOL_SQL}, date_trunc('day', ts)::TIMESTAMP AS day, count(value) AS n, sum(value) AS s, sum(value * value) AS q FROM rd GROUP BY ALL),
pw AS (SELECT {POOL_SQL}, day, min(day) OVER w AS first, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q, sum(n) OVER r AS near_n, sum(s) OVER r AS near_s FROM pd
 WINDOW w AS (PARTITION BY {POOL_SQL} ORDER BY day ROWS UNBOUNDED PRECEDING), r AS (PARTITION BY {POOL_SQL} ORDER BY day RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW)),
px AS (SELECT *, s / n AS mean, sqrt(greatest(0.0, q / n - (s / n) * (s / n))) AS sd FROM pw),
pv AS (SELECT {POOL_SQL}, day + INTERVAL 1 DAY AS valid_from, n::BIGINT AS n, mean, sd, date_diff('day', first, day) + 1 >= 17 AND sd > 0 AND near_n >= 3 AND abs(near_s / near_n - mean) > 2.5 * sd AS shifted FROM px WHERE n >= 5)"""
S = f"resource_id, {POOL_SQL}"
PRIOR_SQL = f"""sx AS (SELECT *, (epoch_us(ts) - epoch_us((SELECT date_trunc('week', min(ts))::TIMESTAMP FROM rd))) / 1e6 / 3600 AS x, date_trunc('week', ts)::TIMESTAMP AS week FROM rd),
so AS (SELECT {S}, week, count(value) AS n, sum(x) AS sx, sum(value) AS sy, sum(x * value) AS sxy, sum(x * x) AS sxx, min(x) AS x0, max(x) AS x1, min(value) AS y0, max(value) AS y1 FROM sx GROUP BY ALL),
sg AS (SELECT {S}, unnest(generate_series(min(week), (SELECT max(week) FROM so), INTERVAL 7 DAY)) AS week FROM so GROUP BY {S}),
sr AS (SELECT {S}, week, sum(n) OVER w AS n, sum(sx) OVER w AS sx, sum(sy) OVER w AS sy, sum(sxy) OVER w AS sxy, sum(sxx) OVER w AS sxx, min(x0) OVER w AS x0, max(x1) OVER w AS x1, min(y0) OVER w AS y0, max(y1) OVER w AS y1
 FROM sg LEFT JOIN so USING ({S}, week) WINDOW w AS (PARTITION BY {S} ORDER BY week ROWS UNBOUNDED PRECEDING)),
sp AS (SELECT {POOL_SQL}, week + INTERVAL 7 DAY AS valid_from, median(CASE WHEN y1 - y0 < 1e-9 OR x1 - x0 < 1e-9 THEN 0.0 ELSE (n * sxy - sx * sy) / (n * sxx - sx * sx) / (y1 - y0) END) AS prior, count(*) AS pool FROM sr WHERE n >= 5 GROUP BY ALL)"""


@query(f"WITH {PROFILE_SQL} SELECT {POOL_SQL}, valid_from, n, {r6('mean')} AS mean, round(sd + 3.7e-8, 4) AS sd, shifted FROM pv")
def profile_versions(spark, d):
    return prediction.profile_versions(readings(spark, d)).select("rtype", "category", "feature", "valid_from", "n", C.r(F.col("mean")).alias("mean"), C.r(F.col("sd"), 4).alias("sd"), "shifted")


@query(f"WITH {RD_SQL}, {PRIOR_SQL} SELECT {POOL_SQL}, valid_from, pool, {r6('prior')} AS prior FROM sp")
def prior_versions(spark, d):
    return prediction.prior_versions(readings(spark, d)).select("rtype", "category", "feature", "valid_from", "pool", C.r(F.col("prior")).alias("prior"))


def sizes_sql() -> str:
    return " ".join(f"WHEN '{c}' THEN {len(f)}" for c, f in order().items())


KNOWN_SQL = f"""{PROFILE_SQL}, {PRIOR_SQL}, mv AS (SELECT DISTINCT category, date_trunc('week', ts)::TIMESTAMP + INTERVAL 7 DAY AS valid_from, lower(category) || '-' || strftime(date_trunc('week', ts), '%Y%m%d') AS model_version FROM rd),
st AS (SELECT {S}, count(*) AS n, min(ts) AS f, max(ts) AS l, arg_max(value, (ts, event_id)) AS value, arg_max(vmax, (ts, event_id)) AS vmax, count(DISTINCT stat) > 1 AS mixed FROM rd GROUP BY ALL),
ss AS (SELECT *, max(l) OVER w AS seen, min(f) OVER w AS first_seen, sum(n) OVER w AS points, count(*) OVER w AS features FROM st WINDOW w AS (PARTITION BY resource_id, category)),
ao AS (SELECT ss.*, pv.n AS profile_n, pv.mean AS profile_mean, pv.sd AS profile_sd, coalesce(pv.shifted, false) AS shifted FROM ss ASOF LEFT JOIN pv ON ss.rtype = pv.rtype AND ss.category = pv.category AND ss.feature = pv.feature AND ss.seen >= pv.valid_from),
ap AS (SELECT ao.*, sp.prior, sp.pool FROM ao ASOF LEFT JOIN sp ON ao.rtype = sp.rtype AND ao.category = sp.category AND ao.feature = sp.feature AND ao.seen >= sp.valid_from),
am AS (SELECT ap.*, coalesce(mv.model_version, 'unsupervised-' || lower(ap.category)) AS model_version FROM ap ASOF LEFT JOIN mv ON ap.category = mv.category AND ap.seen >= mv.valid_from),
sc AS (SELECT *, CASE WHEN points >= 12 THEN least(1.0, coalesce(max(CASE WHEN profile_sd > 0 THEN abs(value - profile_mean) / profile_sd END) OVER w, 0.0) / 3.42) ELSE 0.0 END AS z,
 least(1.0, (least(50.0, greatest(1.0, coalesce(max(CASE WHEN value <> 0 THEN vmax / value END) OVER w, 1.0))) - 1) / 4) AS b FROM am WINDOW w AS (PARTITION BY resource_id, category)),
ga AS (SELECT *, least(1.0, 0.695 * z + 0.305 * b) AS s0, z > 0.5 OR b > 0.6 AS dominant, round_even((epoch_us((SELECT max(ts) FROM rd)) - epoch_us(seen)) / 1e6 / 3600 * 60, 1) AS age, round_even(features / CASE category {sizes_sql()} END, 3) AS completeness,
 CASE WHEN points < 2 THEN 0.0 ELSE round((epoch_us(seen) - epoch_us(first_seen)) / 1e6 / 3600 + 3.7e-8, 2) END AS hours FROM sc),
gb AS (SELECT *, CASE WHEN completeness = 0 THEN 'no_telemetry' WHEN age > {MINUTES} THEN 'stale' WHEN hours < {HOURS} THEN 'thin' ELSE 'normal' END AS gate FROM ga),
gc AS (SELECT *, CASE WHEN gate IN ('no_telemetry', 'stale') THEN 0.0 ELSE s0 END AS score, CASE WHEN gate IN ('no_telemetry', 'stale') THEN 0.0 ELSE round(100 * s0 + 3.7e-8, 2) END AS risk,
 CASE WHEN age > {MINUTES} THEN 'stale_resource_' || CAST(round_even(age, 0) AS BIGINT) || 'min' WHEN hours < {HOURS} THEN 'insufficient_history_' || printf('%.1f', round(hours + 3.7e-8, 1)) || 'h' END AS note FROM gb),
gd AS (SELECT *, CASE WHEN gate <> 'normal' THEN 'INFO' WHEN risk >= 90 THEN 'CRITICAL' WHEN risk >= 75 THEN 'HIGH' WHEN risk >= 50 THEN 'WARNING' ELSE 'INFO' END AS severity,
 gate = 'normal' AND (score >= 0.6 OR dominant) AS is_anomalous, gate = 'normal' AND (risk >= 40 OR dominant) AS trigger FROM gc)"""
LOOKED_UP = ["profile_n", "pool", "shifted", "mixed", "model_version"]
FEW = "n < 5"


def assembled(spark, d):
    rows = readings(spark, d)
    return prediction.predictions(rows, prediction.profile_versions(rows), prediction.prior_versions(rows), models(rows), order(), rows.agg(F.max("ts").alias("now")), ("canonical_dns_queries", "canonical_db_connections"), MINUTES, HOURS)


@query(f"""WITH {KNOWN_SQL} SELECT resource_id, category, feature, gate, note AS data_quality_note, hours, completeness, {', '.join(LOOKED_UP)}, {r6('profile_mean')} AS profile_mean, {r6('prior')} AS prior, {r6('z')} AS z_signal, {r6('b')} AS burst_signal, risk, severity, is_anomalous, trigger FROM gd""")
def known_predictions(spark, d):
    """D-1, J-4, J-11 without forecasts."""
    rows = readings(spark, d)
    x = prediction.known(rows, prediction.profile_versions(rows), prediction.prior_versions(rows), models(rows), order(), rows.agg(F.max("ts").alias("now")), MINUTES, HOURS)
    return x.select("resource_id", "category", "feature", "gate", "data_quality_note", "hours", "completeness", *LOOKED_UP, *[C.r(F.col(c)).alias(c) for c in ("profile_mean", "prior", "z_signal", "burst_signal")], "risk", "severity", "is_anomalous", "trigger")


@query(f"""WITH {KNOWN_SQL}, wv AS (SELECT resource_id, category, max(CASE WHEN feature = 'canonical_mem_used_pct' THEN value END) AS mem, max(CASE WHEN feature = 'status_check_failed' THEN value END) AS chk, max(CASE WHEN feature = 'canonical_subnet_util_pct' THEN value END) AS sub, max(CASE WHEN feature = 'canonical_ddos_signal' THEN value END) AS dds, max(CASE WHEN feature = 'canonical_burst_balance_pct' THEN value END) AS bst,
 count(CASE WHEN category = 'Container' AND feature IN ('canonical_node_cpu_pct', 'canonical_node_mem_pct', 'canonical_unschedulable_pods', 'canonical_api_inflight_requests') OR category = 'Databases' AND feature IN ('canonical_db_cpu_pct', 'canonical_db_storage_pct', 'canonical_db_connections') OR category = 'Network' AND feature = 'canonical_health_pct' OR category = 'Storage' AND feature = 'availability_pct' THEN 1 END) AS shown FROM st GROUP BY ALL),
sy AS (SELECT {S}, max(value) - min(value) AS ptp FROM rd GROUP BY ALL), fx AS (SELECT gd.*, wv.* EXCLUDE (resource_id, category), sy.ptp, CASE WHEN n > 1 THEN ptp ELSE abs(value) * 0.1 END AS spread FROM gd JOIN wv USING (resource_id, category) JOIN sy USING ({S}))
SELECT resource_id, category, feature, gate, severity, n, mixed, CASE WHEN {FEW} THEN CASE WHEN prior IS NULL THEN 'none' ELSE 'pooled_type_prior' END END AS method_of_few,
 CASE WHEN {FEW} THEN round(value + coalesce(prior, 0) * (CASE WHEN spread <> 0 THEN spread WHEN value <> 0 THEN abs(value) * 0.1 ELSE 1.0 END) * 24 * (prior IS NOT NULL)::INT, 3) END AS f_24h_of_few,
 concat_ws(',', CASE WHEN category = 'Compute' AND mem >= 85 THEN 'MEMORY_PRESSURE/memory_used_percent' END, CASE WHEN category = 'Compute' AND chk >= 1 THEN 'INSTANCE_HEALTH_CHECK_FAILURE/StatusCheckFailed' END, CASE WHEN category = 'Network' AND sub >= 80 THEN 'SUBNET_CAPACITY_RISK/subnet_utilization_percent' END,
  CASE WHEN category = 'Network' AND dds >= 1 THEN 'DDOS_SIGNAL_DETECTED/ddos_signal' END, CASE WHEN category = 'Storage' AND bst < 20 THEN 'BURST_CREDIT_EXHAUSTION/burst_balance_percent' END) AS present_failures,
 CASE WHEN gate = 'stale' THEN 'verify_reporting' WHEN gate = 'thin' THEN 'await_history' WHEN gate = 'no_telemetry' THEN 'verify_agent' END AS gate_advice, gate = 'normal' AND shifted AS told_of_shift, shown, category || '/' || coalesce(CASE WHEN category = 'Compute' AND mem IS NOT NULL THEN CASE WHEN mem >= 90 THEN 'CRITICAL' WHEN mem >= 75 THEN 'WARNING' ELSE 'OK' END END, '-') AS memory FROM fx""")
def whole_predictions(spark, d):
    """D-1 with the live forecast: what SQL can say of it. Forecasts of series below five points follow the prior."""
    x = assembled(spark, d)
    few = F.col("n") < 5
    present = F.transform(F.filter("failures", lambda f: f.span == "current"), lambda f: F.concat_ws("/", f.failure, f.metric))
    return x.select(
        "resource_id", "category", "feature", "gate", "severity", "n", "mixed", F.when(few, F.col("method")).alias("method_of_few"), F.when(few, F.col("f_24h")).alias("f_24h_of_few"), F.array_join(present, ",").alias("present_failures"),
        F.when(F.col("gate") != "normal", F.array_join("advice", ",")).alias("gate_advice"), F.array_contains("advice", "review_baseline_shift").alias("told_of_shift"), F.size("payload").cast("long").alias("shown"), F.concat_ws("/", "category", F.coalesce(F.col("derived")["memory_class"], F.lit("-"))).alias("memory"),
    )


@query()
def live_predictions(spark, d):
    """D-1 whole: the forecast's method, horizons, back-test, failures and advice of each metric."""
    x = assembled(spark, d)
    return x.select("resource_id", "category", "feature", "gate", "risk", "method", "trend", "reliability", "tier", "note", "mixed", "f_1h", "f_24h", "f_7d", "backtest_quality", "confidence", F.to_json("failures").alias("failures"), F.array_join("advice", ",").alias("advice"), "prediction_type", "summary", "model_version")
