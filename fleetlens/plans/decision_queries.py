"""Registered queries: decisions, thresholds, feedback, accuracy, serving, sinks and streaming."""


from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import vocabulary as V
from fleetlens.operators import anomaly, decisions, ingest, predict, quality, serve
from fleetlens.plans.base_queries import P_SQL, r6, sql_map, typed, values_sql
from fleetlens.plans.forecast_queries import KEY_SQL, KEYS, OVER, PRED_SQL, predictions
from fleetlens.plans.registration import query
from fleetlens.sources import adapters as A
from fleetlens.sources.catalog import Catalog
from fleetlens.sources.shared import new_path
from fleetlens.streaming import jobs

ALL_SQL = PRED_SQL.replace("nw AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY resource_id, category, feature ORDER BY ts DESC, event_id DESC) = 1)", "nw AS (SELECT * FROM p)")


def scored_rows(spark, d):
    """Every reading with its score and labels, the history that feedback and incidents look at."""
    rows = typed(spark, d)
    scores = anomaly.scored(rows).select("resource_id", "category", "ts", "score", "dominant", "z_signal", "burst_signal")
    keyed = rows.join(scores, ["resource_id", "category", "ts"]).withColumn("prediction_id", C.hash_key(F.col("resource_id"), F.col("feature"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return decisions.alert_gate(keyed)


#: Readings stand for registry features so that rule tables have something to say.
STAND_IN = {
    ("Compute", "click"): "canonical_cpu_pct", ("Compute", "view"): "canonical_mem_used_pct", ("Network", "click"): "canonical_subnet_util_pct", ("Network", "view"): "canonical_health_pct",
    ("Storage", "click"): "canonical_storage_used_pct", ("Storage", "view"): "canonical_burst_balance_pct", ("Container", "click"): "canonical_node_cpu_pct", ("Databases", "click"): "canonical_db_cpu_pct", ("Databases", "view"): "canonical_db_storage_pct",
}
STAND_SQL = "coalesce(CASE category || '/' || feature " + " ".join(f"WHEN '{c}/{f}' THEN '{x}'" for (c, f), x in STAND_IN.items()) + " END, feature)"


def stand_in():
    return F.coalesce(C.literal_map({f"{c}/{f}": x for (c, f), x in STAND_IN.items()})[F.concat("category", F.lit("/"), "feature")], F.col("feature"))


def newest(spark, d):
    return ingest.latest_rows(typed(spark, d), KEYS).withColumn("metric", stand_in())


NEW_SQL = f"{P_SQL}, nw AS (SELECT *, {STAND_SQL} AS metric FROM p QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY ts DESC, event_id DESC) = 1)"


def fired_sql(rules, quote=True):
    tests = [f"CASE WHEN category = '{c}' AND metric = '{f}' AND value {op} {limit} THEN {chr(39) + str(w) + chr(39) if quote else w} END" for c, f, op, limit, w in rules]
    return tests


@query(f"""WITH {NEW_SQL} SELECT resource_id, category, feature, value, concat_ws(',', CASE WHEN category = 'Compute' AND metric = 'canonical_cpu_pct' AND value >= 80 THEN 'CPU_80_PERCENT_BREACH' END,
 CASE WHEN category = 'Compute' AND metric = 'canonical_cpu_pct' AND value >= 90 THEN 'CPU_90_PERCENT_BREACH' END, CASE WHEN category = 'Compute' AND metric = 'canonical_mem_used_pct' AND value >= 85 THEN 'MEMORY_PRESSURE' END,
 CASE WHEN category = 'Compute' AND metric = 'status_check_failed' AND value >= 1 THEN 'INSTANCE_HEALTH_CHECK_FAILURE' END, CASE WHEN category = 'Network' AND metric = 'canonical_active_connections' AND value >= 10000 THEN 'CONNECTION_SATURATION' END,
 CASE WHEN category = 'Network' AND metric = 'canonical_subnet_util_pct' AND value >= 80 THEN 'SUBNET_CAPACITY_RISK' END, CASE WHEN category = 'Network' AND metric = 'canonical_ddos_signal' AND value >= 1 THEN 'DDOS_SIGNAL_DETECTED' END,
 CASE WHEN category = 'Storage' AND metric = 'canonical_storage_used_pct' AND value >= 80 THEN 'STORAGE_80_PERCENT_BREACH' END, CASE WHEN category = 'Storage' AND metric = 'canonical_storage_used_pct' AND value >= 90 THEN 'STORAGE_90_PERCENT_BREACH' END,
 CASE WHEN category = 'Storage' AND metric = 'canonical_burst_balance_pct' AND value < 20 THEN 'BURST_CREDIT_EXHAUSTION' END) AS failures FROM nw""")
def failure_rules(spark, d):
    """D-4 of a resource whose values stay as they are: the present value is its forecast."""
    x = newest(spark, d)
    got = predict.failures(F.col("category"), F.col("metric"), F.create_map("metric", "value"), F.col("value"), F.col("value"))
    return x.select(*KEYS, "value", F.array_join(F.transform(got, lambda f: f.failure), ",").alias("failures"))


_ADVISED = [
    ("Compute", "canonical_cpu_pct", ">= 80", "scale_up"), ("Compute", "canonical_cpu_pct", "< 25", "scale_down"), ("Compute", "canonical_mem_used_pct", ">= 85", "add_memory"), ("Compute", "cpu_credit_balance", "< 20", "leave_burstable"),
    ("Network", "canonical_ddos_signal", "> 0", "mitigate_ddos"), ("Network", "canonical_health_pct", "< 90", "repair_targets"), ("Network", "canonical_subnet_util_pct", ">= 80", "extend_subnet"),
    ("Storage", "canonical_storage_used_pct", ">= 80", "add_capacity"), ("Storage", "canonical_burst_balance_pct", "< 20", "provision_throughput"), ("Storage", "backup_health_event", "> 0", "check_backup"),
    ("Container", "canonical_node_cpu_pct", ">= 85", "add_nodes"), ("Container", "canonical_node_mem_pct", ">= 85", "add_node_memory"), ("Container", "canonical_unschedulable_pods", "> 0", "free_capacity"), ("Container", "canonical_api_inflight_requests", "> 400", "throttle_clients"),
    ("Databases", "canonical_db_cpu_pct", ">= 80", "tune_or_scale"), ("Databases", "canonical_db_storage_pct", ">= 85", "extend_storage"), ("Databases", "canonical_db_connections", ">= 90", "pool_connections"),
]
_ADVISED_SQL = ", ".join(f"CASE WHEN category = '{c}' AND metric = '{m}' AND value {test} THEN '{key}' END" for c, m, test, key in _ADVISED)


@query(f"WITH {NEW_SQL} SELECT resource_id, category, feature, value, concat_ws(',', {_ADVISED_SQL}) AS advice FROM nw")
def recommendation_flags(spark, d):
    """D-5 of a resource whose values stay as they are. The limits of the SQL are its own."""
    x, value = newest(spark, d), F.col("value")
    line = {"current": value, "trend": F.lit("stable"), "reliability": F.lit("low"), "f_24h": value, "f_7d": value}
    return x.select(*KEYS, "value", F.array_join(predict.advice(F.col("category"), F.col("metric"), F.create_map("metric", "value"), line, F.lit(0.0)), ",").alias("advice"))


@query(f"""WITH {NEW_SQL}, st AS (SELECT category, feature, avg(value) AS mean, stddev_samp(value) AS sd FROM p GROUP BY ALL),
l AS (SELECT nw.*, mean, sd, {' + '.join(f'coalesce({t}, 0)' for t in fired_sql(decisions.RISK_POINTS, False))} AS pts FROM nw JOIN st USING (category, feature)),
g AS (SELECT resource_id, category, sum(pts)::BIGINT AS points, bool_or(coalesce(sd > 0 AND (value - mean) / sd > 2.5, false)) AS outlier FROM l GROUP BY ALL)
SELECT *, (points >= 50 OR outlier)::INT AS label FROM g""")
def risk_labels(spark, d):
    stats = typed(spark, d).groupBy("category", "feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    rows = newest(spark, d).join(stats, ["category", "feature"]).withColumn("feature", F.col("metric"))
    return decisions.risk_labels(rows)


@query(f"WITH {PRED_SQL} SELECT category, count(*) AS n, {r6('avg(is_anomalous::INT)')} AS rate, avg(is_anomalous::INT) >= 0.4 AS drifted FROM pr GROUP BY 1")
def drift_trigger(spark, d):
    return quality.drift(predictions(spark, d))


@query(f"""WITH {PRED_SQL} SELECT prediction_id, concat_ws(',', CASE WHEN NOT (score BETWEEN 0 AND 0.9) THEN 'score_range' END, CASE WHEN NOT (risk BETWEEN 0 AND 100) THEN 'risk_range' END,
CASE WHEN severity NOT IN ('CRITICAL', 'HIGH', 'WARNING', 'INFO') THEN 'severity' END, CASE WHEN CASE WHEN value > 30 THEN project END IS NULL THEN 'missing_project' END) AS errors FROM pr""")
def validate_predictions(spark, d):
    p = predictions(spark, d)
    found = quality.errors_of_prediction(F.col("score") / 0.9, F.col("risk"), F.col("severity"), {"project": F.when(F.col("value") > 30, F.col("project"))})
    return p.select("prediction_id", F.array_join(found, ",").alias("errors"))


@query("WITH " + P_SQL + " SELECT event_id, substr(sha256(resource_id || '::' || feature || '::' || strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 24) AS key FROM p")
def idempotent_keys(spark, d):
    return typed(spark, d).select("event_id", C.hash_key(F.col("resource_id"), F.col("feature"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("key"))


WINDOWS = [(1, "*", "Network", "2024-01-10 00:00:00", "2024-01-12 00:00:00", "network upgrade"), (2, "r7", "*", "2024-01-01 00:00:00", "2024-02-01 00:00:00", "host move"), (3, "*", "*", "2024-01-20 06:00:00", "2024-01-20 18:00:00", "site work"), (4, "r11", "Compute", "2024-01-05 00:00:00", "2024-01-25 00:00:00", "patching")]


def maintenance(spark):
    w = spark.createDataFrame(WINDOWS, "window_id int, resource_id string, category string, s string, e string, reason string")
    return w.select("window_id", "resource_id", "category", F.col("s").cast("timestamp_ntz").alias("starts_at"), F.col("e").cast("timestamp_ntz").alias("ends_at"), "reason")


@query(f"""WITH {ALL_SQL}, w AS (SELECT window_id, w_resource, w_category, s::TIMESTAMP AS s, e::TIMESTAMP AS e, reason FROM {values_sql(WINDOWS)} AS v(window_id, w_resource, w_category, s, e, reason)),
h AS (SELECT prediction_id, arg_min(reason, window_id) AS reason FROM pr JOIN w ON (w_resource IN ('*', resource_id)) AND (w_category IN ('*', category)) AND ts BETWEEN s AND e GROUP BY 1)
SELECT prediction_id, resource_id, category, h.reason, h.reason IS NOT NULL AS suppressed, CASE WHEN h.reason IS NOT NULL THEN 'INFO' ELSE severity END AS severity, (risk >= 40 OR dominant) AND severity <> 'INFO' AND h.reason IS NULL AS trigger FROM pr LEFT JOIN h USING (prediction_id)""")
def maintenance_suppression(spark, d):
    return decisions.suppress(scored_rows(spark, d), maintenance(spark)).select("prediction_id", "resource_id", "category", "reason", "suppressed", "severity", "trigger")


@query(f"""WITH {PRED_SQL}, g AS (SELECT provider, location, category, count(DISTINCT resource_id) AS resources, count(DISTINCT CASE WHEN is_anomalous THEN resource_id END) AS anomalous, count(*) AS predictions, array_to_string(list_sort(list(DISTINCT CASE WHEN is_anomalous THEN resource_id END)), ',') AS ids FROM pr GROUP BY ALL)
SELECT provider, location, category, resources, anomalous, predictions, ids FROM g WHERE resources >= 5 AND anomalous / resources >= 0.3""")
def fleet_anomalies(spark, d):
    return decisions.fleet_anomalies(predictions(spark, d)).withColumn("ids", F.array_join("ids", ","))


CAUSE_SQL = "CASE " + " ".join(f"WHEN list_has_all(c, ['{a}', '{b}']) THEN '{a} with {b}'" for a, b in V.COMPOSITE_CAUSES) + " ELSE 'several domains at once' END"


@query(f"""WITH {PRED_SQL}, q AS (SELECT 'z' || (CAST(substr(project, 2) AS INT) // 2) AS scope, * FROM pr), g AS (SELECT scope, list_sort(list(DISTINCT category)) AS c, count(DISTINCT resource_id) AS resources, max(risk) AS risk FROM q WHERE is_anomalous GROUP BY 1)
SELECT scope, array_to_string(c, ',') AS categories, resources, risk, CASE WHEN risk >= 75 THEN 'CRITICAL' ELSE 'HIGH' END AS severity, {CAUSE_SQL} AS cause FROM g WHERE len(c) >= 2""")
def composite_incidents(spark, d):
    p = predictions(spark, d).withColumn("project", F.concat(F.lit("z"), F.floor(F.substring("project", 2, 9).cast("int") / 2).cast("string")))
    return decisions.composite_incidents(p).withColumn("categories", F.array_join("categories", ","))


# ---------------------------------------------------------------- thresholds

RULES = [("click", "gte", 150.0), ("view", "gt", 200.0), ("error", "lt", 5.0), ("purchase", "lte", 2.0)]


def rules(spark, d):
    """One rule per resource and metric: the four templates for every third resource."""
    ids = typed(spark, d).where("cast(substr(resource_id, 2) as int) % 3 = 0").select("resource_id").distinct()
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric_name"), F.lit(o).alias("operator"), F.lit(x).alias("limit")) for m, o, x in RULES]))
    return ids.select("resource_id", each.alias("r")).select("resource_id", "r.*")


def readings(spark, d):
    return typed(spark, d).select("resource_id", F.col("feature").alias("metric_name"), "ts", "value")


BREACH_SQL = f"""{P_SQL}, ru AS (SELECT * FROM {values_sql([(a, b, f'{c}') for a, b, c in RULES])} AS v(metric_name, operator, lim)),
br AS (SELECT resource_id, feature AS metric_name, ts, value, substr(sha256(resource_id || '::' || feature || '::' || strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 24) AS event_key FROM p JOIN ru ON feature = metric_name
 WHERE CAST(substr(resource_id, 2) AS INT) % 3 = 0 AND CASE operator WHEN 'gt' THEN value > lim::DOUBLE WHEN 'gte' THEN value >= lim::DOUBLE WHEN 'lt' THEN value < lim::DOUBLE ELSE value <= lim::DOUBLE END)"""


@query(f"WITH {BREACH_SQL} SELECT resource_id, metric_name, ts, value, event_key FROM br")
def breach_log(spark, d):
    return decisions.breaches(readings(spark, d), rules(spark, d)).select("resource_id", "metric_name", "ts", "value", "event_key")


@query(f"WITH {BREACH_SQL} SELECT resource_id, metric_name, count(DISTINCT event_key) AS breaches, max(ts) AS last_breach FROM br GROUP BY ALL")
def breach_state(spark, d):
    return decisions.breach_state(decisions.breaches(readings(spark, d), rules(spark, d)))


@query(f"WITH {BREACH_SQL} SELECT DISTINCT event_key, resource_id, metric_name FROM br WHERE ts > TIMESTAMP '2024-01-15'")
def breach_append(spark, d):
    log = decisions.breaches(readings(spark, d), rules(spark, d))
    return decisions.append_new(log.where("ts <= timestamp_ntz '2024-01-15 00:00:00'"), log).select("event_key", "resource_id", "metric_name")


@query(f"""WITH {P_SQL}, o AS (SELECT *, (row_number() OVER {OVER} - 1) AS hours FROM p), q AS (SELECT {KEY_SQL}, hours, value FROM o),
c AS (SELECT *, value >= 120 AS ov, lag(value) OVER w AS v1, lag(hours) OVER w AS h1, lag(value >= 120) OVER w AS b FROM q WINDOW w AS (PARTITION BY {KEY_SQL} ORDER BY hours))
SELECT {KEY_SQL}, {r6('min(CASE WHEN ov AND b IS NULL THEN 0.0 WHEN ov AND NOT b AND value <> v1 THEN h1 + greatest(0.0, least(1.0, (120 - v1) / (value - v1))) * (hours - h1) END)')} AS eta_hours FROM c GROUP BY ALL""")
def next_breach(spark, d):
    from pyspark.sql import Window

    rows = typed(spark, d).withColumn("hours", (F.row_number().over(Window.partitionBy(*KEYS).orderBy("ts", "event_id")) - 1).cast("double"))
    points = rows.select(*KEYS, "hours", "value", F.lit("gte").alias("operator"), F.lit(120.0).alias("limit"))
    return decisions.next_breach(points, KEYS).withColumn("eta_hours", C.r(F.col("eta_hours")))


# ---------------------------------------------------------------- feedback

FEED_SQL = f"""{P_SQL}, inc AS (SELECT resource_id, ts AS opened_at FROM p WHERE feature = 'error' AND value > 100), cand AS (SELECT event_id AS prediction_id, resource_id, category, ts FROM p WHERE feature = 'view'),
f AS (SELECT prediction_id, min(opened_at) AS outcome_at FROM cand JOIN inc ON cand.resource_id = inc.resource_id AND opened_at BETWEEN ts AND ts + INTERVAL 6 HOUR GROUP BY 1),
fb AS (SELECT cand.*, outcome_at, CASE WHEN outcome_at IS NOT NULL THEN 'TP' WHEN (epoch_us((SELECT max(ts) FROM p)) - epoch_us(ts)) / 1e6 / 3600 >= 24 THEN 'FP' ELSE 'unknown' END AS label FROM cand LEFT JOIN f USING (prediction_id))"""


def labelled(spark, d):
    t = typed(spark, d)
    incidents = t.where("feature = 'error' and value > 100").select("resource_id", F.col("ts").alias("opened_at"))
    cand = t.where("feature = 'view'").select(F.col("event_id").alias("prediction_id"), "resource_id", "category", "ts")
    return decisions.feedback_labels(cand, incidents, t.agg(F.max("ts").alias("now")))


@query(f"WITH {FEED_SQL} SELECT prediction_id, resource_id, category, ts, outcome_at, label FROM fb")
def feedback_labels(spark, d):
    return labelled(spark, d)


@query(f"WITH {FEED_SQL} SELECT category, sum((label = 'TP')::INT)::BIGINT AS tp, sum((label = 'FP')::INT)::BIGINT AS fp, count(*) AS n, {r6("sum((label = 'TP')::INT) / greatest(1, sum((label IN ('TP', 'FP'))::INT))")} AS precision FROM fb GROUP BY 1")
def feedback_metrics(spark, d):
    return decisions.feedback_metrics(labelled(spark, d))


@query(f"""WITH {P_SQL}, a AS (SELECT *, round(abs(value - vmax) + 3.7e-8, 6) AS gap FROM p), j AS (SELECT f.resource_id, f.feature, f.ts, f.value AS start, f.vmax AS forecast, f.value * 0.5 AS lower, f.vmax * 1.5 AS upper, CASE WHEN f.sample_count < 50 THEN 'low' ELSE 'high' END AS reliability, x.value AS actual, (epoch_us(x.ts) - epoch_us(f.ts)) / 1e6 / 3600 AS apart
 FROM p f JOIN p x ON f.resource_id = x.resource_id AND f.feature = x.feature), g AS (SELECT *, actual - forecast AS e FROM j WHERE apart BETWEEN 12 AND 36)
SELECT reliability, count(*) AS n, {r6('avg(abs(e))')} AS mae, {r6('sqrt(avg(e * e))')} AS rmse, {r6('avg(CASE WHEN actual <> 0 THEN abs(e / actual) * 100 END)')} AS mape, {r6('avg((actual BETWEEN lower AND upper)::INT)')} AS coverage, {r6('avg(-e)')} AS bias,
 {r6('avg((sign(actual - start) = sign(forecast - start))::INT)')} AS direction FROM g GROUP BY ROLLUP (reliability)""")
def forecast_accuracy(spark, d):
    t = typed(spark, d)
    made = t.select("resource_id", "feature", "ts", F.col("value").alias("start"), F.col("vmax").alias("forecast"), (F.col("value") * 0.5).alias("lower"), (F.col("vmax") * 1.5).alias("upper"), F.when(F.col("sample_count") < 50, "low").otherwise("high").alias("reliability"))
    return decisions.forecast_accuracy(decisions.tolerance_join(made, t, 24))


@query(f"WITH {ALL_SQL}, s AS (SELECT resource_id, category, ts, max(risk) AS risk FROM pr GROUP BY ALL), v AS (SELECT *, CASE WHEN risk >= 90 THEN 'CRITICAL' WHEN risk >= 75 THEN 'HIGH' WHEN risk >= 50 THEN 'WARNING' ELSE 'INFO' END AS severity FROM s), l AS (SELECT *, lag(severity) OVER (PARTITION BY resource_id, category ORDER BY ts) AS previous FROM v) SELECT resource_id, category, ts, severity, previous FROM l WHERE previous IS NULL OR previous <> severity")
def alert_state_changes(spark, d):
    s = scored_rows(spark, d).groupBy("resource_id", "category", "ts").agg(F.max("risk").alias("risk")).withColumn("severity", C.severity(F.col("risk")))
    return quality.alert_changes(s, ["resource_id", "category"], ["ts"]).select("resource_id", "category", "ts", "severity", "previous")


# ---------------------------------------------------------------- serving


@query(f"WITH {PRED_SQL} SELECT prediction_id, resource_id, project, component, location, risk FROM pr WHERE provider = 'AWS' AND risk >= 10 AND regexp_matches(resource_id || ' ' || project || ' ' || component || ' ' || location, '(?i)ec2|ebs|p3')")
def search(spark, d):
    return serve.search(predictions(spark, d), text="ec2|ebs|p3", equals={"provider": "AWS"}, least_risk=10).select("prediction_id", "resource_id", "project", "component", "location", "risk")


@query(f"WITH {PRED_SQL} SELECT resource_id, category, feature, risk FROM pr ORDER BY risk DESC, resource_id, category, feature LIMIT 20")
def top_risks(spark, d):
    return predictions(spark, d).select(*KEYS, "risk").orderBy(F.desc("risk"), *KEYS).limit(20)


@query(f"WITH {PRED_SQL} SELECT provider, category, count(DISTINCT resource_id) AS resources, count(DISTINCT project) AS projects, sum((risk >= 75)::INT)::BIGINT AS high, {r6('avg(risk)')} AS mean_risk FROM pr GROUP BY GROUPING SETS ((), (provider), (category))")
def platform_stats(spark, d):
    return serve.platform_stats(predictions(spark, d))


@query(f"WITH {PRED_SQL} SELECT project, resource_id, arg_max(severity, (risk, feature)) AS severity, max(risk) AS risk FROM pr GROUP BY ALL")
def project_roster(spark, d):
    return predictions(spark, d).groupBy("project", "resource_id").agg(F.max_by("severity", F.struct("risk", "feature")).alias("severity"), F.max("risk").alias("risk"))


@query(f"WITH {PRED_SQL}, a AS (SELECT DISTINCT account_id, project FROM p), v AS (SELECT pr.*, e.n FROM pr LEFT JOIN (SELECT resource_id, count(*) AS n FROM p WHERE feature = 'error' GROUP BY 1) e ON pr.resource_id = e.resource_id) SELECT v.prediction_id, v.project, a.account_id, v.risk, coalesce(v.n, 0) AS errors FROM v JOIN a ON v.project = a.project AND v.account_id = a.account_id")
def project_view(spark, d):
    t = typed(spark, d)
    allowed = t.select("account_id", "project").distinct()
    errors = t.where("feature = 'error'").groupBy("resource_id").agg(F.count("*").alias("n"))
    x = predictions(spark, d).join(errors, "resource_id", "left").join(allowed, ["account_id", "project"], "left_semi")
    return x.select("prediction_id", "project", "account_id", "risk", F.coalesce("n", F.lit(0)).alias("errors"))


SEV = {"CRITICAL": "0", "HIGH": "1", "WARNING": "2", "INFO": "3"}


@query(f"WITH {PRED_SQL} SELECT prediction_id, severity, row_number() OVER (ORDER BY {sql_map(SEV, 'severity')}, is_anomalous DESC, risk DESC, prediction_id) AS place FROM pr QUALIFY place <= 800")
def priority_order(spark, d):
    from pyspark.sql import Window

    order = [C.literal_map(SEV)[F.col("severity")], F.desc("is_anomalous"), F.desc("risk"), "prediction_id"]
    top = predictions(spark, d).orderBy(*order).limit(800)  # the report is the first 800
    return top.select("prediction_id", "severity", F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


def state_sql():
    out = "'unknown'"
    for name, (w, c, inv) in V.DIGEST_THRESHOLDS.items():
        op = "<=" if inv else ">="
        out = f"CASE WHEN metric = '{name}' THEN CASE WHEN value {op} {c} THEN 'critical' WHEN value {op} {w} THEN 'warn' ELSE 'ok' END ELSE {out} END"
    return out


@query(f"WITH {NEW_SQL} SELECT {KEY_SQL}, metric, {state_sql()} AS state FROM nw")
def severity_labels(spark, d):
    return newest(spark, d).select(*KEYS, "metric", C.threshold_state(F.col("metric"), F.col("value")).alias("state"))


@query("SELECT c_custkey AS id, c_mktsegment AS segment, CASE WHEN c_custkey % 4 = 0 THEN '[hidden]' ELSE c_name END AS note FROM customer")
def redact_metadata(spark, d):
    c = Catalog(spark, d).read("customer")
    details = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("API_Token"), F.col("c_name"), F.lit("note"), F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("see https://x.example/"), F.col("c_name"))).otherwise(F.col("c_name")))
    safe = c.select(F.col("c_custkey").alias("id"), serve.redact(details).alias("m"))
    return safe.select("id", F.col("m")["segment"].alias("segment"), F.col("m")["note"].alias("note"))


@query(f"""WITH {PRED_SQL} SELECT prediction_id, printf('Risk %.1f of 100 for this %s resource.', round(risk + 3.7e-8, 1), category) || ' ' || CASE WHEN z_signal < 0.4 AND burst_signal < 0.4 THEN 'No single signal stands out.' ELSE concat_ws(' ', CASE WHEN z_signal >= 0.7 THEN 'The value is far from what is usual at this time of the week.' WHEN z_signal >= 0.4 THEN 'The value is somewhat unusual for this time of the week.' END,
CASE WHEN burst_signal >= 0.6 THEN 'It spiked sharply within the reporting interval.' WHEN burst_signal >= 0.4 THEN 'It was a little bursty within the reporting interval.' END) END || ' There is no marked trend.' AS narrative FROM pr""")
def explanations(spark, d):
    none = F.lit(None).cast("double")
    text = serve.explanation(F.col("risk"), F.col("category"), F.col("z_signal"), F.col("burst_signal"), none, F.lit("stable"), F.col("feature"), none, F.lit("low"), none, none)
    return predictions(spark, d).select("prediction_id", text.alias("narrative"))


DIGEST_SQL = f"""{PRED_SQL}, dg AS (SELECT project, category, resource_id, feature, CAST({sql_map(SEV, 'severity')} AS INT) AS rank, greatest(1, length(resource_id || ' | ' || category || ' | risk ' || printf('%.1f', round(risk + 3.7e-8, 1)) || ' | ' || severity || ' | ' || printf('%.2f', value)) // 4) AS tokens FROM pr)"""


def digests(spark, d):
    rows = predictions(spark, d).withColumn("risk", C.r(F.col("risk"), 1))
    return serve.digest_line(rows).withColumn("rank", C.literal_map(SEV)[F.col("severity")].cast("int"))


@query(f"""WITH RECURSIVE {DIGEST_SQL}, od AS (SELECT *, min(rank) OVER c AS least, CAST(sum(tokens) OVER c AS BIGINT) AS whole FROM dg WINDOW c AS (PARTITION BY project, category)),
nb AS MATERIALIZED (SELECT *, row_number() OVER o AS k, category IS DISTINCT FROM lag(category) OVER o AS fresh FROM od WINDOW o AS (PARTITION BY project ORDER BY least, category, rank, resource_id, feature, tokens)),
wk AS (SELECT project, k, tokens AS used, 0 AS chunk FROM nb WHERE k = 1 UNION ALL SELECT project, k, CASE WHEN ends THEN tokens ELSE used + tokens END, chunk + CAST(ends AS INT)
 FROM (SELECT n.project, n.k, n.tokens, w.used, w.chunk, w.used + n.tokens > 400 OR (n.fresh AND w.used + n.whole > 400) AS ends FROM wk w JOIN nb n ON n.project = w.project AND n.k = w.k + 1))
SELECT project, category, resource_id, feature, tokens, chunk FROM nb JOIN wk USING (project, k)""")
def digest_chunks(spark, d):
    """L-2."""
    return serve.token_chunks(digests(spark, d), 400)


@query()
def project_summaries(spark, d):
    rows = serve.digest_line(predictions(spark, d)).withColumn("rank", C.literal_map(SEV)[F.col("severity")].cast("int"))
    chunks = serve.token_chunks(rows, 400).select("project", "category", "resource_id", "feature", "chunk")
    return serve.summarise(rows.join(chunks, ["project", "category", "resource_id", "feature"]).select("project", "chunk", "digest"))


# ---------------------------------------------------------------- sinks and streams


@query(f"WITH {A.M_SQL}, n AS (SELECT _id, value + 1 AS value, 'new' AS state FROM m WHERE _id % 4 = 0) SELECT _id, value, 'old' AS state FROM m WHERE _id % 4 <> 0 UNION ALL SELECT * FROM n")
def upsert_idempotent(spark, d):
    m = A.metric_documents(spark, d).select("_id", "value", F.lit("old").alias("state"))
    new = m.where("_id % 4 = 0").withColumn("value", F.col("value") + 1).withColumn("state", F.lit("new"))
    once = decisions.upsert(m, new.union(new), ["_id"], "value")
    return decisions.upsert(once, new, ["_id"], "value")


def scratch(spark) -> str:
    """A new folder that all executors see."""
    return new_path(spark, "stream")


def stream_of(spark, df):
    """A table as a stream of files."""
    path = scratch(spark)
    df.write.parquet(f"{path}/in")
    return spark.readStream.schema(df.schema).parquet(f"{path}/in"), path


@query(f"WITH {P_SQL} SELECT DISTINCT resource_id, feature FROM p")
def stream_dedup(spark, d):
    s, path = stream_of(spark, typed(spark, d).select("resource_id", "feature", F.col("ts").cast("timestamp").alias("ts")))
    q = jobs.run_once(jobs.dedup(s, ["resource_id", "feature"], lateness="400 days").select("resource_id", "feature"), f"{path}/out", f"{path}/state")
    q.awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query(f"WITH {A.M_SQL}, {A.I_SQL}, l AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY element_id, account_id ORDER BY version DESC) = 1) SELECT m._id, m.resource_id, l.project AS project FROM m JOIN l ON m.resource_id = l.element_id AND m.account_id = l.account_id")
def stream_enrich(spark, d):
    s, path = stream_of(spark, A.metric_documents(spark, d).drop("project"))
    out = jobs.enrich(s, A.inventory(spark, d)).select("_id", "resource_id", "project")
    jobs.run_once(out, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query(f"WITH {A.I_SQL} SELECT element_id, account_id, max(version) AS version, arg_max(project, version) AS project FROM i GROUP BY ALL")
def stream_latest_state(spark, d):
    s, path = stream_of(spark, A.inventory(spark, d).select("element_id", "account_id", "version", "project"))
    out = jobs.latest_state(s, ["element_id", "account_id"], "version", {"project": "string"})

    def keep(batch, n):
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={n}")

    out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").groupBy("element_id", "account_id").agg(F.max("version").alias("version"), F.max_by("project", "version").alias("project"))


@query(f"WITH {P_SQL} SELECT category, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n, {r6('sum(value)')} AS total FROM p GROUP BY ALL")
def hourly_rollup(spark, d):
    t = typed(spark, d)
    return t.groupBy("category", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"), C.r(F.sum("value")).alias("total"))
