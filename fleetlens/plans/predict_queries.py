"""Registered queries of predictions with their forecast. Their SQL states every limit itself."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions.metric_rules import rules as registry_rules
from fleetlens.operators import predict
from fleetlens.plans.base_queries import P_SQL, r6, typed
from fleetlens.plans.decision_queries import rules
from fleetlens.plans.forecast_queries import PRED_SQL, predictions
from fleetlens.plans.registration import query
from fleetlens.sources import adapters as A
from fleetlens.sources import catalog

#: Readings stand for registry features so that rules have something to say: (category, event) -> feature.
AS_METRIC = {
    "Compute": {"click": "canonical_cpu_pct", "view": "canonical_mem_used_pct", "error": "status_check_failed", "signup": "cpu_credit_balance"},
    "Network": {"click": "canonical_subnet_util_pct", "view": "canonical_health_pct", "error": "canonical_ddos_signal", "purchase": "canonical_dns_queries"},
    "Storage": {"click": "canonical_storage_used_pct", "view": "canonical_burst_balance_pct", "error": "backup_health_event", "purchase": "availability_pct"},
    "Container": {"click": "canonical_node_cpu_pct", "view": "canonical_node_mem_pct", "error": "canonical_unschedulable_pods", "purchase": "canonical_api_inflight_requests"},
    "Databases": {"click": "canonical_db_cpu_pct", "view": "canonical_db_storage_pct", "purchase": "canonical_db_connections"},
}
_PAIRS = {f"{c}/{e}": m for c, many in AS_METRIC.items() for e, m in many.items()}
METRIC_SQL = "CASE category || '/' || feature " + " ".join(f"WHEN '{k}' THEN '{m}'" for k, m in _PAIRS.items()) + " END"
SERIES = ["resource_id", "category", "metric"]


def metrics(spark, d):
    """Readings under their metric; a third of the resources report no primary feature."""
    rows = typed(spark, d).withColumn("metric", C.literal_map(_PAIRS)[F.concat("category", F.lit("/"), "feature")]).where("metric is not null")
    return rows.where((F.substring("resource_id", 2, 9).cast("int") % 3 > 0) | (F.col("feature") != "click"))


MM_SQL = f"{P_SQL}, mm AS (SELECT * FROM (SELECT *, {METRIC_SQL} AS metric FROM p) WHERE metric IS NOT NULL AND (CAST(substr(resource_id, 2) AS INT) % 3 > 0 OR feature <> 'click'))"
NOW_SQL = f"{MM_SQL}, nv AS (SELECT resource_id, category, metric, arg_max(value, (ts, event_id)) AS value FROM mm GROUP BY ALL)"
VALUE = "max(CASE WHEN metric = '{}' THEN value END)"
FEATURE_SQL = f"""{NOW_SQL}, cf AS (SELECT resource_id, category, CASE category
 WHEN 'Compute' THEN CASE WHEN bool_or(metric = 'canonical_cpu_pct') THEN 'canonical_cpu_pct' WHEN bool_or(metric = 'canonical_mem_used_pct') THEN 'canonical_mem_used_pct' WHEN bool_or(metric = 'status_check_failed') THEN 'status_check_failed' WHEN bool_or(metric = 'cpu_credit_balance') THEN 'cpu_credit_balance' END
 WHEN 'Network' THEN CASE WHEN bool_or(metric = 'canonical_health_pct') THEN 'canonical_health_pct' WHEN bool_or(metric = 'canonical_subnet_util_pct') THEN 'canonical_subnet_util_pct' WHEN bool_or(metric = 'canonical_dns_queries') THEN 'canonical_dns_queries' ELSE 'canonical_ddos_signal' END
 WHEN 'Storage' THEN CASE WHEN bool_or(metric = 'canonical_storage_used_pct') THEN 'canonical_storage_used_pct' WHEN bool_or(metric = 'canonical_burst_balance_pct') THEN 'canonical_burst_balance_pct' WHEN bool_or(metric = 'availability_pct') THEN 'availability_pct' ELSE 'backup_health_event' END
 WHEN 'Container' THEN CASE WHEN bool_or(metric = 'canonical_node_cpu_pct') THEN 'canonical_node_cpu_pct' WHEN bool_or(metric = 'canonical_node_mem_pct') THEN 'canonical_node_mem_pct' WHEN bool_or(metric = 'canonical_unschedulable_pods') THEN 'canonical_unschedulable_pods' ELSE 'canonical_api_inflight_requests' END
 WHEN 'Databases' THEN CASE WHEN bool_or(metric = 'canonical_db_cpu_pct') THEN 'canonical_db_cpu_pct' WHEN bool_or(metric = 'canonical_db_storage_pct') THEN 'canonical_db_storage_pct' ELSE 'canonical_db_connections' END END AS feature FROM nv GROUP BY resource_id, category)"""
S = "resource_id, category, metric"
LINE_SQL = f"""{FEATURE_SQL}, sx AS (SELECT *, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY {S}))) / 1e6 / 3600 AS x, row_number() OVER (PARTITION BY {S} ORDER BY ts, event_id) AS k, count(*) OVER (PARTITION BY {S}) AS n FROM mm),
ln AS (SELECT {S}, arg_max(value, (ts, event_id)) AS current, max(x) AS lx, CASE WHEN count(value) < 2 OR max(x) < 1e-9 THEN 0.0 ELSE regr_slope(value, x) END AS b, CASE WHEN count(value) < 2 OR max(x) < 1e-9 THEN avg(value) ELSE regr_intercept(value, x) END AS a, regr_r2(value, x) AS r2,
 max(n) AS n, median(value) FILTER (k <= n // 2) AS ma, median(value) FILTER (k > n // 2) AS mb FROM sx GROUP BY ALL),
li AS (SELECT {S}, current, a + b * (lx + 1) AS f1, a + b * (lx + 6) AS f6, a + b * (lx + 24) AS f24, a + b * (lx + 168) AS f168, CASE WHEN r2 >= 0.65 THEN 'high' WHEN r2 >= 0.25 THEN 'moderate' ELSE 'low' END AS reliability,
 CASE WHEN n < 8 THEN 'stable' WHEN (mb - ma) / greatest(abs(ma), 1e-6) > 0.2 THEN 'increasing' WHEN (mb - ma) / greatest(abs(ma), 1e-6) < -0.2 THEN 'decreasing' ELSE 'stable' END AS trend FROM ln),
wd AS (SELECT resource_id, category, {', '.join(f'{VALUE.format(m)} AS {m}' for m in sorted(set(_PAIRS.values())))} FROM nv GROUP BY ALL),
fc AS (SELECT cf.feature, wd.*, li.current, f1, f6, f24, f168, reliability, trend FROM cf JOIN wd USING (resource_id, category) JOIN li ON li.resource_id = cf.resource_id AND li.category = cf.category AND li.metric = cf.feature)"""


def order() -> dict[str, list[str]]:
    """The registry's features of each category, in its order."""
    out: dict[str, list[str]] = {}
    for category, feature, *_ in registry_rules():
        if feature not in out.setdefault(category, []):
            out[category].append(feature)
    return out


def chosen(spark, d):
    now = predict.now_map(metrics(spark, d))
    return now.withColumn("feature", predict.forecast_feature(F.col("category"), F.col("now"), order()))


def forecasted(spark, d):
    rows = metrics(spark, d)
    line = predict.lines(rows, SERIES).withColumnRenamed("metric", "feature")
    return chosen(spark, d).join(line, ["resource_id", "category", "feature"])


@query(f"WITH {FEATURE_SQL} SELECT resource_id, category, feature FROM cf")
def forecast_feature(spark, d):
    return chosen(spark, d).select("resource_id", "category", "feature")


@query(f"WITH {LINE_SQL} SELECT resource_id, category, feature, trend, reliability, current, {r6('f1')} AS f_1h, {r6('f168')} AS f_7d FROM fc")
def feature_forecasts(spark, d):
    return forecasted(spark, d).select("resource_id", "category", "feature", "trend", "reliability", "current", C.r(F.col("f_1h")).alias("f_1h"), C.r(F.col("f_7d")).alias("f_7d"))


@query(f"""WITH {LINE_SQL}, fa AS (
SELECT resource_id, category, 'CPU_80_PERCENT_BREACH' AS failure, '1h' AS span, f1 AS v FROM fc WHERE category = 'Compute' AND feature = 'canonical_cpu_pct' AND f1 >= 80
UNION ALL SELECT resource_id, category, 'CPU_90_PERCENT_BREACH', '6h', f6 FROM fc WHERE category = 'Compute' AND feature = 'canonical_cpu_pct' AND f6 >= 90
UNION ALL SELECT resource_id, category, 'MEMORY_PRESSURE', 'current', canonical_mem_used_pct FROM fc WHERE category = 'Compute' AND canonical_mem_used_pct >= 85
UNION ALL SELECT resource_id, category, 'INSTANCE_HEALTH_CHECK_FAILURE', 'current', status_check_failed FROM fc WHERE category = 'Compute' AND status_check_failed >= 1
UNION ALL SELECT resource_id, category, 'SUBNET_CAPACITY_RISK', 'current', canonical_subnet_util_pct FROM fc WHERE category = 'Network' AND canonical_subnet_util_pct >= 80
UNION ALL SELECT resource_id, category, 'DDOS_SIGNAL_DETECTED', 'current', canonical_ddos_signal FROM fc WHERE category = 'Network' AND canonical_ddos_signal >= 1
UNION ALL SELECT resource_id, category, 'STORAGE_80_PERCENT_BREACH', '1h', f1 FROM fc WHERE category = 'Storage' AND feature = 'canonical_storage_used_pct' AND f1 >= 80
UNION ALL SELECT resource_id, category, 'STORAGE_90_PERCENT_BREACH', '6h', f6 FROM fc WHERE category = 'Storage' AND feature = 'canonical_storage_used_pct' AND f6 >= 90
UNION ALL SELECT resource_id, category, 'BURST_CREDIT_EXHAUSTION', 'current', canonical_burst_balance_pct FROM fc WHERE category = 'Storage' AND canonical_burst_balance_pct < 20)
SELECT resource_id, category, failure, span, round(v + 3.7e-8, 3) AS predicted FROM fa""")
def failure_forecasts(spark, d):
    x = forecasted(spark, d)
    each = F.explode(predict.failures(F.col("category"), F.col("feature"), F.col("now"), F.col("f_1h"), F.col("f_6h")))
    return x.select("resource_id", "category", each.alias("f")).select("resource_id", "category", "f.failure", "f.span", "f.predicted")


@query(f"""WITH {LINE_SQL}, up AS (SELECT *, trend = 'increasing' AND reliability IN ('high', 'moderate') AS rising FROM fc)
SELECT resource_id, category, concat_ws(',',
 CASE WHEN category = 'Compute' AND feature = 'canonical_cpu_pct' AND current >= 80 THEN 'scale_up' END, CASE WHEN category = 'Compute' AND feature = 'canonical_cpu_pct' AND current < 25 AND trend <> 'increasing' THEN 'scale_down' END,
 CASE WHEN category = 'Compute' AND canonical_mem_used_pct >= 85 THEN 'add_memory' END, CASE WHEN category = 'Compute' AND cpu_credit_balance < 20 THEN 'leave_burstable' END, CASE WHEN category = 'Compute' AND rising AND f24 > 80 THEN 'cpu_trending_up' END,
 CASE WHEN category = 'Network' AND canonical_ddos_signal > 0 THEN 'mitigate_ddos' END, CASE WHEN category = 'Network' AND canonical_health_pct < 90 THEN 'repair_targets' END, CASE WHEN category = 'Network' AND canonical_subnet_util_pct >= 80 THEN 'extend_subnet' END,
 CASE WHEN category = 'Storage' AND feature = 'canonical_storage_used_pct' AND current >= 80 THEN 'add_capacity' END, CASE WHEN category = 'Storage' AND canonical_burst_balance_pct < 20 THEN 'provision_throughput' END,
 CASE WHEN category = 'Storage' AND backup_health_event > 0 THEN 'check_backup' END, CASE WHEN category = 'Storage' AND rising AND f168 >= 80 THEN 'storage_trending_up' END,
 CASE WHEN category = 'Container' AND canonical_node_cpu_pct >= 85 THEN 'add_nodes' END, CASE WHEN category = 'Container' AND canonical_node_mem_pct >= 85 THEN 'add_node_memory' END,
 CASE WHEN category = 'Container' AND canonical_unschedulable_pods > 0 THEN 'free_capacity' END, CASE WHEN category = 'Container' AND canonical_api_inflight_requests > 400 THEN 'throttle_clients' END,
 CASE WHEN category = 'Databases' AND canonical_db_cpu_pct >= 80 THEN 'tune_or_scale' END, CASE WHEN category = 'Databases' AND canonical_db_storage_pct >= 85 THEN 'extend_storage' END,
 CASE WHEN category = 'Databases' AND canonical_db_connections >= 90 THEN 'pool_connections' END, CASE WHEN category = 'Databases' AND rising AND f24 > 85 THEN 'db_cpu_trending_up' END,
 CASE WHEN current > 150 THEN 'investigate_change' END) AS advice FROM up""")
def forecast_advice(spark, d):
    """The score is a stand-in: 1 where the feature's current value is above 150."""
    line = {k: F.col(k) for k in ("current", "trend", "reliability", "f_24h", "f_7d")}
    got = predict.advice(F.col("category"), F.col("feature"), F.col("now"), line, (F.col("current") > 150).cast("double"))
    return forecasted(spark, d).select("resource_id", "category", F.array_join(got, ",").alias("advice"))


@query(f"""WITH {NOW_SQL} SELECT resource_id, category, metric, value FROM nv WHERE category = 'Container' AND metric IN ('canonical_node_cpu_pct', 'canonical_node_mem_pct', 'canonical_unschedulable_pods', 'canonical_api_inflight_requests')
 OR category = 'Databases' AND metric IN ('canonical_db_cpu_pct', 'canonical_db_storage_pct', 'canonical_db_connections') OR category = 'Network' AND metric = 'canonical_health_pct' OR category = 'Storage' AND metric = 'availability_pct'""")
def payload_values(spark, d):
    now = predict.now_map(metrics(spark, d))
    return now.select("resource_id", "category", F.explode(predict.shown(F.col("category"), F.col("now"))).alias("metric", "value"))


@query(f"WITH {PRED_SQL}, {A.M_SQL}, ch AS (SELECT DISTINCT 'r' || resource_id AS resource_id FROM m WHERE merged_at > TIMESTAMP '1998-06-01') SELECT prediction_id, resource_id, feature, risk FROM pr WHERE resource_id IN (SELECT resource_id FROM ch)")
def changed_predictions(spark, d):
    """S-7: only resources with documents newer than the cursor are predicted again."""
    ids, _ = catalog.changed_since(A.metric_documents(spark, d), F.expr("TIMESTAMP_NTZ '1998-06-01 00:00:00'"))
    return predictions(spark, d).join(ids.select(F.concat(F.lit("r"), "resource_id").alias("resource_id")), "resource_id", "left_semi").select("prediction_id", "resource_id", "feature", "risk")


@query(f"WITH {P_SQL} SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN NULL ELSE value END AS value FROM p")
def finite_values(spark, d):
    broken = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).when(F.col("event_id") % 7 == 1, F.lit(float("-inf"))).otherwise(F.col("value"))
    return typed(spark, d).select("event_id", predict.finite(broken).alias("value"))


@query(f"WITH {PRED_SQL}, byhour AS (SELECT project, date_trunc('hour', ts) AS hour, count(*) AS n, max(risk) AS risk FROM pr GROUP BY ALL) SELECT project, hour, n, risk FROM byhour QUALIFY row_number() OVER (PARTITION BY project ORDER BY hour DESC) = 1")
def latest_summaries(spark, d):
    """K-5, O-8: one summary for each project and hour, the newest of each project."""
    by_hour = predictions(spark, d).groupBy("project", predict.hour_bucket(F.col("ts")).alias("hour")).agg(F.count("*").alias("n"), F.max("risk").alias("risk"))
    return by_hour.groupBy("project").agg(F.max_by(F.struct("hour", "n", "risk"), "hour").alias("s")).select("project", "s.hour", "s.n", "s.risk")


@query(f"WITH {PRED_SQL} SELECT prediction_id, severity FROM pr WHERE is_anomalous OR severity <> 'INFO'")
def worth_explaining(spark, d):
    return predict.worth_explaining(predictions(spark, d)).select("prediction_id", "severity")


@query(f"""WITH {P_SQL}, ids AS (SELECT DISTINCT resource_id FROM p WHERE CAST(substr(resource_id, 2) AS INT) % 3 = 0), ru AS (SELECT ids.resource_id, v.* FROM ids, (VALUES ('click', 'gte', 150.0), ('view', 'gt', 200.0), ('error', 'lt', 5.0), ('purchase', 'lte', 2.0)) AS v(metric_name, operator, lim))
SELECT resource_id, metric_name, CASE WHEN metric_name = 'view' AND CAST(substr(resource_id, 2) AS INT) % 2 = 0 THEN 'gte' ELSE operator END AS operator, CASE WHEN metric_name = 'view' AND CAST(substr(resource_id, 2) AS INT) % 2 = 0 THEN 20.0 ELSE lim::DOUBLE END AS "limit" FROM ru WHERE metric_name <> 'error'""")
def rule_updates(spark, d):
    """D-10: half of the view rules are set twice, error rules are deleted."""
    old = rules(spark, d)
    half = old.where("metric_name = 'view' and cast(substr(resource_id, 2) as int) % 2 = 0").select("resource_id", "metric_name", F.lit("gte").alias("operator"))
    new = half.withColumn("limit", F.lit(10.0)).withColumn("seq", F.lit(1)).union(half.withColumn("limit", F.lit(20.0)).withColumn("seq", F.lit(2)))
    gone = old.where("metric_name = 'error'").select("resource_id", "metric_name")
    return predict.delete_rules(predict.set_rules(old, new), gone).select("resource_id", "metric_name", "operator", "limit")
