"""Registered queries of identity, merging, gates, delivery and stored tables."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import assemble, decisions, forecast, ingest, normalize, profiles, serve
from fleetlens.plans.base_queries import N_SQL, P_SQL, nested_documents, r6, sql_map, typed
from fleetlens.plans.decision_queries import ALL_SQL, WINDOWS, maintenance, scored_rows, values_sql
from fleetlens.plans.forecast_queries import KEY_SQL, KEYS, OVER, PRED_SQL, predictions
from fleetlens.plans.registration import query
from fleetlens.sources import adapters as A
from fleetlens.sources.catalog import Catalog
from fleetlens.sources.shared import new_path


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS document_id, CASE WHEN o_orderkey % 3 = 0 THEN 'e' || o_custkey WHEN o_orderkey % 2 = 0 THEN 'r' || o_custkey ELSE CAST(o_orderkey AS VARCHAR) END AS resource_id,
CASE WHEN o_orderkey % 5 = 0 THEN 'shown ' || o_custkey WHEN o_orderkey % 3 = 0 THEN 'e' || o_custkey WHEN o_orderkey % 2 = 0 THEN 'r' || o_custkey ELSE CAST(o_orderkey AS VARCHAR) END AS resource_name,
o_orderstatus AS project, CASE o_orderkey % 4 WHEN 1 THEN 'Compute' WHEN 2 THEN 'Network' ELSE 'Storage' END AS category, CASE WHEN o_orderkey % 4 = 1 THEN 'EC2' ELSE 'thing' END AS component,
CASE o_orderkey % 4 WHEN 1 THEN 'vm_instance' WHEN 2 THEN 'other_network' ELSE 'other_storage' END AS rtype, CASE WHEN o_orderkey % 2 = 0 THEN 'AWS' ELSE 'unknown' END AS provider FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 7 <> 0""")
def identity_fields(spark, d):
    """Orders as documents whose fields are null or empty by turns; every fourth has no category, every seventh no metric."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    docs = Catalog(spark, d).read("orders").select(
        k.alias("_id"), F.when(k % 3 == 0, F.concat(F.lit("e"), c)).when(k % 3 == 1, "").alias("element_id"), F.when(k % 2 == 0, F.concat(F.lit("r"), c)).otherwise("").alias("resource_id"),
        F.when(k % 5 == 0, F.concat(F.lit("shown "), c)).otherwise("").alias("display_name"), F.lit(None).cast("string").alias("resource_name"), F.col("o_orderstatus").alias("project"),
        F.when(k % 4 == 1, " Virtual_Machines ").when(k % 4 == 2, "NETWORKING").when(k % 4 == 3, "volumes").otherwise("").alias("category"),
        F.when(k % 4 == 1, "EC2").alias("component"), F.lit("thing").alias("service_type"), F.when(k % 2 == 0, "Amazon").alias("service_name"), F.when(k % 7 == 0, None).otherwise(F.col("o_orderpriority")).alias("metric"),
    )
    return assemble.identity(docs).select("document_id", "resource_id", "resource_name", "project", "category", "component", "rtype", "provider")


@query(f"""WITH {A.M_SQL}, {A.I_SQL}, l AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY element_id, account_id ORDER BY version DESC) = 1)
SELECT m._id, l.project, CASE WHEN m._id % 4 = 0 THEN NULL WHEN m._id % 2 = 0 THEN 'here' ELSE l.location END AS location, CASE WHEN l.version = 2 THEN 'stored' ELSE 'told' END AS category, m.metric AS metric, 'v' || l.version AS version
FROM m JOIN l ON m.resource_id = l.element_id AND m.account_id = l.account_id""")
def merged_documents(spark, d):
    """Every second document states a location, half of these a null one; only newer inventory rows state a category."""
    e = ingest.enrich(A.metric_documents(spark, d), A.inventory(spark, d))
    pair = lambda k, v: F.create_map(F.lit(k), v)
    none = F.create_map().cast("map<string,string>")
    document = F.map_concat(pair("metric", F.col("metric")), pair("project", F.col("project")), pair("category", F.lit("told")), F.when(F.col("_id") % 2 == 0, pair("location", F.when(F.col("_id") % 4 > 0, "here"))).otherwise(none))
    stored = F.map_concat(pair("project", F.col("inv_project")), pair("location", F.col("inv_location")), pair("version", F.concat(F.lit("v"), "inv_version")), F.when(F.col("inv_version") == 2, pair("category", F.lit("stored"))).otherwise(none))
    x = e.select("_id", assemble.merge_maps(document, stored).alias("x"))
    return x.select("_id", *[F.col("x")[n].alias(n) for n in ("project", "location", "category", "metric", "version")])


GATE_SQL = f"""{PRED_SQL}, hz AS (SELECT max(ts) AS now FROM p), seen AS (SELECT resource_id, (epoch_us(any_value(now)) - epoch_us(max(ts))) / 1e6 / 60 AS age, CASE WHEN count(*) < 2 THEN 0 ELSE round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / 3600 + 3.7e-8, 2) END AS hours FROM p, hz GROUP BY 1),
g0 AS (SELECT pr.* EXCLUDE (risk, score, severity, is_anomalous, badge), risk AS r0, score AS s0, round_even(age, 1) AS age, hours, CASE WHEN event_id % 13 = 0 THEN 'no_telemetry' WHEN round_even(age, 1) > 600 THEN 'stale' WHEN hours < 690 THEN 'thin' ELSE 'normal' END AS gate FROM pr JOIN seen USING (resource_id)),
g1 AS (SELECT *, CASE WHEN gate IN ('no_telemetry', 'stale') THEN 0.0 ELSE r0 END AS risk, CASE WHEN gate IN ('no_telemetry', 'stale') THEN 0.0 ELSE s0 END AS score,
 CASE WHEN age > 600 THEN 'stale_resource_' || CAST(round_even(age, 0) AS BIGINT) || 'min' WHEN hours < 690 THEN 'insufficient_history_' || printf('%.1f', round(hours + 3.7e-8, 1)) || 'h' END AS data_quality_note FROM g0),
ga AS (SELECT *, gate = 'normal' AND (score >= 0.6 OR dominant) AS is_anomalous, gate = 'normal' AND (risk >= 40 OR dominant) AS trigger, CAST(round_even(risk, 0) AS BIGINT) AS display_score,
 CASE WHEN gate <> 'normal' THEN 'INFO' WHEN risk >= 90 THEN 'CRITICAL' WHEN risk >= 75 THEN 'HIGH' WHEN risk >= 50 THEN 'WARNING' ELSE 'INFO' END AS severity, CASE gate WHEN 'no_telemetry' THEN 'verify_agent' WHEN 'stale' THEN 'verify_reporting' WHEN 'thin' THEN 'await_history' END AS gate_advice FROM g1)"""


def gated(spark, d):
    """Predictions after gates of 600 minutes and 690 hours, so that each gate has rows; every thirteenth counts as silent."""
    t = typed(spark, d)
    p = predictions(spark, d).withColumn("completeness", F.when(F.col("event_id") % 13 == 0, 0.0).otherwise(1.0))
    return assemble.gated(p, t.agg(F.max("ts").alias("now")), t, 600, 690)


@query(f"WITH {GATE_SQL} SELECT prediction_id, resource_id, feature, gate, data_quality_note, risk, severity, is_anomalous, trigger, display_score, gate_advice FROM ga")
def gated_predictions(spark, d):
    return gated(spark, d).select("prediction_id", "resource_id", "feature", "gate", "data_quality_note", "risk", "severity", "is_anomalous", "trigger", "display_score", "gate_advice")


LATEST_SQL = f"{GATE_SQL}, la AS (SELECT * FROM ga QUALIFY row_number() OVER (PARTITION BY resource_id, category ORDER BY ts DESC, event_id DESC) = 1)"


@query(f"""WITH {LATEST_SQL}, lv AS (SELECT *, CASE WHEN display_score >= 90 THEN 'CRITICAL' WHEN display_score >= 75 THEN 'HIGH' WHEN display_score >= 50 THEN 'MEDIUM' WHEN display_score > 0 THEN 'LOW' WHEN display_score = 0 THEN 'HEALTHY' ELSE 'UNKNOWN' END AS level FROM la)
SELECT provider, category, level, count(*) AS resources, count(*) FILTER (is_anomalous) AS anomalous, count(*) FILTER (trigger) AS alerts, count(DISTINCT project) AS projects FROM lv GROUP BY GROUPING SETS ((), (provider), (category), (level))""")
def fleet_stats(spark, d):
    return assemble.fleet_stats(assemble.latest_per_resource(gated(spark, d)))


@query(f"WITH {LATEST_SQL} SELECT resource_id, category, risk FROM la WHERE risk >= 1 AND CAST(substr(resource_id, 2) AS INT) % 2 = 0 AND regexp_matches(resource_id || ' ' || project || ' ' || component || ' ' || location, '(?i)LOC[01]') ORDER BY risk DESC, resource_id LIMIT 25 OFFSET 2")
def search_page(spark, d):
    """F-8, O-2: the second page of what is found by text, risk and tag among each resource's latest predictions."""
    tags = F.create_map(F.lit("Env"), F.when(F.substring("resource_id", 2, 9).cast("int") % 2 == 0, "prod").otherwise("test"))
    latest = assemble.latest_per_resource(gated(spark, d)).withColumn("tags", tags)
    return serve.search(latest, text="LOC[01]", least_risk=1, tag=("env", "prod"), offset=2, limit=25).select("resource_id", "category", "risk")


@query("WITH n AS (SELECT max(o_orderdate) - INTERVAL 90 DAY AS now FROM orders) SELECT o_orderkey AS window_id, 'r' || o_custkey AS resource_id FROM orders, n WHERE o_orderdate <= now AND o_orderdate + INTERVAL 30 DAY >= now AND o_orderkey % 11 <> 0")
def active_windows(spark, d):
    """Orders as windows of thirty days, every eleventh without an end; ninety days before the last order."""
    o = Catalog(spark, d).read("orders")
    ends = F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderdate") + F.expr("INTERVAL 30 DAY"))
    windows = o.select(F.col("o_orderkey").alias("window_id"), F.concat(F.lit("r"), "o_custkey").alias("resource_id"), F.col("o_orderdate").alias("starts_at"), ends.alias("ends_at"))
    return assemble.active(windows, o.agg((F.max("o_orderdate") - F.expr("INTERVAL 90 DAY")).alias("now"))).select("window_id", "resource_id")


TAGGED = [(5, None, None, "2024-01-03 00:00:00", "2024-01-09 00:00:00", "staging work", "staging"), *[(*w, None) for w in WINDOWS[:2]]]


@query(f"""WITH {ALL_SQL}, w AS (SELECT window_id, w_resource, w_category, s::TIMESTAMP AS s, e::TIMESTAMP AS e, reason, env FROM {values_sql([tuple(x or '*' for x in w) for w in TAGGED])} AS v(window_id, w_resource, w_category, s, e, reason, env)),
h AS (SELECT prediction_id, arg_min(reason, window_id) AS reason FROM (SELECT *, CASE CAST(substr(resource_id, 2) AS INT) % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'prod' END AS tag FROM pr) q JOIN w ON w_resource IN ('*', resource_id) AND w_category IN ('*', category) AND ts BETWEEN s AND e AND (env = '*' OR env = tag) GROUP BY 1)
SELECT prediction_id, h.reason, h.reason IS NOT NULL AS suppressed FROM pr LEFT JOIN h USING (prediction_id)""")
def tagged_maintenance(spark, d):
    """J-6 with tags: a window for what is tagged env=staging beside windows without tags; a third has no tags."""
    w = spark.createDataFrame(TAGGED, "window_id int, resource_id string, category string, s string, e string, reason string, env string")
    windows = w.select("window_id", "resource_id", "category", F.col("s").cast("timestamp_ntz").alias("starts_at"), F.col("e").cast("timestamp_ntz").alias("ends_at"), "reason", F.when(F.col("env").isNotNull(), F.create_map(F.lit("env"), "env")).alias("tags"))
    m = F.substring("resource_id", 2, 9).cast("int") % 3
    rows = scored_rows(spark, d).withColumn("tags", F.when(m == 0, F.create_map(F.lit("Env"), F.lit("staging"))).when(m == 1, F.create_map(F.lit("env"), F.lit("prod"))))
    return decisions.suppress(rows, windows).select("prediction_id", "reason", "suppressed")


@query(f"""WITH {P_SQL}, s AS (SELECT *, abs(value - lag(value) OVER {OVER}) AS one, abs(value - lag(value, 4) OVER {OVER}) AS far FROM p), a AS (SELECT {KEY_SQL}, CASE WHEN count(value) >= 8 THEN avg(far) ELSE avg(one) END AS raw, avg(abs(value)) AS size FROM s GROUP BY ALL)
SELECT {KEY_SQL}, {r6('CASE WHEN size <= 1e-9 THEN CASE WHEN raw > 1e-9 THEN raw END ELSE greatest(raw, 0.01 * size) END')} AS scale, size > 1e-9 AND raw < 0.01 * size AS floored FROM a WHERE raw IS NOT NULL""")
def seasonal_scale(spark, d):
    """T-17 with a season of four readings, as series here are short; hourly series take 24."""
    return forecast.mase_scale(typed(spark, d), KEYS, 4).withColumn("scale", C.r(F.col("scale")))


@query(f"WITH {P_SQL} SELECT rtype, feature, count(*) AS n, {r6('corr(value, vmax)')} AS correlation, {r6('regr_r2(vmax, value)')} AS r2, {r6('stddev_pop(value)')} AS sd_pop, {r6('stddev_samp(value)')} AS sd_samp, {r6('quantile_cont(value, 0.25)')} AS p25 FROM p GROUP BY ALL HAVING count(*) >= 3")
def feature_correlations(spark, d):
    """X-5."""
    t = typed(spark, d)
    stats = {"correlation": F.corr("value", "vmax"), "r2": F.regr_r2("vmax", "value"), "sd_pop": F.stddev_pop("value"), "sd_samp": F.stddev_samp("value")}
    out = t.groupBy("rtype", "feature").agg(F.count("*").alias("n"), *[C.r(v).alias(k) for k, v in stats.items()]).where("n >= 3")
    return out.join(profiles.quantiles(t, ["rtype", "feature"], "value", {"p25": 0.25}).drop("n"), ["rtype", "feature"]).withColumn("p25", C.r(F.col("p25")))


@query(f"WITH {N_SQL}, q AS (SELECT category, provider, metric, count(*) AS documents FROM pt GROUP BY ALL) SELECT q.metric, sum(documents)::BIGINT AS documents FROM q WHERE EXISTS (SELECT 1 FROM reg WHERE reg.category = q.category AND reg.provider = q.provider AND reg.raw_metric = q.metric) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def top_mapped(spark, d):
    """O-5: the other half of the report."""
    c = normalize.coverage(normalize.points(nested_documents(spark, d)), normalize.rule_table(spark))
    return c.where("mapped").groupBy("metric").agg(F.sum("documents").alias("documents")).orderBy(F.desc("documents"), "metric").limit(25)


@query(f"WITH {P_SQL} SELECT rtype, feature, count(value) AS n, {r6('avg(value)')} AS mean, {r6('quantile_cont(value, 0.95)')} AS p95 FROM p WHERE category = 'Compute' GROUP BY ALL HAVING count(value) >= 5")
def stored_profiles(spark, d):
    """K-4, S-12: all profiles stored by category, one category's read."""
    path = new_path(spark, "profiles")
    assemble.save_profiles(profiles.profile_stats(typed(spark, d)), path)
    return assemble.load_profiles(spark, path, "Compute").select("rtype", "feature", "n", C.r(F.col("mean")).alias("mean"), C.r(F.col("p95")).alias("p95"))


HALF = "rtype, category, feature, count(value) AS n, avg(value) AS mean FROM p"


@query(f"""WITH {P_SQL}, w AS (SELECT {HALF} WHERE category = 'Compute' GROUP BY ALL HAVING count(value) >= 5), o AS (SELECT {HALF} WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL HAVING count(value) >= 5)
SELECT rtype, category, feature, n, {r6('mean')} AS mean FROM (SELECT * FROM w UNION ALL SELECT * FROM o ANTI JOIN w USING (rtype, category, feature))""")
def upserted_profiles(spark, d):
    """K-4: profiles of the first half, then those of one category anew, twice."""
    path, rows = new_path(spark, "profiles"), typed(spark, d)
    assemble.save_profiles(profiles.profile_stats(rows.where("ts < timestamp_ntz'2024-01-15'")), path)
    new = profiles.profile_stats(rows.where("category = 'Compute'"))
    assemble.upsert_profiles(spark, path, new)
    assemble.upsert_profiles(spark, path, new)
    return spark.read.parquet(path).select("rtype", "category", "feature", "n", C.r(F.col("mean")).alias("mean"))


def told(spark, d):
    """Readings as explanations: newest of each resource before and after the fifteenth; every fifth has failed."""
    failed = F.col("event_id") % 5 == 0
    e = typed(spark, d).select("resource_id", "event_id", F.col("ts").alias("at"), F.concat("feature", F.lit(" "), F.col("event_id").cast("string")).alias("narrative"), F.when(failed, "no reply").alias("error"))
    first = F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    old = ingest.latest_rows(e.where(F.col("at") < first), ["resource_id"], "at").drop("event_id")
    return assemble.store_explanations(old, e.where(F.col("at") >= first).drop("event_id"))


TOLD_SQL = """e AS (SELECT resource_id, event_id, ts AS told_at, feature || ' ' || event_id AS narrative, CASE WHEN event_id % 5 = 0 THEN 'no reply' END AS error FROM p), ne AS (SELECT resource_id, arg_max(narrative, told_at) AS narrative FROM e WHERE told_at >= TIMESTAMP '2024-01-15' AND error IS NULL GROUP BY 1),
ol AS (SELECT resource_id, narrative, error FROM e WHERE told_at < TIMESTAMP '2024-01-15' QUALIFY row_number() OVER (PARTITION BY resource_id ORDER BY told_at DESC, event_id DESC) = 1), ex AS (SELECT resource_id, narrative, NULL AS error FROM ne UNION ALL SELECT * FROM ol WHERE resource_id NOT IN (SELECT resource_id FROM ne))"""


@query(f"WITH {P_SQL}, {TOLD_SQL} SELECT resource_id, narrative, error FROM ex")
def stored_explanations(spark, d):
    return told(spark, d).select("resource_id", "narrative", "error")


@query(f"WITH {PRED_SQL}, {TOLD_SQL} SELECT prediction_id, pr.resource_id, risk, narrative FROM pr LEFT JOIN (SELECT * FROM ex WHERE error IS NULL) x ON pr.resource_id = x.resource_id")
def cards_explained(spark, d):
    return assemble.with_explanations(predictions(spark, d), told(spark, d)).select("prediction_id", "resource_id", "risk", "narrative")


@query(f"WITH {P_SQL} SELECT project, date_trunc('hour', ts) AS hour, arg_max(event_id, (ts, event_id)) AS summary FROM p GROUP BY ALL")
def stored_summaries(spark, d):
    """K-5: every reading as a summary of its project, stored in two runs; the last of an hour stays."""
    s = typed(spark, d).select("project", F.col("ts").alias("at"), F.col("event_id").alias("summary"))
    cut = F.expr("TIMESTAMP_NTZ '2024-01-15 12:30:00'")
    none = s.limit(0).withColumn("hour", F.col("at"))
    once = assemble.store_summaries(none, s.where(F.col("at") < cut))
    return assemble.store_summaries(once, s.where(F.col("at") >= cut)).select("project", "hour", "summary")


@query(f"""WITH {PRED_SQL}, w AS (SELECT window_id, w_resource, w_category, s::TIMESTAMP AS s, e::TIMESTAMP AS e, reason FROM {values_sql(WINDOWS)} AS v(window_id, w_resource, w_category, s, e, reason)), ok AS (SELECT * FROM pr WHERE value > 30),
h AS (SELECT DISTINCT prediction_id FROM ok JOIN w ON w_resource IN ('*', resource_id) AND w_category IN ('*', category) AND ts BETWEEN s AND e)
SELECT prediction_id, category, CASE WHEN prediction_id IN (SELECT prediction_id FROM h) THEN 'INFO' ELSE severity END AS severity, '' AS errors FROM ok UNION ALL SELECT prediction_id, category, severity, 'missing_project' FROM pr WHERE NOT value > 30""")
def delivered_predictions(spark, d):
    """D-8: the whole delivery; predictions of small values have no project and aren't delivered."""
    p = predictions(spark, d).withColumn("project", F.when(F.col("value") > 30, F.col("project")))
    good, bad = assemble.deliver(p, maintenance(spark), new_path(spark, "predictions"))
    return good.select("prediction_id", "category", "severity", F.lit("").alias("errors")).unionByName(bad.select("prediction_id", "category", "severity", F.array_join("errors", ",").alias("errors")))


@query(f"WITH {P_SQL} SELECT category, resource_id, min(ts) AS first, max(ts) AS last, count(*) AS n FROM p WHERE category IN ('Compute', 'Network') GROUP BY ALL")
def ordered_table(spark, d):
    """O-1, K-8: written in order, two categories read."""
    path = new_path(spark, "ordered")
    assemble.write_ordered(typed(spark, d).select("category", "resource_id", "ts", "value"), path)
    return spark.read.parquet(path).where(F.col("category").isin("Compute", "Network")).groupBy("category", "resource_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"))


CLASSES = {"resource_id": "categorical", "category": "categorical", "provider": "categorical", "component": "categorical", "value": "numeric", "vmax": "numeric", "sample_count": "numeric"}


@query(f"WITH {P_SQL} SELECT name, {sql_map(CLASSES, 'name')} AS kind, filled FROM (SELECT " + ", ".join(f"count({n})" + f" AS {n}" for n in CLASSES) + f" FROM p) UNPIVOT (filled FOR name IN ({', '.join(CLASSES)}))")
def feature_classes(spark, d):
    """P-19."""
    return assemble.filled(typed(spark, d).select("event_id", *CLASSES), ("event_id",))
