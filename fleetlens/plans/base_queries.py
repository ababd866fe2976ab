"""Registered queries: scans, enrichment, normalisation, quality, profiles and anomaly signals, each with its SQL."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import vocabulary as V
from fleetlens.functions.metric_rules import rules
from fleetlens.operators import anomaly, ingest, normalize, profiles, quality
from fleetlens.plans.registration import query
from fleetlens.sources import adapters as A
from fleetlens.sources import catalog

SERIES = ["resource_id", "category", "feature"]
R = "round(({}) + 3.7e-8, 6)"


def r6(x: str) -> str:
    return R.format(x)


def sql_map(values: dict, key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


RTYPE_SQL = f"coalesce({sql_map(V.COMPONENT_TYPES, 'component')}, 'other_' || lower(category))"
P_SQL = f"{A.T_SQL}, p AS (SELECT *, {RTYPE_SQL} AS rtype FROM t)"


def typed(spark, d):
    return A.telemetry(spark, d).withColumn("rtype", C.resource_type(F.col("component"), F.col("category")))


# ---------------------------------------------------------------- scans


@query(f"WITH {A.T_SQL} SELECT resource_id, category, provider, component, location, feature, ts, value, {r6('vmax')} AS vmax FROM t")
def adapter_telemetry(spark, d):
    return A.telemetry(spark, d).select("resource_id", "category", "provider", "component", "location", "feature", "ts", "value", C.r(F.col("vmax")).alias("vmax"))


@query(f"WITH {A.T_SQL} SELECT resource_id, category, feature, ts, value FROM t QUALIFY row_number() OVER (PARTITION BY resource_id, category, feature ORDER BY ts DESC, event_id DESC) = 1")
def latest_rows(spark, d):
    return ingest.latest_rows(A.telemetry(spark, d), SERIES).select(*SERIES, "ts", "value")


@query(f"WITH {A.T_SQL} SELECT max(ts) AS horizon FROM t")
def data_horizon(spark, d):
    return catalog.data_horizon(A.telemetry(spark, d), "ts")


LINE_SPAN = "SELECT l_orderkey * 10 + l_linenumber AS _id, o_orderdate AS from_date, l_shipdate AS to_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate AND l_shipdate < o_orderdate + INTERVAL 7 DAY"


@query(f"""WITH s AS (SELECT (epoch(to_date) - epoch(from_date)) / 60.0 AS m FROM ({LINE_SPAN} ORDER BY from_date, _id LIMIT 200)), a AS (SELECT list_sort(list(m)) AS l FROM s WHERE m > 0 AND m < 10080)
SELECT CASE WHEN l IS NULL OR len(l) = 0 THEN 1440.0 ELSE greatest(60.0, l[len(l) // 2 + 1] * 1.5) END::DOUBLE AS minutes FROM a""")
def granularity_probe(spark, d):
    cat = catalog.Catalog(spark, d)
    spans = cat.read("lineitem").join(cat.read("orders"), F.col("l_orderkey") == F.col("o_orderkey")).where("l_shipdate > o_orderdate and l_shipdate < o_orderdate + interval 7 days")
    docs = spans.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_id"), F.col("o_orderdate").alias("from_date"), F.col("l_shipdate").alias("to_date"))
    return catalog.granularity_minutes(docs)


@query(f"WITH {A.M_SQL} SELECT DISTINCT resource_id FROM m WHERE merged_at > TIMESTAMP '1997-01-01'")
def changed_since(spark, d):
    return catalog.changed_since(A.metric_documents(spark, d), F.expr("TIMESTAMP_NTZ '1997-01-01 00:00:00'"))[0]


@query(f"WITH {A.M_SQL} SELECT max(merged_at) AS high_water FROM m WHERE merged_at > TIMESTAMP '1997-01-01'")
def high_water_mark(spark, d):
    return catalog.changed_since(A.metric_documents(spark, d), F.expr("TIMESTAMP_NTZ '1997-01-01 00:00:00'"))[1]


@query(f"WITH {A.M_SQL} SELECT _id, resource_id, metric, value FROM m WHERE resource_id IN (SELECT resource_id FROM m WHERE merged_at > TIMESTAMP '1998-06-01')")
def changed_history(spark, d):
    docs = A.metric_documents(spark, d)
    ids, _ = catalog.changed_since(docs, F.expr("TIMESTAMP_NTZ '1998-06-01 00:00:00'"))
    return catalog.history_of(docs, ids).select("_id", "resource_id", "metric", "value")


@query(f"WITH {A.T_SQL} SELECT event_id, resource_id, category, ts, value FROM t WHERE category IN ('Compute', 'Network')")
def category_scan(spark, d):
    return A.telemetry(spark, d).where(C.category(F.col("category")).isin("Compute", "Network")).select("event_id", "resource_id", "category", "ts", "value")


@query(f"WITH {A.T_SQL}, x AS (SELECT max(ts) AS now FROM t) SELECT resource_id, category, feature, ts, value FROM t, x WHERE ts >= now - INTERVAL 1440 MINUTE")
def window_scan(spark, d):
    t = A.telemetry(spark, d)
    now = t.agg(F.max("ts").alias("now"))
    return t.where(F.col("ts") >= now.scalar() - F.expr("interval 1440 minutes")).select(*SERIES, "ts", "value")


# ---------------------------------------------------------------- enrichment


@query(f"""WITH {A.M_SQL}, u AS (SELECT _id, resource_id, metric, value, from_date FROM m UNION ALL SELECT _id + 100000000, resource_id, metric, value, from_date FROM m WHERE _id % 3 = 0)
SELECT min(_id) AS _id, resource_id, metric, value, from_date FROM u GROUP BY resource_id, metric, value, from_date""")
def dedup_documents(spark, d):
    m = A.metric_documents(spark, d).select("_id", "resource_id", "metric", "value", "from_date")
    return ingest.dedup_documents(m.union(m.where("_id % 3 = 0").withColumn("_id", F.col("_id") + 100000000)))


@query(f"WITH {A.I_SQL} SELECT element_id, account_id, project, location, balance, version FROM i QUALIFY row_number() OVER (PARTITION BY element_id, account_id ORDER BY version DESC) = 1")
def inventory_latest(spark, d):
    return ingest.latest_inventory(A.inventory(spark, d)).select("element_id", "account_id", "project", "location", "balance", "version")


J_SQL = f"{A.M_SQL}, {A.I_SQL}, l AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY element_id, account_id ORDER BY version DESC) = 1)"


@query(f"WITH {J_SQL} SELECT m._id, m.resource_id, m.account_id, m.metric, m.value, l.project AS inv_project, l.location AS inv_location, l.version AS inv_version FROM m JOIN l ON m.resource_id = l.element_id AND m.account_id = l.account_id")
def enrich_inner(spark, d):
    return ingest.enrich(A.metric_documents(spark, d), A.inventory(spark, d)).select("_id", "resource_id", "account_id", "metric", "value", "inv_project", "inv_location", "inv_version")


@query(f"WITH {J_SQL} SELECT _id, resource_id, account_id, metric, value FROM m WHERE NOT EXISTS (SELECT 1 FROM l WHERE m.resource_id = l.element_id AND m.account_id = l.account_id)")
def enrich_unmatched(spark, d):
    return ingest.unmatched(A.metric_documents(spark, d), A.inventory(spark, d)).select("_id", "resource_id", "account_id", "metric", "value")


@query(f"WITH {J_SQL} SELECT m._id, m.resource_id, m.account_id, m.project AS document_project, l.project, l.location, l.version AS inventory_version FROM m JOIN l ON m.resource_id = l.element_id AND m.account_id = l.account_id")
def merge_precedence(spark, d):
    return ingest.merge_precedence(ingest.enrich(A.metric_documents(spark, d), A.inventory(spark, d)))


@query(f"WITH {A.I_SQL} SELECT element_id, account_id, count(*) AS versions, CAST(sum(CASE WHEN version IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_versions FROM i GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return ingest.duplicate_keys(A.inventory(spark, d))


@query(f"WITH {A.M_SQL} SELECT _id AS source_id, 'snapshot' AS operation_type, '2024-01-01' AS captured_at FROM m")
def history_seed(spark, d):
    return ingest.change_log(A.metric_documents(spark, d), "snapshot", "2024-01-01").drop("document")


# ---------------------------------------------------------------- normalisation


def nested_documents(spark, d):
    """Metric documents whose readings are maps with keys in mixed case, made from events: one document per resource,
    feature and day. The feature's place in the alphabet picks a raw metric of the registry."""
    t = A.telemetry(spark, d)
    keys = [F.lit("Average"), F.lit("average"), F.lit("Maximum"), F.lit("Sum")]
    which = F.element_at(F.array(*keys), (F.col("event_id") % 4 + 1).cast("int"))
    reading = F.create_map(F.lit("Timestamp"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), which, F.col("value").cast("string"), F.lit("SampleCount"), F.col("sample_count").cast("string"), F.lit("Minimum"), F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.lit("0.5")))
    place = F.array_position(F.array(*map(F.lit, ["click", "error", "purchase", "signup", "view"])), F.col("feature")).cast("int") - 1
    named = t.withColumn("place", place).join(F.broadcast(registry_places(spark)), ["category", "provider", "place"], "left")
    docs = named.withColumn("metric", F.coalesce("raw_metric", F.concat(F.lit("raw_"), "feature"))).groupBy("resource_id", "category", "provider", "metric", F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("from_date"))
    out = docs.agg(F.min("event_id").alias("_id"), F.collect_list(F.struct("event_id", reading.alias("m"))).alias("x"))
    return out.select("_id", "resource_id", "category", "provider", "metric", "from_date", F.lit(None).cast("timestamp_ntz").alias("created_at"), F.transform("x", lambda x: x.m).alias("metric_value"))


def places() -> list[tuple]:
    seen, out = {}, []
    for category, feature, provider, raw, kind, _ in rules():
        key = (category, provider)
        if raw not in seen.setdefault(key, []):
            out.append((category, provider, len(seen[key]), raw, kind, feature))
            seen[key].append(raw)
    return out


def registry_places(spark):
    return spark.createDataFrame([x[:4] for x in places()], "category string, provider string, place int, raw_metric string")


def values_sql(rows: list[tuple]) -> str:
    quote = lambda x: str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(quote, x)) + ")" for x in rows) + ")"


N_SQL = f"""{A.T_SQL},
reg AS (SELECT * FROM {values_sql(rules())} AS v(category, feature, provider, raw_metric, transform, precedence)),
pl AS (SELECT * FROM {values_sql([x[:4] for x in places()])} AS v(category, provider, place, raw_metric)),
pt AS (SELECT event_id, t.resource_id, t.category, t.provider, coalesce(pl.raw_metric, 'raw_' || t.feature) AS metric, t.ts, date_trunc('day', t.ts)::TIMESTAMP AS from_date, t.value,
              CASE event_id % 4 WHEN 2 THEN 'maximum' WHEN 3 THEN 'sum' ELSE 'average' END AS stat, CASE WHEN event_id % 4 = 2 THEN t.value END AS vmax, CASE WHEN event_id % 5 <> 0 THEN 0.5 END AS vmin, sample_count
       FROM t LEFT JOIN pl ON t.category = pl.category AND t.provider = pl.provider AND list_position(['click','error','purchase','signup','view'], t.feature) - 1 = pl.place)"""


@query(f"SELECT category, feature, provider, raw_metric, transform, CAST(precedence AS INTEGER) AS precedence, n FROM {values_sql(rules())} AS v(category, feature, provider, raw_metric, transform, precedence), (SELECT count(*) AS n FROM events) ")
def registry_rules(spark, d):
    n = catalog.Catalog(spark, d).read("events").agg(F.count("*").alias("n"))
    return normalize.rule_table(spark).withColumn("n", n.scalar())


@query(f"WITH {N_SQL} SELECT resource_id, category, provider, metric, ts, value, stat, vmax, vmin, sample_count FROM pt")
def explode_points(spark, d):
    return normalize.points(nested_documents(spark, d)).select("resource_id", "category", "provider", "metric", "ts", "value", "stat", "vmax", "vmin", "sample_count")


@query(f"WITH {N_SQL} SELECT stat, count(*) AS n, {r6('sum(value)')} AS total FROM pt GROUP BY stat")
def stat_priority(spark, d):
    return normalize.points(nested_documents(spark, d)).groupBy("stat").agg(F.count("*").alias("n"), C.r(F.sum("value")).alias("total"))


CONFLICT_SQL = f"""{N_SQL}, h AS (SELECT *, date_trunc('hour', ts)::TIMESTAMP AS hour FROM pt),
c AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY resource_id, category, provider, hour, metric ORDER BY (stat <> 'average'), event_id) = 1)"""


def hourly(spark, d):
    """Points brought to their hour, so that several readings meet in one slot; the point's own place breaks ties."""
    p = normalize.points(nested_documents(spark, d))
    t = A.telemetry(spark, d).select("resource_id", F.col("ts").alias("_ts"), F.col("event_id").alias("_event"))
    p = p.join(t, (p["resource_id"] == t["resource_id"]) & (p["ts"] == t["_ts"]) & (p["value"].isNotNull()), "left").drop(t["resource_id"])
    return p.withColumn("_id", F.col("_event")).withColumn("from_date", F.date_trunc("hour", "ts").cast("timestamp_ntz")).withColumn("ts", F.col("from_date")).drop("_ts", "_event")


@query(f"WITH {CONFLICT_SQL} SELECT resource_id, category, provider, hour AS ts, metric, value, stat FROM c")
def normalize_conflict(spark, d):
    return normalize.resolve_conflicts(hourly(spark, d)).select("resource_id", "category", "provider", "ts", "metric", "value", "stat")


CANON_SQL = f"""{CONFLICT_SQL}, k AS (SELECT c.resource_id, c.category, c.provider, c.hour AS ts, reg.feature, c.metric AS raw_metric, c.stat, CASE WHEN transform = 'inv' THEN 100 - value ELSE value END AS value
  FROM c JOIN reg ON c.category = reg.category AND c.provider = reg.provider AND c.metric = reg.raw_metric
  QUALIFY row_number() OVER (PARTITION BY c.resource_id, c.category, c.provider, c.hour, reg.feature ORDER BY precedence, metric) = 1)"""


def canonical_rows(spark, d):
    return normalize.canonical(normalize.resolve_conflicts(hourly(spark, d)), normalize.rule_table(spark))


@query(f"WITH {CANON_SQL} SELECT resource_id, category, provider, ts, feature, raw_metric, stat, {r6('value')} AS value FROM k")
def canonical_map(spark, d):
    return canonical_rows(spark, d).select("resource_id", "category", "provider", "ts", "feature", "raw_metric", "stat", C.r(F.col("value")).alias("value"))


@query(f"""WITH {CANON_SQL}, z AS (SELECT resource_id, category, provider, ts, feature, value FROM k UNION ALL
 SELECT resource_id, category, provider, ts, 'canonical_cpu_pct', 100 - value FROM k WHERE feature = 'canonical_cpu_idle_pct' AND NOT EXISTS (SELECT 1 FROM k q WHERE q.feature = 'canonical_cpu_pct' AND q.resource_id = k.resource_id AND q.category = k.category AND q.provider = k.provider AND q.ts = k.ts))
 SELECT resource_id, ts, feature, {r6('value')} AS value FROM z WHERE feature LIKE 'canonical_cpu%'""")
def cpu_from_idle(spark, d):
    long = canonical_rows(spark, d).select("resource_id", "category", "provider", "ts", "feature", "value")
    return normalize.cpu_from_idle(long).where("feature like 'canonical_cpu%'").select("resource_id", "ts", "feature", C.r(F.col("value")).alias("value"))


@query(f"SELECT DISTINCT component, category, {RTYPE_SQL} AS rtype FROM (WITH {A.T_SQL} SELECT * FROM t)")
def canonical_type(spark, d):
    return typed(spark, d).select("component", "category", "rtype").distinct()


SPELL = ["' networking '", "'Virtual_Machines'", "'MariaDB'", "'volumes'", "'Mainframe'"]


@query(f"""WITH e AS (SELECT user_id, (array[{', '.join(SPELL)}])[(user_id % 5 + 1)::INT] AS c, (array['Amazon', ' azure', 'Google Cloud', NULL])[(user_id % 4 + 1)::INT] AS p FROM events)
SELECT coalesce({sql_map(V.CATEGORY_ALIASES, 'lower(trim(c))')}, trim(c)) AS category, coalesce({sql_map(V.PROVIDER_ALIASES, 'lower(trim(p))')}, trim(p), 'unknown') AS provider, count(*) AS n FROM e GROUP BY 1, 2""")
def alias_normalize(spark, d):
    u = F.col("user_id")
    e = catalog.Catalog(spark, d).read("events").select(F.element_at(F.array(*[F.expr(s) for s in SPELL]), (u % 5 + 1).cast("int")).alias("c"), F.element_at(F.array(F.lit("Amazon"), F.lit(" azure"), F.lit("Google Cloud"), F.lit(None)), (u % 4 + 1).cast("int")).alias("p"))
    return e.groupBy(C.category(F.col("c")).alias("category"), C.provider(F.col("p")).alias("provider")).agg(F.count("*").alias("n"))


FEATURES = ["click", "error", "purchase", "signup", "view"]


@query(f"WITH {A.T_SQL}, h AS (SELECT resource_id, category, date_trunc('day', ts)::TIMESTAMP AS day, feature, max(value) AS value FROM t GROUP BY ALL) SELECT resource_id, category, day, " + ", ".join(f"max(value) FILTER (feature = '{f}') AS {f}" for f in FEATURES) + " FROM h GROUP BY ALL")
def wide_pivot(spark, d):
    h = A.telemetry(spark, d).groupBy("resource_id", "category", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "feature").agg(F.max("value").alias("value"))
    return normalize.wide(h, FEATURES, ["resource_id", "category", "day"])


GAP_SQL = f"""{A.T_SQL}, g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 / 3600 AS gap FROM t WINDOW w AS (PARTITION BY resource_id, category, feature ORDER BY ts, event_id)),
f AS (SELECT *, coalesce(gap > 2.5 * median(CASE WHEN gap > 0 THEN gap END) OVER (PARTITION BY resource_id, category, feature), false) AS gap_flag FROM g)"""


@query(f"WITH {GAP_SQL} SELECT event_id, resource_id, feature, {r6('gap')} AS gap_hours, gap_flag FROM f")
def gap_flags(spark, d):
    return normalize.gap_flags(A.telemetry(spark, d), SERIES).select("event_id", "resource_id", "feature", C.r(F.col("gap_hours")).alias("gap_hours"), "gap_flag")


SPARSE = "CASE WHEN sample_count < 40 THEN 0.0 ELSE value END"


@query(f"""WITH {GAP_SQL}, z AS (SELECT * REPLACE ({SPARSE} AS value), count(*) OVER (PARTITION BY resource_id, category) AS slots FROM f),
a AS (SELECT resource_id, category, feature, sum(CASE WHEN value = 0 THEN 1 ELSE 0 END) / any_value(slots) AS zf, 1 - count(value) / any_value(slots) AS nf, bool_or(gap_flag) AS g FROM z GROUP BY ALL)
SELECT resource_id, category, feature, {r6('zf')} AS zero_frac, {r6('nf')} AS null_frac, CASE WHEN zf > 0.8 THEN 'idle' WHEN g AND nf > 0.3 THEN 'missing' WHEN zf > 0.1 THEN 'sparse' ELSE 'ok' END AS state FROM a""")
def data_state(spark, d):
    slots = F.count("*").over(Window.partitionBy("resource_id", "category"))
    flagged = normalize.gap_flags(A.telemetry(spark, d), SERIES).withColumn("slots", slots).withColumn("value", F.expr(SPARSE))
    return normalize.data_state(flagged, SERIES).select(*SERIES, C.r(F.col("zero_frac")).alias("zero_frac"), C.r(F.col("null_frac")).alias("null_frac"), "state")


@query(f"WITH {N_SQL} SELECT resource_id, category, metric, count(DISTINCT stat) AS stats, count(DISTINCT stat) > 1 AS mixed FROM pt GROUP BY ALL")
def mixed_stats(spark, d):
    return normalize.mixed_stats(normalize.points(nested_documents(spark, d)), ["resource_id", "category", "metric"])


@query(f"WITH {N_SQL}, q AS (SELECT category, provider, metric, count(*) AS documents FROM pt GROUP BY ALL) SELECT q.*, EXISTS (SELECT 1 FROM reg WHERE reg.category = q.category AND reg.provider = q.provider AND reg.raw_metric = q.metric) AS mapped FROM q")
def inspect_coverage(spark, d):
    return normalize.coverage(normalize.points(nested_documents(spark, d)), normalize.rule_table(spark))


# ---------------------------------------------------------------- quality


@query(f"WITH {A.T_SQL}, n AS (SELECT max(ts) AS now FROM t), s AS (SELECT resource_id, max(ts) AS l FROM t GROUP BY 1) SELECT resource_id, round_even((epoch_us(now) - epoch_us(l)) / 1e6 / 60, 1) AS age_minutes FROM s, n WHERE round_even((epoch_us(now) - epoch_us(l)) / 1e6 / 60, 1) > 1440")
def stale_resources(spark, d):
    t = A.telemetry(spark, d)
    return quality.stale_resources(t, t.agg(F.max("ts").alias("now")), 1440)


@query(f"WITH {A.T_SQL} SELECT resource_id, round(CASE WHEN count(*) < 2 THEN 0 ELSE (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / 3600 END + 3.7e-8, 2)::DOUBLE AS hours, count(*) AS points FROM t GROUP BY 1")
def history_hours(spark, d):
    return quality.history_hours(A.telemetry(spark, d))


@query(f"WITH {A.T_SQL}, n AS (SELECT max(ts) AS now FROM t), s AS (SELECT resource_id, max(ts) AS l, min(ts) AS f, count(*) AS c FROM t GROUP BY 1) SELECT resource_id, round_even((epoch_us(now) - epoch_us(l)) / 1e6 / 60, 1) > 1440 AS stale, CASE WHEN c < 2 THEN 0 ELSE round((epoch_us(l) - epoch_us(f)) / 1e6 / 3600 + 3.7e-8, 2) END < 24 AS thin FROM s, n")
def quality_gate(spark, d):
    t = A.telemetry(spark, d)
    return quality.gate(t, t.agg(F.max("ts").alias("now")), 1440)


@query(f"WITH {A.T_SQL} SELECT category, feature, provider, min(value) AS least, max(value) AS most FROM t WHERE feature IN ('click', 'view', 'error') GROUP BY ALL HAVING max(value) > 150 OR min(value) < -5")
def validate_percent_ranges(spark, d):
    return quality.percent_ranges(A.telemetry(spark, d), ["click", "view", "error"])


# ---------------------------------------------------------------- profiles


@query(f"WITH {P_SQL} SELECT rtype, category, feature, count(value) AS n, {r6('avg(value)')} AS mean, {r6('stddev_pop(value)')} AS sd, {r6('quantile_cont(value, 0.05)')} AS p5, {r6('quantile_cont(value, 0.95)')} AS p95 FROM p GROUP BY ALL HAVING count(value) >= 5")
def profile_stats(spark, d):
    out = profiles.profile_stats(typed(spark, d))
    return out.select(*profiles.POOL, "n", *[C.r(F.col(c)).alias(c) for c in ("mean", "sd", "p5", "p95")])


DIURNAL_SQL = f"{P_SQL}, di AS (SELECT rtype, category, feature, (isodow(ts) - 1)::INT AS dow, hour(ts)::INT AS hod, median(value) AS expected, count(value) AS n FROM p GROUP BY ALL HAVING count(value) >= 2)"


@query(f"WITH {DIURNAL_SQL} SELECT rtype, category, feature, dow, hod, {r6('expected')} AS expected, n FROM di")
def diurnal_medians(spark, d):
    return profiles.diurnal(typed(spark, d)).withColumn("expected", C.r(F.col("expected")))


OWN_GAP = "SELECT resource_id, rtype, category, feature, event_id, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY resource_id, rtype, category, feature ORDER BY ts, event_id))) / 1e6 / 3600 AS gap FROM p"
CADENCE_SQL = f"{P_SQL}, og AS ({OWN_GAP}), o AS (SELECT resource_id, rtype, category, feature, median(gap) AS usual FROM og WHERE gap > 0 GROUP BY ALL), ca AS (SELECT rtype, category, feature, median(usual) AS cadence_hours, count(*) AS resources FROM o GROUP BY ALL)"


@query(f"WITH {CADENCE_SQL} SELECT rtype, category, feature, {r6('cadence_hours')} AS cadence_hours, resources FROM ca")
def cadence(spark, d):
    return profiles.cadence(typed(spark, d)).withColumn("cadence_hours", C.r(F.col("cadence_hours")))


@query(f"WITH {CADENCE_SQL} SELECT event_id, resource_id, feature, {r6('gap')} AS gap FROM og JOIN ca USING (rtype, category, feature) WHERE gap > 2.5 * cadence_hours")
def reporting_gaps(spark, d):
    p = typed(spark, d)
    return profiles.reporting_gap(p, profiles.cadence(p)).select("event_id", "resource_id", "feature", C.r(F.col("gap")).alias("gap"))


@query(f"""WITH {P_SQL}, e AS (SELECT rtype, category, feature, max(ts) AS l, min(ts) AS f, avg(value) AS m, stddev_pop(value) AS sd FROM p GROUP BY ALL),
n AS (SELECT p.rtype, p.category, p.feature, count(value) AS rn, avg(value) AS rm FROM p JOIN e ON p.rtype = e.rtype AND p.category = e.category AND p.feature = e.feature WHERE p.ts >= l - INTERVAL 3 DAY GROUP BY ALL)
SELECT rtype, category, feature, rn AS recent_n, {r6('rm')} AS recent_mean, {r6('m')} AS mean, ((epoch_us(l) - epoch_us(f)) / 1e6 / 3600 >= 408 AND sd > 0 AND rn >= 3 AND abs(rm - m) > 2.5 * sd) AS shifted FROM e JOIN n USING (rtype, category, feature)""")
def regime_shift(spark, d):
    return profiles.regime_shift(typed(spark, d)).withColumn("recent_mean", C.r(F.col("recent_mean"))).withColumn("mean", C.r(F.col("mean")))


@query(f"WITH {P_SQL}, e AS (SELECT rtype, category, feature, floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / 3600 / 24)::BIGINT AS days, count(DISTINCT resource_id) AS resources FROM p GROUP BY ALL) SELECT *, round(0.6 * least(1.0, days / 14) + 0.4 * least(1.0, resources / 5) + 3.7e-8, 3)::DOUBLE AS confidence FROM e")
def profile_confidence(spark, d):
    return profiles.profile_confidence(typed(spark, d))


SLOPE_SQL = f"""{P_SQL}, x AS (SELECT *, (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY resource_id, rtype, category, feature))) / 1e6 / 3600 AS x FROM p),
sl AS (SELECT resource_id, rtype, category, feature, count(value) AS n, CASE WHEN max(value) - min(value) < 1e-9 OR max(x) - min(x) < 1e-9 THEN 0.0 ELSE regr_slope(value, x) / (max(value) - min(value)) END AS norm_slope FROM x GROUP BY ALL)"""


@query(f"WITH {SLOPE_SQL} SELECT rtype, category, feature, {r6('median(norm_slope)')} AS prior, count(*) AS pool FROM sl WHERE n >= 5 GROUP BY ALL")
def slope_priors(spark, d):
    return profiles.slope_priors(typed(spark, d)).withColumn("prior", C.r(F.col("prior")))


@query(f"WITH {SLOPE_SQL}, la AS (SELECT resource_id, rtype, category, feature, arg_max(value, (ts, event_id)) AS latest FROM p GROUP BY ALL) SELECT resource_id, rtype, category, feature, n, {r6('norm_slope')} AS norm_slope, latest FROM sl JOIN la USING (resource_id, rtype, category, feature) WHERE n >= 20")
def slope_prior_table(spark, d):
    return profiles.slope_training_table(typed(spark, d)).withColumn("norm_slope", C.r(F.col("norm_slope")))


# ---------------------------------------------------------------- anomaly

RES_SQL = f"""{DIURNAL_SQL}, ps AS (SELECT rtype, category, feature, count(value) AS n, avg(value) AS mean, stddev_pop(value) AS sd FROM p GROUP BY ALL HAVING count(value) >= 5),
res AS (SELECT p.*, ps.mean, ps.sd, di.expected, p.value - coalesce(di.expected, ps.mean) AS residual FROM p JOIN ps USING (rtype, category, feature)
        LEFT JOIN di ON p.rtype = di.rtype AND p.category = di.category AND p.feature = di.feature AND isodow(p.ts) - 1 = di.dow AND hour(p.ts) = di.hod)"""
Z_SQL = f"""{RES_SQL}, zc AS (SELECT *, count(*) OVER (PARTITION BY resource_id, category) AS rows FROM res),
z AS (SELECT resource_id, category, ts, CASE WHEN max(rows) >= 12 THEN least(1.0, coalesce(max(CASE WHEN sd > 0 THEN abs(residual) / sd END), 0) / 3.42) ELSE 0.0 END AS z_signal FROM zc GROUP BY ALL),
b AS (SELECT resource_id, category, ts, least(1.0, (least(50.0, greatest(1.0, coalesce(max(CASE WHEN value <> 0 THEN vmax / value END), 1.0))) - 1) / 4) AS burst_signal FROM p GROUP BY ALL)"""


@query(f"WITH {RES_SQL} SELECT event_id, resource_id, feature, {r6('residual')} AS residual FROM res")
def diurnal_residuals(spark, d):
    return anomaly.residuals(typed(spark, d)).select("event_id", "resource_id", "feature", C.r(F.col("residual")).alias("residual"))


W168 = "(PARTITION BY resource_id, rtype, category, feature ORDER BY ts, event_id ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)"


@query(f"WITH {P_SQL} SELECT event_id, resource_id, feature, {r6(f'CASE WHEN count(value) OVER {W168} >= 6 THEN avg(value) OVER {W168} ELSE avg(value) OVER (PARTITION BY resource_id, rtype, category, feature) END')} AS baseline FROM p")
def rolling_baseline(spark, d):
    return anomaly.rolling_baseline(typed(spark, d)).select("event_id", "resource_id", "feature", C.r(F.col("baseline")).alias("baseline"))


@query(f"WITH {RES_SQL}, rs AS (SELECT *, CASE WHEN count(residual) OVER {W168} >= 6 THEN stddev_samp(residual) OVER {W168} END AS s FROM res) SELECT resource_id, rtype, category, feature, {r6('median(s)')} AS sigma FROM rs GROUP BY ALL")
def rolling_std_median(spark, d):
    return anomaly.rolling_deviation(anomaly.residuals(typed(spark, d))).withColumn("sigma", C.r(F.col("sigma")))


@query(f"WITH {Z_SQL} SELECT resource_id, category, ts, {r6('z_signal')} AS z_signal FROM z")
def zscore_signal(spark, d):
    return anomaly.zscore_signal(anomaly.residuals(typed(spark, d))).withColumn("z_signal", C.r(F.col("z_signal")))


@query(f"WITH {Z_SQL} SELECT resource_id, category, ts, {r6('burst_signal')} AS burst_signal FROM b")
def burst_signal(spark, d):
    return anomaly.burst_signal(typed(spark, d)).withColumn("burst_signal", C.r(F.col("burst_signal")))


SCORE_SQL = f"""{Z_SQL}, sc AS (SELECT resource_id, category, ts, z_signal, burst_signal, least(1.0, greatest(0.0, (0.45 + 0.7 * 0.35) * z_signal + (0.20 + 0.3 * 0.35) * burst_signal)) AS score, z_signal > 0.5 OR burst_signal > 0.6 AS dominant FROM z JOIN b USING (resource_id, category, ts))"""


@query(f"WITH {SCORE_SQL} SELECT resource_id, category, ts, {r6('score')} AS score, dominant, concat_ws(',', CASE WHEN z_signal > 0.4 THEN 'z' END, CASE WHEN burst_signal > 0.4 THEN 'burst' END) AS drivers FROM sc")
def composite_no_forest(spark, d):
    return anomaly.scored(typed(spark, d)).select("resource_id", "category", "ts", C.r(F.col("score")).alias("score"), "dominant", F.array_join("drivers", ",").alias("drivers"))


@query()
def isolation_forest(spark, d):
    out = anomaly.scored(typed(spark, d), with_forest=True)
    return out.select("resource_id", "category", "ts", C.r(F.col("score")).alias("score"), C.r(F.col("forest_signal")).alias("forest_signal"), "dominant")
