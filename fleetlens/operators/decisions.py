"""Alerts, suppression, incidents, thresholds, breaches, feedback and accuracy."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import vocabulary as V
from fleetlens.operators import intervals, serve

#: Fixed values: (category, feature, operator, limit, points) of weak risk labels; 50 points make a label.
RISK_POINTS = [
    ("Compute", "canonical_cpu_pct", ">=", 80, 35), ("Compute", "canonical_mem_used_pct", ">=", 85, 30), ("Compute", "canonical_iowait_pct", ">=", 20, 20), ("Compute", "status_check_failed", ">", 0, 30), ("Compute", "lambda_throttles", ">", 0, 20), ("Compute", "cpu_credit_balance", "<", 20, 15),
    ("Network", "canonical_ddos_signal", ">", 0, 45), ("Network", "canonical_health_pct", "<", 90, 35), ("Network", "canonical_subnet_util_pct", ">=", 80, 30), ("Network", "canonical_active_connections", ">", 10000, 15),
    ("Storage", "canonical_storage_used_pct", ">=", 80, 35), ("Storage", "canonical_burst_balance_pct", "<", 20, 30), ("Storage", "canonical_queue_depth", ">", 10, 25), ("Storage", "availability_pct", "<", 99, 25), ("Storage", "backup_health_event", ">", 0, 20),
]

def compare(value: Column, op: Column | str, limit: Column) -> Column:
    """A comparison named by a word or sign; null is false."""
    names = {">": ("gt", ">"), ">=": ("gte", ">="), "<": ("lt", "<"), "<=": ("lte", "<=")}
    op = F.lit(op) if isinstance(op, str) else op
    tests = {">": value > limit, ">=": value >= limit, "<": value < limit, "<=": value <= limit}
    out = F.lit(False)
    for sign, test in tests.items():
        out = F.when(op.isin(*names[sign]), test).otherwise(out)
    return C.is_true(out)


def fired(category: Column, feature: Column, value: Column, rules: list[tuple]) -> Column:
    """What the rules of a category and feature say about a value, in rule order (M-1)."""
    tests = [F.when((category == c) & (feature == f) & compare(value, op, F.lit(limit)), F.lit(what)) for c, f, op, limit, what in rules]
    return F.filter(F.array(*tests), lambda x: x.isNotNull())


def risk_labels(latest: DataFrame) -> DataFrame:
    """M-1: points by category rules over a resource's values, and whether any value lies 2.5 deviations above its mean."""
    points = F.aggregate(fired(F.col("category"), F.col("feature"), F.col("value"), RISK_POINTS), F.lit(0), lambda a, x: a + x.cast("int"))
    high = C.is_true((F.col("sd") > 0) & ((F.col("value") - F.col("mean")) / F.col("sd") > 2.5))
    out = latest.withColumn("p", points).withColumn("high", high).groupBy("resource_id", "category").agg(F.sum("p").cast("long").alias("points"), F.max("high").alias("outlier"))
    return out.withColumn("label", ((F.col("points") >= 50) | F.col("outlier")).cast("int"))


def alert_gate(predictions: DataFrame) -> DataFrame:
    """D-2, X-9: severity, badge, channel and trigger from score (0 to 1) and dominance."""
    risk = F.round(100 * F.col("score") + F.lit(3.7e-8), 2)
    x = predictions.withColumn("risk", risk).withColumn("is_anomalous", (F.col("score") >= 0.6) | F.col("dominant")).withColumn("severity", C.severity(F.col("risk")))
    trigger = (F.col("risk") >= 40) | F.col("dominant")
    return x.withColumn("badge", C.badge(F.col("risk"))).withColumn("channel", C.channel(F.col("severity"))).withColumn("trigger", trigger & (F.col("severity") != "INFO"))


def suppress(predictions: DataFrame, windows: DataFrame) -> DataFrame:
    """J-6, D-7: predictions in a maintenance window (resource or *, category or *, tags where the window names some, time)
    become INFO without a trigger; of several windows the first in order is named. Windows for one resource are found by an
    equi-join on it, wildcard ones by the cells of time they cover (intervals.held). A null resource or category is a
    wildcard."""
    every = lambda c: F.coalesce(F.col(c), F.lit("*"))
    tagged = "tags" in windows.columns and "tags" in predictions.columns
    inside = F.col("ts").between(F.col("starts_at"), F.col("ends_at")) & ((F.col("w_category") == "*") | (F.col("w_category") == F.col("category")))
    if tagged:
        inside = inside & (F.col("w_tags").isNull() | serve.tag_match(F.col("tags"), F.col("w_tags")))
    w = windows.select("window_id", every("resource_id").alias("w_resource"), every("category").alias("w_category"), "starts_at", "ends_at", "reason", *[F.col("tags").alias("w_tags")] * tagged)
    keys = predictions.select("prediction_id", "resource_id", "category", "ts", *["tags"] * tagged)
    named = keys.join(w.where("w_resource <> '*'"), F.col("resource_id") == F.col("w_resource")).where(inside)
    wild = intervals.held(keys, w.where("w_resource = '*'"), "ts", "starts_at", "ends_at", F.col("prediction_id")).where(inside)
    hit = named.select("prediction_id", "window_id", "reason").union(wild.select("prediction_id", "window_id", "reason")).groupBy("prediction_id").agg(F.min_by("reason", "window_id").alias("reason"))
    out = predictions.join(hit, "prediction_id", "left").withColumn("suppressed", F.col("reason").isNotNull())
    return out.withColumn("severity", F.when(F.col("suppressed"), "INFO").otherwise(F.col("severity"))).withColumn("trigger", F.col("trigger") & ~F.col("suppressed"))


def fleet_anomalies(predictions: DataFrame, size: int = 5, share: float = 0.30) -> DataFrame:
    """A-13: groups of provider, location and category with enough anomalous resources."""
    bad = F.when(F.col("is_anomalous"), F.col("resource_id"))
    out = predictions.groupBy("provider", "location", "category").agg(F.count_distinct("resource_id").alias("resources"), F.count_distinct(bad).alias("anomalous"), F.count("*").alias("predictions"), F.array_sort(F.collect_set(bad)).alias("ids"))
    return out.where((F.col("resources") >= size) & (F.col("anomalous") / F.col("resources") >= share))


def composite_incidents(predictions: DataFrame, least: int = 2) -> DataFrame:
    """A-14: projects anomalous in several categories."""
    bad = predictions.where("is_anomalous")
    out = bad.groupBy(F.coalesce("project", "account_id").alias("scope")).agg(F.array_sort(F.collect_set("category")).alias("categories"), F.count_distinct("resource_id").alias("resources"), F.max("risk").alias("risk"))
    cause = F.lit("several domains at once")
    for a, b in reversed(V.COMPOSITE_CAUSES):
        cause = F.when(F.size(F.array_except(F.array(F.lit(a), F.lit(b)), "categories")) == 0, f"{a} with {b}").otherwise(cause)
    return out.where(F.size("categories") >= least).withColumn("severity", F.when(F.col("risk") >= 75, "CRITICAL").otherwise("HIGH")).withColumn("cause", cause)


# ---------------------------------------------------------------- thresholds


def breaches(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """J-8, D-11: readings (resource_id, metric_name, value, ts) that break their rule, under an idempotent key."""
    x = readings.join(rules, ["resource_id", "metric_name"])
    return x.where(compare(F.col("value"), F.col("operator"), F.col("limit"))).withColumn("event_key", C.hash_key(F.col("resource_id"), F.col("metric_name"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))


def breach_state(log: DataFrame) -> DataFrame:
    """A-17."""
    return log.groupBy("resource_id", "metric_name").agg(F.count_distinct("event_key").alias("breaches"), F.max("ts").alias("last_breach"))


def append_new(log: DataFrame, events: DataFrame) -> DataFrame:
    """D-11: events whose key the log lacks, for an append that may be repeated."""
    return events.join(log.select("event_key"), "event_key", "left_anti").dropDuplicates(["event_key"])


def next_breach(points: DataFrame, keys: list[str]) -> DataFrame:
    """W-12: first crossing between consecutive points (hours, value) of a forecast, interpolated; 0 if there already."""
    over = compare(F.col("value"), F.col("operator"), F.col("limit"))
    w = Window.partitionBy(*keys).orderBy("hours")
    x = points.withColumn("over", over).withColumn("before", F.lag("over").over(w)).withColumn("v1", F.lag("value").over(w)).withColumn("h1", F.lag("hours").over(w))
    frac = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("limit") - F.col("v1")) / (F.col("value") - F.col("v1"))))
    eta = F.when(F.col("over") & F.col("before").isNull(), 0.0).when(F.col("over") & ~F.col("before") & (F.col("value") != F.col("v1")), F.col("h1") + frac * (F.col("hours") - F.col("h1")))
    return x.withColumn("eta", eta).groupBy(*keys).agg(F.min("eta").alias("eta_hours"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """K-1: old with new's rows in place of those of the same key; of several new rows of a key the newest. Formats with
    MERGE can do it in place; on plain parquet the result replaces the snapshot."""
    rest = [c for c in new.columns if c not in keys]
    last = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("x")).select(*keys, "x.*")
    return old.join(last, keys, "left_anti").unionByName(last)


# ---------------------------------------------------------------- feedback and accuracy


def feedback_labels(predictions: DataFrame, incidents: DataFrame, now: DataFrame, hit_hours: float = 6, miss_hours: float = 24) -> DataFrame:
    """J-5, D-9: TP if an incident of the resource opens within the hours, FP once old enough without one, else unknown. The
    join is on resource and stretch of time, so a resource with very many rows is no square."""
    stretch = lambda ts: F.floor(C.seconds(ts) / (3600 * hit_hours))
    i = incidents.select(F.col("resource_id").alias("i_resource"), "opened_at", stretch(F.col("opened_at")).alias("i_stretch"))
    seen = predictions.withColumn("stretch", F.explode(F.array(stretch(F.col("ts")), stretch(F.col("ts")) + 1)))
    window = (F.col("resource_id") == F.col("i_resource")) & (F.col("stretch") == F.col("i_stretch")) & (F.col("opened_at") >= F.col("ts")) & (F.col("opened_at") <= F.col("ts") + F.make_dt_interval(hours=F.lit(int(hit_hours))))
    first = seen.join(i, window).groupBy("prediction_id").agg(F.min("opened_at").alias("outcome_at"))
    out = predictions.join(first, "prediction_id", "left")
    age = C.hours_between(F.col("ts"), now.scalar())
    return out.withColumn("label", F.when(F.col("outcome_at").isNotNull(), "TP").when(age >= miss_hours, "FP").otherwise("unknown"))


def feedback_metrics(labels: DataFrame) -> DataFrame:
    """A-15."""
    tp, fp = F.sum((F.col("label") == "TP").cast("long")), F.sum((F.col("label") == "FP").cast("long"))
    return labels.groupBy("category").agg(tp.alias("tp"), fp.alias("fp"), F.count("*").alias("n"), C.r(tp / F.greatest(F.lit(1), tp + fp)).alias("precision"))


def forecast_accuracy(pairs: DataFrame) -> DataFrame:
    """A-16: errors of (reliability, forecast, lower, upper, actual, start), overall (reliability null) and by it."""
    e = F.col("actual") - F.col("forecast")
    aggs = {
        "n": F.count("*"), "mae": C.r(F.avg(F.abs(e))), "rmse": C.r(F.sqrt(F.avg(e * e))), "mape": C.r(F.avg(F.when(F.col("actual") != 0, F.abs(e / F.col("actual")) * 100))),
        "coverage": C.r(F.avg(F.col("actual").between(F.col("lower"), F.col("upper")).cast("double"))), "bias": C.r(F.avg(-e)),
        "direction": C.r(F.avg((F.signum(F.col("actual") - F.col("start")) == F.signum(F.col("forecast") - F.col("start"))).cast("double"))),
    }
    return pairs.rollup("reliability").agg(*[v.alias(k) for k, v in aggs.items()])


def tolerance_join(forecasts: DataFrame, actuals: DataFrame, horizon_hours: float) -> DataFrame:
    """J-7: forecast rows and readings of the same series about a horizon apart; all that fit are kept. The join is on
    series and stretch of time as wide as the tolerance on both sides."""
    tolerance = max(6.0, horizon_hours / 2)
    stretch = lambda ts, hours=0.0: F.floor((C.seconds(ts) / 3600 + hours) / (2 * tolerance))
    a = actuals.select("resource_id", "feature", F.col("ts").alias("actual_ts"), F.col("value").alias("actual"), stretch(F.col("ts")).alias("_stretch"))
    first = stretch(F.col("ts"), horizon_hours - tolerance)
    forecasts = forecasts.withColumn("_stretch", F.explode(F.array(first, first + 1)))
    apart = C.hours_between(F.col("ts"), F.col("actual_ts"))
    return forecasts.join(a, ["resource_id", "feature", "_stretch"]).where(apart.between(horizon_hours - tolerance, horizon_hours + tolerance)).drop("_stretch")
