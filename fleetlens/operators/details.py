"""Smaller operators: payloads, texts, cards, availability, authorisation, folds, trims and metric metadata."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import series as S

#: For each category the limits whose breach its payload projects, by feature.
PAYLOAD_LIMITS = {"Compute": {"canonical_cpu_pct": [80, 90]}, "Network": {"canonical_active_connections": [10000, 25000], "canonical_subnet_util_pct": [80, 90]}, "Storage": {"canonical_storage_used_pct": [80, 90, 95]}}


def payload(category: Column, feature: Column, value: Column, risk: Column) -> Column:
    """D-3: what a category's card shows beside the common fields: memory class and chance of running out, wait flag,
    attack chance, burst risk. A map, since its keys depend on the category."""
    memory = F.when(value >= 90, "CRITICAL").when(value >= 75, "WARNING").otherwise("OK")
    is_ = lambda c, f: (category == c) & (feature == f)
    text = lambda x: F.round(x, 4).cast("string")
    return (
        F.when(is_("Compute", "canonical_mem_used_pct"), F.create_map(F.lit("memory_class"), memory, F.lit("oom_probability"), text(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (value - 70) / 30)))))
        .when(is_("Compute", "canonical_iowait_pct"), F.create_map(F.lit("iowait"), (value >= 20).cast("string")))
        .when(is_("Network", "canonical_ddos_signal"), F.create_map(F.lit("ddos_probability"), text(F.least(F.lit(1.0), 0.8 * F.least(F.lit(1.0), value) + risk / 500))))
        .when(is_("Storage", "canonical_burst_balance_pct"), F.create_map(F.lit("burst_risk"), text(F.greatest(F.lit(0.0), (30 - value) / 30))))
        .otherwise(F.create_map().cast("map<string,string>"))
    )


def prediction_type(score: Column, trend: Column) -> Column:
    """D-6: what a prediction is about."""
    return F.when(score >= 0.6, "anomaly").when(trend == "increasing", "growth").when(trend == "decreasing", "decline").otherwise("steady")


def summary(resource: Column, feature: Column, value: Column, severity: Column, trend: Column) -> Column:
    """D-6: one line for a card."""
    return F.concat_ws(", ", F.concat(resource, F.lit(" is "), F.lower(severity)), F.concat(F.regexp_replace(feature, "^canonical_", ""), F.lit(" at "), C.format_value(feature, value)), F.concat(F.lit("trend "), trend))


def card(rows: DataFrame) -> DataFrame:
    """P-17: the flat fields a list view shows."""
    return rows.select("prediction_id", "resource_id", "category", F.col("feature").alias("metric"), "risk", "severity", "badge", F.coalesce("project", F.lit("UNASSIGNED")).alias("project"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("at"))


def availability(rows: DataFrame, features: list[str]) -> DataFrame:
    """P-16: which features a resource reports, and the share of them, rounded to 3."""
    has = [F.max((F.col("feature") == f).cast("int")).alias(f) for f in features]
    out = rows.groupBy("resource_id", "category").agg(*has)
    total = sum((F.col(f) for f in features), F.lit(0))
    return out.withColumn("completeness", F.bround(total / len(features), 3))


def authorised(rows: DataFrame, account: str, project: str) -> DataFrame:
    """F-14: rows of a project if the account's first project is that one, none otherwise."""
    first = rows.where(F.col("account_id") == account).agg(F.min_by("project", F.struct("ts", "event_id")).alias("_allowed"))
    return rows.where(F.col("project") == project).join(F.broadcast(first), F.col("_allowed") == F.col("project"), "left_semi")  # one row


def fold_points(counts: DataFrame) -> DataFrame:
    """W-8: for series of n points the starts of up to four expanding folds."""
    k = F.least(F.lit(S.MOST_HOLDOUT), F.greatest(F.lit(S.LEAST_HOLDOUT), F.rint(F.col("n") * S.HOLDOUT).cast("int")))
    x = counts.withColumn("k", k).where(F.col("n") - F.col("k") >= S.LEAST_TRAIN)
    out = x.select("*", F.explode(F.sequence(F.lit(1), F.lit(S.FOLDS))).alias("back")).withColumn("start", (F.col("n") - F.col("back") * F.col("k")).cast("long"))
    return out.where((F.col("start") >= S.LEAST_TRAIN) | (F.col("back") == 1)).drop("back", "k")


def trimmed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """W-13: trailing zeros of series with 20 to 80 percent zeros and five other values go."""
    w = Window.partitionBy(*keys)
    k = rows.withColumn("k", F.row_number().over(w.orderBy("ts", "event_id")))
    x = k.withColumn("zeros", F.avg((F.col("value") == 0).cast("double")).over(w)).withColumn("real", F.sum((F.col("value") != 0).cast("int")).over(w)).withColumn("last", F.max(F.when(F.col("value") != 0, F.col("k"))).over(w))
    cut = (F.col("zeros") <= 0.8) & (F.col("zeros") > 0.2) & (F.col("real") >= 5)
    return x.where(~cut | (F.col("k") <= F.col("last"))).drop("k", "zeros", "real", "last")


def quality_score(mase: Column, coverage: Column) -> Column:
    """T-18 as a column."""
    a = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 - 50 * mase)), F.lit(50.0))
    b = F.when(coverage.isNull(), 50.0).when(coverage.between(60, 95), 100.0).when(coverage > 95, F.greatest(F.lit(0.0), 100 - 4 * (coverage - 95))).otherwise(coverage / 0.6)
    return 0.7 * a + 0.3 * b


def display_name(feature: Column) -> Column:
    """X-11: words for a feature: no prefix, unit suffixes spelled out, capitals."""
    out = F.regexp_replace(feature, "^canonical_", "")
    for suffix, word in (("_pct$", " percent"), ("_ms$", " milliseconds"), ("_iops$", " operations"), ("_", " ")):
        out = F.regexp_replace(out, suffix, word)
    return F.initcap(out)


def metric_unit(feature: Column) -> Column:
    """X-11."""
    return F.when(feature.endswith("_pct"), "%").when(feature.endswith("_bytes"), "bytes").when(feature.endswith("_ms"), "ms").when(feature.endswith("_iops"), "ops/s").otherwise("count")


def top_dominant(rows: DataFrame, most: int = 6) -> DataFrame:
    """O-7: a resource's features by severity and risk, the first `most`."""
    rank = F.create_map(F.lit("CRITICAL"), F.lit(0), F.lit("HIGH"), F.lit(1), F.lit("WARNING"), F.lit(2), F.lit("INFO"), F.lit(3))
    entry = F.struct(rank[F.col("severity")].alias("s"), (-F.col("risk")).alias("r"), F.col("feature").alias("feature"))
    got = rows.groupBy("resource_id").agg(F.sort_array(F.collect_list(entry)).alias("a"))  # one entry per metric of a resource
    return got.select("resource_id", F.array_join(F.transform(F.slice("a", 1, most), lambda x: x.feature), ",").alias("dominant"))


def label_stats(rows: DataFrame) -> DataFrame:
    """A-11."""
    return rows.groupBy("category", "feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))


def stale_feedback(labels: DataFrame, now: DataFrame, days: float = 2) -> DataFrame:
    """A-27: categories whose newest outcome is older than some days."""
    out = labels.groupBy("category").agg(F.max("outcome_at").alias("newest"))
    return out.select("category", "newest", C.is_true((C.hours_between(F.col("newest"), now.scalar()) > 24 * days) | F.col("newest").isNull()).alias("stale"))
