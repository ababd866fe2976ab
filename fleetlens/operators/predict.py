"""Predictions with their forecast: feature choice, failures, advice, payloads, incremental runs, sinks and rules."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import forecast

#: The feature that is forecast for each category.
PRIMARY = {
    "Compute": "canonical_cpu_pct", "Network": "canonical_active_connections", "Storage": "canonical_storage_used_pct", "Container": "canonical_node_cpu_pct",
    "Databases": "canonical_db_cpu_pct", "Governance": "canonical_runs_failed", "Security": "canonical_api_hit",
}
#: What is tried instead, in order; other categories go by the registry's order.
FALLBACK = {
    "Network": ["canonical_active_connections", "canonical_health_pct", "canonical_subnet_util_pct", "canonical_dns_queries", "canonical_throughput", "canonical_flow_log_count", "canonical_net_in_bytes", "canonical_net_out_bytes", "canonical_ddos_signal", "canonical_health_status", "canonical_probe_failure_count"],
    "Storage": ["canonical_storage_used_pct", "canonical_burst_balance_pct", "availability_pct", "canonical_queue_depth", "canonical_storage_capacity_raw", "canonical_storage_read_bytes", "canonical_storage_write_bytes", "canonical_storage_read_iops", "canonical_storage_write_iops", "canonical_storage_latency_ms", "canonical_storage_transactions", "canonical_volume_idle_time", "canonical_permitted_throughput", "canonical_credit_balance_raw", "backup_health_event"],
}


def now_map(rows: DataFrame) -> DataFrame:
    """resource_id, category and now: the newest value of each metric the resource reports (as many as the registry has)."""
    newest = rows.where("value is not null").groupBy("resource_id", "category", "metric").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))
    return newest.groupBy("resource_id", "category").agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("now"))


def forecast_feature(category: Column, now: Column, order: dict[str, list[str]]) -> Column:
    """P-13, P-14: the primary feature if the resource reports it, else the first of the category's order that it does,
    else the primary one. order: the registry's features of each category."""
    has = lambda f: F.map_contains_key(now, F.lit(f))
    out = F.lit(None).cast("string")
    for name, first in PRIMARY.items():
        tried = [F.when(has(f), F.lit(f)) for f in [first, *FALLBACK.get(name, order.get(name, []))]]
        out = F.when(category == name, F.coalesce(*tried, F.lit(first))).otherwise(out)
    return out


def lines(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, current, trend, reliability and the line's values 1, 6, 24 and 168 hours after the last reading."""
    x = forecast.with_hours(rows, keys).groupBy(*keys).agg(F.max("x").alias("last_x"), F.regr_r2("value", "x").alias("r2"))
    out = forecast.ols(rows, keys).join(x, keys).join(forecast.naive_last(rows, keys).withColumnRenamed("last", "current"), keys).join(forecast.drift_halves(rows, keys), keys)
    at = lambda h: F.col("intercept") + F.col("slope") * (F.col("last_x") + h)
    reliability = F.when(F.col("r2") >= 0.65, "high").when(F.col("r2") >= 0.25, "moderate").otherwise("low")
    return out.select(*keys, "current", "trend", reliability.alias("reliability"), at(1).alias("f_1h"), at(6).alias("f_6h"), at(24).alias("f_24h"), at(168).alias("f_7d"))


def failures(category: Column, feature: Column, now: Column, f_1h: Column, f_6h: Column) -> Column:
    """D-4: an array of (failure, metric, threshold, span, predicted): forecasts of the feature at hand and present values
    against their limits, in rule order. Names of failures and of what is measured now are fixed values."""
    kind = "struct<failure:string,metric:string,threshold:double,span:string,predicted:double>"

    def item(name, metric, limit, span, value, test=None):
        hit = C.is_true(value >= limit if test is None else test)
        return F.when(hit, F.struct(F.lit(name).alias("failure"), metric.alias("metric"), F.lit(float(limit)).alias("threshold"), F.lit(span).alias("span"), C.r(value, 3).alias("predicted")))

    got = lambda m: now[m]
    is_ = lambda f: feature == f
    soon = lambda name, limit, span, value, f: F.when(is_(f), item(name, feature, limit, span, value))
    here = lambda name, shown_as, limit, m, test=None: item(name, F.lit(shown_as), limit, "current", got(m), test)
    rules = {
        "Compute": [
            soon("CPU_80_PERCENT_BREACH", 80, "1h", f_1h, "canonical_cpu_pct"), soon("CPU_90_PERCENT_BREACH", 90, "6h", f_6h, "canonical_cpu_pct"),
            here("MEMORY_PRESSURE", "memory_used_percent", 85, "canonical_mem_used_pct"), here("INSTANCE_HEALTH_CHECK_FAILURE", "StatusCheckFailed", 1, "status_check_failed"),
        ],
        "Network": [
            soon("CONNECTION_SATURATION", 10000, "1h", f_1h, "canonical_active_connections"),
            here("SUBNET_CAPACITY_RISK", "subnet_utilization_percent", 80, "canonical_subnet_util_pct"), here("DDOS_SIGNAL_DETECTED", "ddos_signal", 1, "canonical_ddos_signal"),
        ],
        "Storage": [
            soon("STORAGE_80_PERCENT_BREACH", 80, "1h", f_1h, "canonical_storage_used_pct"), soon("STORAGE_90_PERCENT_BREACH", 90, "6h", f_6h, "canonical_storage_used_pct"),
            here("BURST_CREDIT_EXHAUSTION", "burst_balance_percent", 20, "canonical_burst_balance_pct", got("canonical_burst_balance_pct") < 20),
        ],
    }
    out = F.array().cast(f"array<{kind}>")
    for name, items in rules.items():
        out = F.when(category == name, F.filter(F.array(*items), lambda x: x.isNotNull())).otherwise(out)
    return out


def advice(category: Column, feature: Column, now: Column, line: dict[str, Column], score: Column) -> Column:
    """D-5: keys of what is advised, in rule order. line: current, trend, reliability, f_24h and f_7d of the feature."""
    v = lambda m: now[m]
    rising = (line["trend"] == "increasing") & line["reliability"].isin("high", "moderate")
    tests = {
        "Compute": [
            ("scale_up", (feature == "canonical_cpu_pct") & (line["current"] >= 80)), ("scale_down", (feature == "canonical_cpu_pct") & (line["current"] < 25) & (line["trend"] != "increasing")),
            ("add_memory", v("canonical_mem_used_pct") >= 85), ("leave_burstable", v("cpu_credit_balance") < 20), ("cpu_trending_up", rising & (line["f_24h"] > 80)),
        ],
        "Network": [("mitigate_ddos", v("canonical_ddos_signal") > 0), ("repair_targets", v("canonical_health_pct") < 90), ("extend_subnet", v("canonical_subnet_util_pct") >= 80)],
        "Storage": [
            ("add_capacity", (feature == "canonical_storage_used_pct") & (line["current"] >= 80)), ("provision_throughput", v("canonical_burst_balance_pct") < 20),
            ("check_backup", v("backup_health_event") > 0), ("storage_trending_up", rising & (line["f_7d"] >= 80)),
        ],
        "Container": [("add_nodes", v("canonical_node_cpu_pct") >= 85), ("add_node_memory", v("canonical_node_mem_pct") >= 85), ("free_capacity", v("canonical_unschedulable_pods") > 0), ("throttle_clients", v("canonical_api_inflight_requests") > 400)],
        "Databases": [("tune_or_scale", v("canonical_db_cpu_pct") >= 80), ("extend_storage", v("canonical_db_storage_pct") >= 85), ("pool_connections", v("canonical_db_connections") >= 90), ("db_cpu_trending_up", rising & (line["f_24h"] > 85))],
        "Governance": [("check_runs", v("canonical_runs_failed") > 0), ("check_sources", v("canonical_run_failure_pct") >= 50), ("back_off", v("canonical_throttled_requests") > 0), ("check_scaling", v("canonical_status_check_failed") > 0)],
        "Security": [("spread_vaults", v("canonical_saturation") >= 75), ("check_vault", v("canonical_availability_pct") < 99), ("check_network_path", v("canonical_api_latency_ms") > 500)],
    }
    out = F.array().cast("array<string>")
    for name, items in tests.items():
        out = F.when(category == name, F.array(*[F.when(C.is_true(t), F.lit(k)) for k, t in items])).otherwise(out)
    return F.filter(F.concat(out, F.array(F.when(C.is_true(score >= 0.6), F.lit("investigate_change")))), lambda x: x.isNotNull())


#: What the payloads of categories show as it is.
SHOWN = {
    "Container": ["canonical_node_cpu_pct", "canonical_node_mem_pct", "canonical_node_disk_pct", "canonical_unschedulable_pods", "canonical_unneeded_nodes", "canonical_api_inflight_requests"],
    "Databases": ["canonical_db_cpu_pct", "canonical_db_mem_pct", "canonical_db_storage_pct", "canonical_db_connections", "canonical_db_dtu_used"],
    "Governance": ["canonical_runs_failed", "canonical_run_failure_pct", "canonical_group_instances", "canonical_throttled_requests"],
    "Security": ["canonical_api_hit", "canonical_api_latency_ms", "canonical_saturation", "canonical_availability_pct"],
    "Network": ["canonical_health_pct"],
    "Storage": ["availability_pct"],
}


def _one_of(names: list[str]):
    return lambda k, v: k.isin(names)


def shown(category: Column, now: Column) -> Column:
    """D-3: a map of the values a category's payload shows as they are; those not reported are left out."""
    out = F.create_map().cast("map<string,double>")
    for name, features in SHOWN.items():
        out = F.when(category == name, F.map_filter(now, _one_of(features))).otherwise(out)
    return out


def finite(value: Column) -> Column:
    """K-2: null for what a sink's format has no number for."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def hour_bucket(ts: Column) -> Column:
    """K-5: the hour a summary belongs to."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def worth_explaining(rows: DataFrame) -> DataFrame:
    """F-13: anomalous ones and those of any severity but INFO."""
    return rows.where(C.is_true(F.col("is_anomalous")) | (F.col("severity") != "INFO"))


def set_rules(rules: DataFrame, new: DataFrame) -> DataFrame:
    """D-10: rules with new ones in place of those of the same resource and metric; of several new ones the last (seq)."""
    w = Window.partitionBy("resource_id", "metric_name").orderBy(F.desc("seq"))
    last = new.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*rules.columns)
    return rules.join(last, ["resource_id", "metric_name"], "left_anti").select(*rules.columns).unionByName(last)


def delete_rules(rules: DataFrame, gone: DataFrame) -> DataFrame:
    """D-10: rules without those of the given resources and metrics."""
    return rules.join(gone, ["resource_id", "metric_name"], "left_anti")
