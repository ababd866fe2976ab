"""From nested metric documents to canonical series (long) and wide rows."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions.metric_rules import rules


def rule_table(spark: SparkSession) -> DataFrame:
    """The registry as a table of about 200 rows, small enough to broadcast anywhere."""
    return spark.createDataFrame(rules(), "category string, feature string, provider string, raw_metric string, transform string, precedence int")


def points(docs: DataFrame) -> DataFrame:
    """P-9, P-6 to P-8: one row per point of metric_value (array<map<string,string>>), with its stat and time. A point's
    time is its own, else the document's from_date, else created_at."""
    flat = docs.select("*", F.explode(F.coalesce("metric_value", F.array(F.create_map().cast("map<string,string>")))).alias("_p")).drop("metric_value")
    own = C.get_ci(F.col("_p"), "timestamp").try_cast("timestamp_ntz")
    return flat.select("*", C.stat(F.col("_p")).alias("_s"), C.stat_bundle(F.col("_p")).alias("_b"), own.alias("_t")).select(
        *[c for c in flat.columns if c != "_p"], F.coalesce("_t", "from_date", "created_at").alias("ts"), "_s.value", "_s.stat", "_b.avg", "_b.vmax", "_b.vmin", "_b.sample_count"
    )


def resolve_conflicts(rows: DataFrame) -> DataFrame:
    """A-2: of several readings of one (resource, category, ts, metric) the first in scan order, unless a later one is an
    average and it is not. Scan order: newest from_date, then smallest _id."""
    order = F.struct((F.col("stat") != "average").alias("other"), (-C.seconds(F.col("from_date"))).alias("age"), F.col("_id"))
    keys = ["resource_id", "category", "provider", "ts", "metric"]
    rest = [c for c in rows.columns if c not in keys]
    return rows.where("value is not null").groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("x")).select(*keys, "x.*")


def canonical(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """P-10, P-11: canonical features; of several raw metrics that feed one, the first in precedence."""
    joined = rows.join(F.broadcast(registry), (rows["category"] == registry["category"]) & (rows["provider"] == registry["provider"]) & (rows["metric"] == registry["raw_metric"])).drop(registry["category"]).drop(registry["provider"])
    keys = ["resource_id", "category", "provider", "ts", "feature"]
    values = [C.transform(F.col(c), F.col("transform")).alias(c) for c in ("value", "vmax", "vmin")]
    return joined.groupBy(*keys).agg(F.min_by(F.struct(*values, "stat", "sample_count", F.col("metric").alias("raw_metric")), F.struct("precedence", "metric")).alias("x")).select(*keys, "x.*")


def cpu_from_idle(long: DataFrame) -> DataFrame:
    """P-12: adds canonical_cpu_pct = 100 - idle where only idle was reported."""
    keys = [c for c in ("resource_id", "category", "provider", "ts") if c in long.columns]
    has = long.where("feature = 'canonical_cpu_pct'").select(*keys)
    derived = long.where("feature = 'canonical_cpu_idle_pct'").join(has, keys, "left_anti").withColumn("feature", F.lit("canonical_cpu_pct")).withColumn("value", 100 - F.col("value"))
    return long.unionByName(derived)


def wide(long: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """A-3: one row per key and time, one column per feature (a fixed list, so no extra job looks for values)."""
    return long.groupBy(*keys).pivot("feature", features).agg(F.first("value"))


def gap_flags(long: DataFrame, keys: list[str], factor: float = 2.5) -> DataFrame:
    """W-2: gap_hours since the previous point and gap_flag, true beyond `factor` medians of the series' positive gaps."""
    gap = C.hours_between(F.lag("ts").over(Window.partitionBy(*keys).orderBy("ts", "event_id")), F.col("ts"))
    with_gap = long.withColumn("gap_hours", gap)
    usual = F.median(F.when(F.col("gap_hours") > 0, F.col("gap_hours"))).over(Window.partitionBy(*keys))
    return with_gap.withColumn("usual_gap", usual).withColumn("gap_flag", C.is_true(F.col("gap_hours") > factor * F.col("usual_gap")))


def data_state(flagged: DataFrame, keys: list[str], slots: str = "slots") -> DataFrame:
    """A-25: idle, missing, sparse or ok for each series; slots: how many wide rows the resource has."""
    zero, null = F.sum((F.col("value") == 0).cast("long")) / F.first(slots), 1 - F.count("value") / F.first(slots)
    out = flagged.groupBy(*keys).agg(zero.alias("zero_frac"), null.alias("null_frac"), F.max("gap_flag").alias("any_gap"))
    return out.withColumn("state", F.when(F.col("zero_frac") > 0.8, "idle").when(F.col("any_gap") & (F.col("null_frac") > 0.3), "missing").when(F.col("zero_frac") > 0.1, "sparse").otherwise("ok"))


def mixed_stats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A-23."""
    return rows.groupBy(*keys).agg(F.count_distinct("stat").alias("stats"), (F.count_distinct("stat") > 1).alias("mixed"))


def coverage(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """S-19: documents by metric, and whether the registry maps it."""
    known = registry.select("category", "provider", F.col("raw_metric").alias("metric")).distinct().withColumn("mapped", F.lit(True))
    return rows.groupBy("category", "provider", "metric").agg(F.count("*").alias("documents")).join(F.broadcast(known), ["category", "provider", "metric"], "left").withColumn("mapped", C.is_true(F.col("mapped")))
