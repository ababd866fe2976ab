"""From documents to served predictions: identity, merging, gates, routing, and the tables that others read."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from fleetlens.functions import columns as C
from fleetlens.operators import decisions, ingest, quality, serve
from fleetlens.sources.shared import cut


def first_of(docs: DataFrame, *names: str) -> Column:
    """The first of these columns that is there, not null and not empty, as text."""
    found = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in docs.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def identity(docs: DataFrame) -> DataFrame:
    """P-4, F-2: who a document is about, by the fields it may say so in; documents without a category or metric go."""
    key, category = first_of(docs, "element_id", "resourceId", "resource_id", "inventory_id", "_id"), C.category(first_of(docs, "category"))
    component = first_of(docs, "component", "service_type", "resource_type")
    return docs.where((first_of(docs, "category").isNotNull()) & first_of(docs, "metric").isNotNull()).select(
        first_of(docs, "_id").alias("document_id"), key.alias("resource_id"), F.coalesce(first_of(docs, "resource_name", "display_name", "name"), key).alias("resource_name"), *[first_of(docs, n).alias(n) for n in ("account_id", "project", "location")],
        category.alias("category"), component.alias("component"), C.resource_type(component, category).alias("rtype"), C.provider(first_of(docs, "service_name", "provider")).alias("provider"), first_of(docs, "summary_details", "description").alias("details"),
    )


def merge_maps(document: Column, inventory: Column, authoritative: tuple[str, ...] = ("project", "category"), document_first: bool = True) -> Column:
    """P-20: fields of both, a field that is present wins even where it is null; the inventory always wins for the
    authoritative ones. Ids aren't merged."""
    base, over = (inventory, document) if document_first else (document, inventory)
    merged = F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)
    fixed = F.map_filter(inventory, lambda k, _: k.isin(*authoritative))
    merged = F.map_concat(F.map_filter(merged, lambda k, _: ~F.map_contains_key(fixed, k)), fixed)
    return F.map_filter(merged, lambda k, _: k != "_id")


def gated(predictions: DataFrame, now: DataFrame, rows: DataFrame, most_minutes: float = 1440, least_hours: float = 24) -> DataFrame:
    """D-1: predictions (with completeness, risk, score, dominant) after the gates, in this order: no telemetry, stale, too
    little history, normal. The first two have no risk; none of the three alerts."""
    stale = quality.stale_resources(rows, now, most_minutes)
    return gates(predictions.join(stale, "resource_id", "left").join(quality.history_hours(rows).select("resource_id", "hours"), "resource_id", "left"), least_hours)


def gates(x: DataFrame, least_hours: float = 24) -> DataFrame:
    """The gates of `gated`, over rows with age_minutes (null: not stale) and hours of history."""
    silent, old, thin = F.col("completeness") == 0, F.col("age_minutes").isNotNull(), C.is_true(F.col("hours") < least_hours)
    gate = F.when(silent, "no_telemetry").when(old, "stale").when(thin, "thin").otherwise("normal")
    minutes, span = F.bround("age_minutes", 0).cast("long").cast("string"), F.format_string("%.1f", C.r(F.col("hours"), 1))
    note = F.when(old, F.concat(F.lit("stale_resource_"), minutes, F.lit("min"))).when(thin, F.concat(F.lit("insufficient_history_"), span, F.lit("h")))
    x = x.withColumn("gate", gate).withColumn("data_quality_note", note)
    risk = F.when(F.col("gate").isin("no_telemetry", "stale"), 0.0).otherwise(F.col("risk"))
    x = x.withColumn("risk", risk).withColumn("score", F.when(F.col("gate").isin("no_telemetry", "stale"), 0.0).otherwise(F.col("score")))
    normal = F.col("gate") == "normal"
    out = x.withColumn("is_anomalous", normal & ((F.col("score") >= 0.6) | F.col("dominant"))).withColumn("trigger", normal & ((F.col("risk") >= 40) | F.col("dominant")))
    advice = F.when(F.col("gate") == "no_telemetry", "verify_agent").when(F.col("gate") == "stale", "verify_reporting").when(F.col("gate") == "thin", "await_history")
    return out.withColumn("severity", F.when(normal, C.severity(F.col("risk"))).otherwise("INFO")).withColumn("display_score", F.bround("risk", 0).cast("long")).withColumn("gate_advice", advice)


def risk_level(display_score: Column) -> Column:
    """A-18: the class of a shown score; 0 is healthy, none is unknown."""
    return F.when(display_score.isNull(), "UNKNOWN").when(display_score == 0, "HEALTHY").otherwise(C.ladder(display_score, [(90, "CRITICAL"), (75, "HIGH"), (50, "MEDIUM")], "LOW"))


def latest_per_resource(rows: DataFrame) -> DataFrame:
    """W-1 as the read API has it: each resource's newest prediction in a category."""
    return ingest.latest_rows(rows, ["resource_id", "category"])


def fleet_stats(latest: DataFrame) -> DataFrame:
    """A-18: resources, anomalous ones, alerts and projects: overall, by provider, by category and by risk level."""
    x = latest.withColumn("level", risk_level(F.col("display_score")))
    count = lambda c: F.sum(C.is_true(F.col(c)).cast("long"))
    return x.groupingSets([[], ["provider"], ["category"], ["level"]], "provider", "category", "level").agg(F.count("*").alias("resources"), count("is_anomalous").alias("anomalous"), count("trigger").alias("alerts"), F.count_distinct("project").alias("projects"))


def active(windows: DataFrame, now: DataFrame) -> DataFrame:
    """F-11: windows that are open at now (one row), both ends included; a window without an end isn't one."""
    at = now.scalar()
    return windows.where((F.col("starts_at") <= at) & (F.col("ends_at") >= at))


def with_explanations(cards: DataFrame, explanations: DataFrame) -> DataFrame:
    """J-9: cards with the explanation of their resource, where there is one without an error."""
    return cards.join(explanations.where("error is null").select("resource_id", "narrative"), "resource_id", "left")


def store_explanations(old: DataFrame, new: DataFrame) -> DataFrame:
    """K-6: one explanation per resource, the newest; those that failed replace none."""
    return decisions.upsert(old, new.where("error is null"), ["resource_id"], "at")


def store_summaries(old: DataFrame, new: DataFrame) -> DataFrame:
    """K-5: one summary per project and hour, a later one of the hour replaces it."""
    return decisions.upsert(old, new.withColumn("hour", F.date_trunc("hour", "at").cast("timestamp_ntz")), ["project", "hour"], "at")


def save_profiles(profiles: DataFrame, path: str) -> None:
    """K-4: profiles by category, so that reading one category reads its folder only."""
    profiles.write.mode("overwrite").partitionBy("category").parquet(path)


def upsert_profiles(spark: SparkSession, path: str, new: DataFrame, keys: tuple[str, ...] = ("rtype", "category", "feature")) -> None:
    """K-4: new profiles replace stored ones of the same key, the others stay; only folders of categories that new profiles
    have are written. A key that comes twice keeps the row with more values (n), then the greater row. A repeat changes
    nothing. The folder must have been begun by save_profiles."""
    rest = [c for c in new.columns if c not in keys]
    once = cut(new.groupBy(*keys).agg(F.max(F.struct("n", *[c for c in rest if c != "n"])).alias("x")).select(*keys, "x.*"))
    touched = spark.read.parquet(path).join(F.broadcast(once.select("category").distinct()), "category", "left_semi")  # a handful of categories
    alike = [F.col(f"o.{c}").eqNullSafe(F.col(f"w.{c}")) for c in keys]
    kept = touched.alias("o").join(once.alias("w"), alike, "left_anti")
    merged = cut(kept.unionByName(once, allowMissingColumns=True))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("category").parquet(path)


def load_profiles(spark: SparkSession, path: str, category: str, rtype: str | None = None) -> DataFrame:
    """S-12: a category's profiles, or those of one of its types."""
    found = spark.read.parquet(path).where(F.col("category") == category)
    return found if rtype is None else found.where(F.col("rtype") == rtype)


def deliver(predictions: DataFrame, windows: DataFrame, path: str, required: tuple[str, ...] = ("project",)) -> tuple[DataFrame, DataFrame]:
    """D-8, K-3, U-1: valid predictions, suppressed where a window says so, written to a folder per category; what all of
    them read together, and the invalid ones with their errors."""
    checked = predictions.withColumn("errors", quality.errors_of_prediction(F.col("score"), F.col("risk"), F.col("severity"), {n: F.col(n) for n in required}))
    good = checked.where(F.size("errors") == 0).drop("errors")
    serve.write_by_category(decisions.suppress(good, windows), path)
    return predictions.sparkSession.read.parquet(path), checked.where(F.size("errors") > 0)


def write_ordered(rows: DataFrame, path: str, keys: tuple[str, ...] = ("category", "resource_id", "ts")) -> None:
    """O-1, K-8: rows in order within and across files, in place of an index: readers skip what their filter rules out."""
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def feature_columns(rows: DataFrame, leave_out: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """P-19: numeric and categorical columns of a model's input, by the schema."""
    kinds = {f.name: isinstance(f.dataType, NumericType | BooleanType) for f in rows.schema.fields if f.name not in leave_out}
    return [n for n, numeric in kinds.items() if numeric], [n for n, numeric in kinds.items() if not numeric]


def filled(rows: DataFrame, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """P-19: each feature column, its class and how many rows have it; one pass."""
    numeric, categorical = feature_columns(rows, leave_out)
    got = rows.agg(*[F.count(n).alias(n) for n in numeric + categorical])
    each = [F.struct(F.lit(n).alias("name"), F.lit("numeric" if n in numeric else "categorical").alias("kind"), F.col(n).alias("filled")) for n in numeric + categorical]
    return got.select(F.explode(F.array(*each)).alias("c")).select("c.*")
