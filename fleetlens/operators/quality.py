"""Freshness, history, validation and drift."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import columns as C


def last_seen(rows: DataFrame) -> DataFrame:
    return rows.groupBy("resource_id").agg(F.max("ts").alias("last_seen"))


def stale_resources(rows: DataFrame, now: DataFrame, most_minutes: float) -> DataFrame:
    """F-3: resources whose newest reading is older than a limit; now: one row with a column now."""
    age = C.hours_between(F.col("last_seen"), now.scalar()) * 60
    return last_seen(rows).select("resource_id", F.bround(age, 1).alias("age_minutes")).where(F.col("age_minutes") > most_minutes)


def history_hours(rows: DataFrame) -> DataFrame:
    """F-4: span of a resource's readings; 0 with fewer than two."""
    span = F.when(F.count("*") < 2, F.lit(0.0)).otherwise(C.hours_between(F.min("ts"), F.max("ts")))
    return rows.groupBy("resource_id").agg(C.r(span, 2).alias("hours"), F.count("*").alias("points"))


def gate(rows: DataFrame, now: DataFrame, most_minutes: float, least_hours: float = 24) -> DataFrame:
    """F-5: stale and thin flags for every resource."""
    old = stale_resources(rows, now, most_minutes).select("resource_id", F.lit(True).alias("s"))
    return history_hours(rows).join(old, "resource_id", "left").select("resource_id", C.is_true(F.col("s")).alias("stale"), (F.col("hours") < least_hours).alias("thin"))


def percent_ranges(rows: DataFrame, features: list[str], high: float = 150, low: float = -5) -> DataFrame:
    """F-6: groups of category, feature and provider whose percentages leave the range."""
    out = rows.where(F.col("feature").isin(features)).groupBy("category", "feature", "provider").agg(F.min("value").alias("least"), F.max("value").alias("most"))
    return out.where((F.col("most") > high) | (F.col("least") < low))


def errors_of_prediction(score: Column, risk: Column, severity: Column, required: dict[str, Column]) -> Column:
    """F-7: what is wrong with a prediction, as an array of words."""
    tests = [(~score.between(0, 1), "score_range"), (~risk.between(0, 100), "risk_range"), (~severity.isin("CRITICAL", "HIGH", "WARNING", "INFO"), "severity")]
    tests += [(c.isNull(), f"missing_{n}") for n, c in required.items()]
    return F.filter(F.array(*[F.when(C.is_true(t), F.lit(w)) for t, w in tests]), lambda x: x.isNotNull())


def drift(predictions: DataFrame, limit: float = 0.40) -> DataFrame:
    """A-12."""
    out = predictions.groupBy("category").agg(F.count("*").alias("n"), F.avg(F.col("is_anomalous").cast("double")).alias("rate"))
    return out.select("category", "n", C.r(F.col("rate")).alias("rate"), (F.col("rate") >= limit).alias("drifted"))


def alert_changes(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W-11 in batch: rows whose severity differs from the one before it (the first row differs)."""
    from pyspark.sql import Window

    before = F.lag("severity").over(Window.partitionBy(*keys).orderBy(*order))
    return events.withColumn("previous", before).where(F.col("previous").isNull() | (F.col("previous") != F.col("severity")))


def late_arrival(ts: Column, now: Column, minutes: float = 15) -> Column:
    """P-15: a reading up to some minutes old counts as of now."""
    age = C.hours_between(ts, now) * 60
    return F.when((age > 0) & (age <= minutes), now).otherwise(ts)
