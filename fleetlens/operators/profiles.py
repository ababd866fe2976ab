"""Baselines pooled by resource type, and slope priors. All pools cover the whole input."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators.pools import quantiles

POOL = ["rtype", "category", "feature"]


def profile_stats(rows: DataFrame) -> DataFrame:
    """A-4: count, mean, population std, exact p5 and p95 of pools with five values or more."""
    out = rows.groupBy(*POOL).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    return out.where("n >= 5").join(quantiles(rows, POOL, "value", {"p5": 0.05, "p95": 0.95}).drop("n"), POOL)


def diurnal(rows: DataFrame) -> DataFrame:
    """A-5: median by weekday (Monday 0) and hour, of buckets with two values or more."""
    bucketed = rows.withColumn("dow", F.weekday("ts")).withColumn("hod", F.hour("ts"))
    return quantiles(bucketed, [*POOL, "dow", "hod"], "value", {"expected": 0.5}).where("n >= 2")


def cadence(rows: DataFrame) -> DataFrame:
    """A-6: the median over resources of each one's median positive gap, in hours."""
    series = ["resource_id", *POOL]
    gap = C.hours_between(F.lag("ts").over(Window.partitionBy(*series).orderBy("ts", "event_id")), F.col("ts"))
    own = rows.withColumn("gap", gap).where("gap > 0").groupBy(*series).agg(F.median("gap").alias("usual"))
    return quantiles(own, POOL, "usual", {"cadence_hours": 0.5}).withColumnRenamed("n", "resources")


def regime_shift(rows: DataFrame, days: int = 3, warm_up: int = 14, sigmas: float = 2.5) -> DataFrame:
    """A-7: whether the last days' mean lies away from the pool's."""
    ends = rows.groupBy(*POOL).agg(F.max("ts").alias("last"), F.min("ts").alias("first"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    recent = rows.join(ends, POOL).where(F.col("ts") >= F.col("last") - F.make_dt_interval(F.lit(days)))
    near = recent.groupBy(*POOL).agg(F.count("value").alias("recent_n"), F.avg("value").alias("recent_mean"))
    out = ends.join(near, POOL)
    long_enough = C.hours_between(F.col("first"), F.col("last")) >= 24 * (warm_up + days)
    return out.select(*POOL, "recent_n", "recent_mean", "mean", (long_enough & (F.col("sd") > 0) & (F.col("recent_n") >= 3) & (F.abs(F.col("recent_mean") - F.col("mean")) > sigmas * F.col("sd"))).alias("shifted"))


def profile_confidence(rows: DataFrame, warm_up: int = 14, breadth: int = 5) -> DataFrame:
    """A-8."""
    out = rows.groupBy(*POOL).agg(F.floor(C.hours_between(F.min("ts"), F.max("ts")) / 24).alias("days"), F.count_distinct("resource_id").alias("resources"))
    score = 0.6 * F.least(F.lit(1.0), F.col("days") / warm_up) + 0.4 * F.least(F.lit(1.0), F.col("resources") / breadth)
    return out.withColumn("confidence", C.r(score, 3))


def series_slopes(rows: DataFrame, least: int = 5) -> DataFrame:
    """Slope per hour of each series over its range; 0 without a range of time or value."""
    series = ["resource_id", *POOL]
    start = F.min("ts").over(Window.partitionBy(*series))
    out = rows.withColumn("x", C.hours_between(start, F.col("ts"))).groupBy(*series).agg(F.count("value").alias("n"), F.regr_slope("value", "x").alias("slope"), (F.max("value") - F.min("value")).alias("range"), (F.max("x") - F.min("x")).alias("x_range")).where(F.col("n") >= least)
    return out.withColumn("norm_slope", F.when((F.col("range") < 1e-9) | (F.col("x_range") < 1e-9), F.lit(0.0)).otherwise(F.col("slope") / F.col("range")))


def slope_priors(rows: DataFrame) -> DataFrame:
    """A-9: median normalised slope and pool size of each pool."""
    return quantiles(series_slopes(rows), POOL, "norm_slope", {"prior": 0.5}).withColumnRenamed("n", "pool")


def slope_training_table(rows: DataFrame, least: int = 20) -> DataFrame:
    """A-10: the normalised slopes of longer series with the newest value of each."""
    series = ["resource_id", *POOL]
    newest = rows.groupBy(*series).agg(F.max_by("value", F.struct("ts", "event_id")).alias("latest"))
    return series_slopes(rows, least).join(newest, series).select(*series, "n", "norm_slope", "latest")


def reporting_gap(rows: DataFrame, cadence_: DataFrame, factor: float = 2.5) -> DataFrame:
    """W-3: gaps of a series beyond a multiple of its pool's cadence."""
    series = ["resource_id", *POOL]
    gap = C.hours_between(F.lag("ts").over(Window.partitionBy(*series).orderBy("ts", "event_id")), F.col("ts"))
    return rows.withColumn("gap", gap).join(cadence_, POOL).where(F.col("gap") > factor * F.col("cadence_hours"))


def classify_zero(value, p5, mean):
    """A-26: what a zero means beside its pool: normal where the pool reaches it, else suspect."""
    return F.when(value != 0, "nonzero").when(p5.isNull(), "unknown").when(p5 <= 0, "idle").when(mean > 0, "suspect").otherwise("unknown")
