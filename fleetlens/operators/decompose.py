"""T-3 on Spark: hourly series, cut into blocks with margins, decomposed block by block; no group is a whole series."""

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import decompose as D
from fleetlens.operators.forecast import KEYS

BLOCK, MARGIN = 60 * 24, 14 * 24


def hourly(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """keys, hour (since the series' first reading) and the mean of its readings; hours without any lie on the line between
    their neighbours, filled is true for them. Null values are left out; of readings at one time the first by event_id
    counts."""
    once = rows.where("value is not null").groupBy(*keys, "ts").agg(F.min_by("value", "event_id").alias("value"))
    first = once.groupBy(*keys).agg(F.min("ts").alias("_t0"))
    hours = once.join(first, list(keys)).groupBy(*keys, F.floor(C.hours_between(F.col("_t0"), F.col("ts"))).alias("hour")).agg(F.avg("value").alias("value"))
    ahead = Window.partitionBy(*keys).orderBy("hour")  # one row an hour
    gaps = hours.withColumn("_next", F.lead("hour").over(ahead)).withColumn("_then", F.lead("value").over(ahead))
    each = gaps.select(*keys, F.col("hour").alias("_from"), F.col("value").alias("_v"), "_next", "_then", F.explode(F.sequence("hour", F.coalesce(F.col("_next") - 1, F.col("hour")))).alias("hour"))
    share = (F.col("hour") - F.col("_from")) / (F.col("_next") - F.col("_from"))
    on_line = F.col("_v") + (F.col("_then") - F.col("_v")) * share
    filled = F.col("hour") > F.col("_from")
    return each.select(*keys, "hour", F.when(filled, on_line).otherwise(F.col("_v")).alias("value"), filled.alias("filled"))


def decomposed(hours: DataFrame, keys: list[str] = KEYS, period: int = D.DAY, block: int = BLOCK, margin: int = MARGIN) -> DataFrame:
    """hours (see hourly) with trend, seasonal and rest. A block of `block` hours is decomposed with `margin` hours of its
    neighbours on either side, so a group holds block + 2 * margin rows at most. Series no longer than a block get what the
    whole series gives; of longer ones, values next to a cut differ by what lies beyond the margin. Series below two periods
    have no rows."""
    if margin < 2 * period:
        raise ValueError("a margin takes two periods at least")
    inside = F.sequence(F.greatest(F.lit(0), F.floor((F.col("hour") - margin) / block)).cast("long"), F.floor((F.col("hour") + margin) / block).cast("long"))
    dealt = hours.select(*keys, "hour", "value", "filled", F.explode(inside).alias("block"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("hour")
        own = pdf["hour"] // block == pdf["block"]
        parts = D.decompose(pdf["value"].to_numpy(float), period) if own.any() else None
        if parts is None:
            return pd.DataFrame(columns=[*keys, "hour", "value", "filled", "trend", "seasonal", "rest"])
        return pdf.assign(trend=parts[0], seasonal=parts[1], rest=parts[2])[own].drop(columns="block")

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema if f.name != "block")
    return dealt.groupBy(*keys, "block").applyInPandas(run, kinds + ", trend double, seasonal double, rest double")


def decomposition_fit(parts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Per series: hours, what share of the variance trend and season explain (1 for a constant), how strong either is, and
    the trend's slope an hour."""
    share = lambda a, b: F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col(a) / F.col(b)))
    sums = parts.groupBy(*keys).agg(
        F.count("*").alias("hours"), F.var_pop("value").alias("_all"), F.var_pop("rest").alias("_rest"), F.var_pop(F.col("trend") + F.col("rest")).alias("_slow"),
        F.var_pop(F.col("seasonal") + F.col("rest")).alias("_cycle"), F.regr_slope("trend", "hour").alias("slope"),
    )
    out = {"r2": ("_rest", "_all", 1.0), "trend_strength": ("_rest", "_slow", 0.0), "season_strength": ("_rest", "_cycle", 0.0)}
    return sums.select(*keys, "hours", *[F.when(F.col(b) < 1e-9, flat).otherwise(share(a, b)).alias(k) for k, (a, b, flat) in out.items()], "slope")
