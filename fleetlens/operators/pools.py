"""Exact quantiles of pools of any size."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values are told apart to about one part in so many before any is ranked.
PARTS = 1024


def magnitude(v: Column) -> Column:
    """A whole number that never falls as v grows: sign and logarithm, in steps of one part in PARTS; NaN is largest."""
    step = F.floor(F.log(F.abs(v)) * PARTS) + 1_000_000
    size = F.when(F.isnan(v), 4_000_000).when(F.abs(v) == float("inf"), 3_000_000).otherwise(step)
    return F.when(v == 0, F.lit(0).cast("long")).otherwise(F.when(F.isnan(v) | (v > 0), size).otherwise(-size).cast("long"))


def quantiles(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, Column | float], weight: str | None = None) -> DataFrame:
    """keys, n (values that are not null) and a column for each wanted quantile (0 to 1; an expression may use n), exact
    and linear between neighbours.

    Equal values are counted first. Counts of magnitudes then say in which magnitude a quantile's neighbours lie, and only
    the values of those are ranked, so no task holds a pool. Null keys are a pool of their own; a pool without values has
    no row. weight: a column that says how often a row counts.
    """
    often = F.sum(weight) if weight else F.count("*")
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(often.alias("_c")).withColumn("_m", magnitude(F.col("_v")))
    pool = Window.partitionBy(*keys)
    totals = counted.groupBy(*keys, "_m").agg(F.sum("_c").alias("_t"))
    ranked = totals.select(*keys, "_m", F.sum("_t").over(pool).alias("n"), (F.sum("_t").over(pool.orderBy("_m")) - F.col("_t")).alias("_before"), "_t")
    asked = F.array(*[F.struct(F.lit(k).alias("k"), ((q if isinstance(q, Column) else F.lit(float(q))) * (F.col("n") - 1)).cast("double").alias("at")) for k, q in wanted.items()])
    ends = ranked.withColumn("_q", F.explode(asked)).select("*", F.col("_q.k").alias("_k"), F.col("_q.at").alias("_at")).drop("_q")
    holding = ends.where((F.floor("_at") < F.col("_before") + F.col("_t")) & (F.ceil("_at") >= F.col("_before")))
    right = holding.select(*[F.col(c).alias(f"_r_{c}") for c in keys], F.col("_m").alias("_r_m"), "n", "_before", "_k", "_at")
    on = F.col("_m") == F.col("_r_m")
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    inside = counted.join(right, on)
    upto = Window.partitionBy(*keys, "_k", "_m").orderBy("_v")
    placed = inside.withColumn("_last", F.col("_before") + F.sum("_c").over(upto) - 1).withColumn("_first", F.col("_last") - F.col("_c") + 1)
    low, high = F.floor("_at"), F.ceil("_at")
    holds = lambda at: F.max(F.when((F.col("_first") <= at) & (at <= F.col("_last")), F.col("_v")))
    found = placed.groupBy(*keys, "n", "_k", "_at").agg(holds(low).alias("_lo"), holds(high).alias("_hi"))
    part = F.col("_at") - F.floor("_at")
    one = found.withColumn("_x", F.when(part == 0, F.col("_lo")).otherwise((1 - part) * F.col("_lo") + part * F.col("_hi")))
    return one.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("_k") == k, F.col("_x"))).alias(k) for k in wanted])
