"""Facts about a prediction that an explanation is written from (E-2, E-4), and searches over predictions (F-9)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C

#: Warning and critical limits of features; where the second is the lower one, low values are bad.
LIMITS = {
    "canonical_cpu_pct": (80.0, 90.0),
    "canonical_mem_used_pct": (80.0, 90.0),
    "canonical_storage_used_pct": (80.0, 90.0),
    "canonical_node_cpu_pct": (80.0, 90.0),
    "canonical_node_mem_pct": (80.0, 90.0),
    "canonical_node_disk_pct": (80.0, 90.0),
    "canonical_db_cpu_pct": (80.0, 90.0),
    "canonical_db_mem_pct": (80.0, 90.0),
    "canonical_db_storage_pct": (85.0, 95.0),
    "canonical_saturation": (75.0, 90.0),
    "canonical_subnet_util_pct": (75.0, 90.0),
    "canonical_run_failure_pct": (40.0, 70.0),
    "canonical_burst_balance_pct": (20.0, 10.0),
    "canonical_health_pct": (90.0, 80.0),
    "canonical_availability_pct": (99.0, 95.0),
}
#: Days from which a breach counts as none.
NO_BREACH = 3650


def _limit(feature: Column, at: int) -> Column:
    return F.create_map(*[F.lit(x) for f, limits in LIMITS.items() for x in (f, limits[at])])[feature]


def _inverted(feature: Column) -> Column:
    return feature.isin([f for f, (warn, crit) in LIMITS.items() if crit < warn])


def health(feature: Column, value: Column) -> Column:
    """CRITICAL, WARNING or HEALTHY by the feature's limits; UNKNOWN without a value or limits."""
    past = lambda limit: F.when(_inverted(feature), value <= limit).otherwise(value >= limit)
    known = value.isNotNull() & _limit(feature, 0).isNotNull()
    return F.when(~C.is_true(known), "UNKNOWN").when(past(_limit(feature, 1)), "CRITICAL").when(past(_limit(feature, 0)), "WARNING").otherwise("HEALTHY")


def state(feature: Column, current: Column) -> dict[str, Column]:
    """Health now; how far it is to the warning limit, or beyond it; what is used of a percentage and what is left."""
    warn, inverted = _limit(feature, 0), _inverted(feature)
    to_go = F.when(inverted, current - warn).otherwise(warn - current)
    at_warning = health(feature, current).isin("WARNING", "CRITICAL")
    left = F.when(feature.endswith("_pct"), F.when(inverted, current).otherwise(100 - current))
    return {
        "health": health(feature, current), "gap_to_warning": F.when(~at_warning, to_go), "exceeded_by": F.when(at_warning, -to_go),
        "of_warning_pct": F.when(~at_warning, current / warn * 100), "headroom_pct": left, "consumed_pct": 100 - left,
    }


def growth(feature: Column, current: Column, daily: Column) -> Column:
    """Speed and direction of the daily change: of a percentage by the share of the headroom that a day takes, of other
    features by the share of the value."""
    inverted, percent = _inverted(feature), feature.endswith("_pct")
    room = F.greatest(F.when(inverted, current).otherwise(100 - current), F.lit(0.1))
    share = F.abs(daily) / room * 100
    speed = F.when(share > 20, "rapidly ").when(share > 5, "steadily ").otherwise("slowly ")
    way = F.when(daily > 0, "increasing").otherwise("decreasing")
    other = F.concat(F.when((current != 0) & (F.abs(daily) / F.abs(current) * 100 > 20), "rapidly ").otherwise(""), way)
    low = F.when(daily < 0, F.concat(speed, F.lit("declining"))).otherwise("recovering")
    moving = F.when(percent & inverted, low).when(percent, F.concat(speed, way)).otherwise(other)
    return F.when(daily.isNull() | current.isNull(), None).when(F.abs(daily) < 0.005, "stable").otherwise(moving)


def volatility(width: Column, current: Column) -> Column:
    """By the width of the day's band relative to the value; null without a value or at zero."""
    share = F.when(current != 0, width / F.abs(current))
    return F.when(share.isNull(), None).when(share < 0.05, "very stable").when(share < 0.15, "moderately stable").when(share < 0.4, "moderately volatile").otherwise("highly volatile")


def days_to(feature: Column, current: Column, daily: Column, at: int) -> Column:
    """Days until a percentage passes its warning (0) or critical (1) limit: 0 where it is past it and moves on, null
    where it moves away or needs NO_BREACH days or more."""
    limit = _limit(feature, at)
    ahead = F.when(_inverted(feature), current - limit).otherwise(limit - current)
    toward = F.when(_inverted(feature), -daily).otherwise(daily)
    past = F.when(_inverted(feature), current <= limit).otherwise(current >= limit)
    return F.when(feature.endswith("_pct") & (toward > 0), F.when(past, 0.0).when(ahead / toward < NO_BREACH, ahead / toward))


def span(days: Column) -> Column:
    """Days in words: hours below one day, then days, weeks and months."""
    unit = lambda x, word: F.concat(F.format_string("about %.1f ", x), F.lit(word), F.when(x > 1.4, "s").otherwise(""))
    return F.when(days.isNull(), None).when(days == 0, "already breached").when(days < 1, F.concat(F.round(days * 24).cast("int").cast("string"), F.lit(" h"))).when(days < 7, unit(days, "day")).when(days < 30, unit(days / 7, "week")).otherwise(unit(days / 30, "month"))


def horizons(feature: Column, values: dict[int, Column], half: Column) -> Column:
    """An array of (hours, value, health, lower, upper) over the hours ahead that have a value."""
    one = lambda h, v: F.when(v.isNotNull(), F.struct(F.lit(h).alias("hours"), v.alias("value"), health(feature, v).alias("health"), (v - half).alias("lower"), (v + half).alias("upper")))
    return F.filter(F.array(*[one(h, v) for h, v in values.items()]), lambda x: x.isNotNull())


def evaluation(quality: Column, mase: Column, backtested: Column) -> dict[str, Column]:
    """How far the forecast is to be trusted: what it was judged on, its grade, and its gain over the naive forecast in percent."""
    return {
        "basis": F.when(C.is_true(backtested), "out_of_sample_backtest").otherwise("in_sample_fit"),
        "grade": F.when(quality >= 80, "excellent").when(quality >= 50, "acceptable").when(quality.isNotNull(), "poor"),
        "gain_pct": F.when(mase < 1, (1 - mase) * 100),
    }


def context(rows: DataFrame, half: str = "half") -> DataFrame:
    """E-2: rows (feature, current, f_1h, f_6h, f_24h, f_7d and half a band's width) with everything above."""
    f, now = F.col("feature"), F.col("current")
    daily = F.coalesce((F.col("f_7d") - now) / 7, F.col("f_24h") - now)
    out = rows.withColumns(state(f, now) | {"daily_change": daily})
    facts = {
        "growth": growth(f, now, F.col("daily_change")), "volatility": volatility(2 * F.col(half), now),
        "days_to_warning": days_to(f, now, F.col("daily_change"), 0), "days_to_critical": days_to(f, now, F.col("daily_change"), 1),
        "horizons": horizons(f, {1: F.col("f_1h"), 6: F.col("f_6h"), 24: F.col("f_24h"), 168: F.col("f_7d")}, F.col(half)),
    }
    return out.withColumns(facts)


def prompt(kind: str = "resource") -> Column:
    """E-4: the facts of a context row as lines of text for a text provider; what is null is left out."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value))
    number = lambda c: F.format_string("%.2f", F.when(F.col(c).isNotNull(), C.r(F.col(c), 2)))
    some = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}: "), number(c)))
    return F.concat_ws(
        "\n",
        line(kind, F.col("resource_id")), line("category", F.col("category")), line("metric", F.col("feature")), some("value", "current"), line("health", F.lower("health")),
        some("left before the warning limit", "gap_to_warning"), some("beyond the warning limit by", "exceeded_by"), some("headroom in percent", "headroom_pct"),
        line("growth", F.col("growth")), line("volatility", F.col("volatility")),
        line("warning limit reached in", span(C.r(F.col("days_to_warning"), 3))), line("critical limit reached in", span(C.r(F.col("days_to_critical"), 3))),
    )


def find(projects: DataFrame, rows: DataFrame, text: str, most_projects: int = 10, most_resources: int = 50) -> DataFrame:
    """F-9: kind, key and risk of the projects and resources whose text fields hold a text, without regard to case. Each
    resource counts by its newest row; the two limits are the report's own."""
    holds = lambda *names: F.exists(F.array(*[F.lower(F.coalesce(F.col(n), F.lit(""))) for n in names]), lambda x: x.contains(text.lower()))
    named = projects.where(holds("project")).orderBy("project").limit(most_projects)
    newest = rows.where(holds("resource_id", "provider", "category", "location")).groupBy("resource_id").agg(F.max_by("risk", F.struct("ts", "prediction_id")).alias("risk"))
    top = newest.orderBy(F.desc("risk"), "resource_id").limit(most_resources)
    return named.select(F.lit("project").alias("kind"), F.col("project").alias("key"), F.lit(None).cast("double").alias("risk")).unionByName(top.select(F.lit("resource").alias("kind"), F.col("resource_id").alias("key"), "risk"))


def profile_of(profiles: DataFrame, category: str, rtype: str | None = None) -> DataFrame:
    """S-12: the profiles of a category, or of one resource type in it."""
    found = profiles.where(F.col("category") == category)
    return found if rtype is None else found.where(F.col("rtype") == rtype)


def latest_explanations(rows: DataFrame) -> DataFrame:
    """K-6, L-5: the newest explanation of each resource; one that failed (null text) gives way to any that didn't."""
    w = Window.partitionBy("resource_id").orderBy(F.col("narrative").isNull(), F.desc("ts"), F.desc("prediction_id"))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
