"""Whole predictions: what was known of each metric when its resource last reported, put together as of that time.

Profiles, slope priors and models come in versions with a time from which they hold. Versions are running sums over days
or weeks of additive states, so a new day adds a row to each pool and nothing is read again. A prediction takes the newest
version by merging rows and versions in one sort; only series (not readings) pass through it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import anomaly, assemble, details, forecast, predict
from fleetlens.operators.pools import quantiles
from fleetlens.operators.profiles import POOL

SERIES = ["resource_id", *POOL]
RESOURCE = ["resource_id", "category"]
#: A key's rows are merged with its versions in so many sorts, so that one pool with most of the rows is no single task.
SLICES = 16


def as_of(rows: DataFrame, sources: dict[str, DataFrame], keys: list[str], at: str = "ts", slices: int = SLICES) -> DataFrame:
    """J-11: rows with a struct for each source: its newest version with valid_from at or before the row's time, null
    where there is none.

    sources: keys, valid_from and any payload; versions of one key are few beside its rows and are repeated for each
    slice. Rows and versions are sorted together by time, versions first, and each source's last struct is carried on.
    Of versions with one key and time one is taken; null keys are a key like any other; a row without a time gets nothing.
    """
    part = F.pmod(F.xxhash64(*[c for c in rows.columns if not rows.schema[c].dataType.typeName() == "map"]), F.lit(slices)).cast("int")
    merged = rows.select(*keys, part.alias("_part"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*rows.columns).alias("_row"))
    for name, versions in sources.items():
        payload = F.struct("valid_from", *[c for c in versions.columns if c not in (*keys, "valid_from")])
        held = versions.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_part"), F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), payload.alias(name))
        merged = merged.unionByName(held.where(F.col("_at").isNotNull()), allowMissingColumns=True)
    upto = Window.partitionBy(*keys, "_part").orderBy(F.col("_at").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = merged.select("_row", *[F.last(name, ignorenulls=True).over(upto).alias(name) for name in sources])
    return carried.where("_row is not null").select("_row.*", *sources)


# ---------------------------------------------------------------- versions


def profile_versions(rows: DataFrame, recent_days: int = 3, warm_up: int = 14, least: int = 5, sigmas: float = 2.5) -> DataFrame:
    """A-4, A-7: for each pool and day with readings, from the next day on: n, mean and population deviation of all readings
    up to then, and whether the last days' mean lies away from it (three readings, and a span of warm-up and last days)."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    own = rows.where("value is not null").groupBy(*POOL, day.alias("day")).agg(F.count("value").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    own = own.withColumn("k", F.date_diff("day", F.lit("1970-01-01").cast("date")))
    by = Window.partitionBy(*POOL).orderBy("k")  # a row for each day
    whole, near = by.rowsBetween(Window.unboundedPreceding, 0), by.rangeBetween(1 - recent_days, 0)
    x = own.select(*POOL, "day", "k", F.min("k").over(whole).alias("first"), *[F.sum(c).over(whole).alias(c) for c in "nsq"], F.sum("n").over(near).alias("near_n"), F.sum("s").over(near).alias("near_s"))
    mean = F.col("s") / F.col("n")
    x = x.withColumn("mean", mean).withColumn("sd", F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean)))
    away = (F.col("k") + 1 - F.col("first") >= warm_up + recent_days) & (F.col("sd") > 0) & (F.col("near_n") >= 3) & (F.abs(F.col("near_s") / F.col("near_n") - F.col("mean")) > sigmas * F.col("sd"))
    return x.where(F.col("n") >= least).select(*POOL, (F.col("day") + F.expr("INTERVAL 1 DAY")).alias("valid_from"), "n", "mean", "sd", away.alias("shifted"))


def prior_versions(rows: DataFrame, least: int = 5) -> DataFrame:
    """A-9: for each pool and week, from the next week on: the median of its series' normalised slopes up to then, and their
    number. Slopes come from running sums, so a week's readings are read once."""
    week = F.date_trunc("week", "ts").cast("timestamp_ntz")
    ends = rows.agg(F.date_trunc("week", F.min("ts")).cast("timestamp_ntz").alias("a"), F.date_trunc("week", F.max("ts")).cast("timestamp_ntz").alias("b"))
    x = C.hours_between(ends.select("a").scalar(), F.col("ts"))
    y = F.col("value")
    own = rows.where("value is not null").withColumn("x", x).groupBy(*SERIES, week.alias("week")).agg(
        F.count("value").alias("n"), F.sum("x").alias("sx"), F.sum(y).alias("sy"), F.sum(F.col("x") * y).alias("sxy"), F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"),
    )
    grid = own.groupBy(*SERIES).agg(F.min("week").alias("a")).select(*SERIES, F.explode(F.sequence("a", ends.select("b").scalar(), F.expr("INTERVAL 7 DAY"))).alias("week"))
    upto = Window.partitionBy(*SERIES).orderBy("week").rowsBetween(Window.unboundedPreceding, 0)  # a row for each week
    sums = [F.sum(c).over(upto).alias(c) for c in ("n", "sx", "sy", "sxy", "sxx")]
    r = grid.join(own, [*SERIES, "week"], "left").select(*SERIES, "week", *sums, *[f(c).over(upto).alias(c) for f, c in ((F.min, "x0"), (F.max, "x1"), (F.min, "y0"), (F.max, "y1"))])
    flat = (F.col("y1") - F.col("y0") < 1e-9) | (F.col("x1") - F.col("x0") < 1e-9)
    slope = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.nullif(F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"), F.lit(0.0))
    slopes = r.where(F.col("n") >= least).withColumn("norm", F.when(flat, 0.0).otherwise(slope / F.nullif(F.col("y1") - F.col("y0"), F.lit(0.0))))
    found = quantiles(slopes.withColumn("valid_from", F.col("week") + F.expr("INTERVAL 7 DAY")), [*POOL, "valid_from"], "norm", {"prior": 0.5})
    return found.withColumnRenamed("n", "pool")


# ---------------------------------------------------------------- assembly


def series_state(rows: DataFrame) -> DataFrame:
    """A row per series: its newest reading, how many there are, when the resource was first and last heard of, how many
    features it reports, all their newest values (now), and whether the series mixes statistics (column stat, if there)."""
    newest = F.max_by(F.struct("ts", "value", "vmax", "provider", "location", "account_id", "project"), F.struct("ts", "event_id")).alias("r")
    mixed = (F.count_distinct("stat") > 1) if "stat" in rows.columns else F.lit(False)
    x = rows.where("value is not null").groupBy(*SERIES).agg(newest, F.count("*").alias("n"), F.min("ts").alias("first_ts"), mixed.alias("mixed")).select(*SERIES, "n", "first_ts", "mixed", F.col("r.ts").alias("last_ts"), *[f"r.{c}" for c in ("value", "vmax", "provider", "location", "account_id", "project")])
    own = Window.partitionBy(*RESOURCE)  # a resource's metrics
    now = F.map_from_entries(F.collect_list(F.struct("feature", "value")).over(own))
    return x.select("*", F.max("last_ts").over(own).alias("seen"), F.min("first_ts").over(own).alias("first_seen"), F.sum("n").over(own).alias("points"), F.count("*").over(own).alias("features"), now.alias("now"))


def scored(x: DataFrame) -> DataFrame:
    """N-2, N-3, N-7 for each resource from its series (value, vmax, points, profile): one score for all its metrics."""
    own = Window.partitionBy(*RESOURCE)
    z = F.max(F.when(F.col("profile.sd") > 0, F.abs(F.col("value") - F.col("profile.mean")) / F.col("profile.sd"))).over(own)
    ratio = F.coalesce(F.max(F.when(F.col("value") != 0, F.col("vmax") / F.col("value"))).over(own), F.lit(1.0))
    x = x.withColumn("z_signal", F.when(F.col("points") >= anomaly.LEAST_ROWS, F.least(F.lit(1.0), F.coalesce(z, F.lit(0.0)) / 3.42)).otherwise(0.0))
    x = x.withColumn("burst_signal", F.least(F.lit(1.0), (F.least(F.lit(50.0), F.greatest(F.lit(1.0), ratio)) - 1) / 4)).withColumn("forest_signal", F.lit(None).cast("double"))
    return anomaly.composite(x).withColumn("risk", F.round(100 * F.col("score") + F.lit(3.7e-8), 2)).drop("forest_signal")


def known(rows: DataFrame, profiles: DataFrame, priors: DataFrame, models: DataFrame, features: dict[str, list[str]], now: DataFrame, most_minutes: float = 1440, least_hours: float = 24) -> DataFrame:
    """D-1, J-4 without the forecast: a row per series after the gates, with the profile, prior and model of that time.

    features: the registry's features by category; now: one row with a column now. No reading is joined with anything: rows
    become series once, and series meet versions in two sorts.
    """
    x = as_of(series_state(rows), {"profile": profiles, "slope": priors}, POOL, "seen")
    x = as_of(x, {"model": models}, ["category"], "seen")
    size = C.literal_map({c: len(f) for c, f in features.items()})
    age = F.bround(C.hours_between(F.col("seen"), now.scalar()) * 60, 1)
    x = scored(x).withColumns({
        "completeness": F.coalesce(F.bround(F.col("features") / size[F.col("category")], 3), F.lit(0.0)), "age_minutes": F.when(age > most_minutes, age),
        "hours": C.r(F.when(F.col("points") < 2, 0.0).otherwise(C.hours_between(F.col("first_seen"), F.col("seen"))), 2),
    })
    x = assemble.gates(x, least_hours)
    version = F.coalesce(F.col("model.model_version"), F.concat(F.lit("unsupervised-"), F.lower("category")))
    return x.withColumns({"model_version": version, "prior": F.col("slope.prior"), "pool": F.col("slope.pool"), "profile_n": F.col("profile.n"), "profile_mean": F.col("profile.mean"), "profile_sd": F.col("profile.sd"), "shifted": C.is_true(F.col("profile.shifted"))}).drop("profile", "slope", "model")


def derived(category: Column, now: Column, risk: Column) -> Column:
    """D-3: what payloads derive from a resource's values."""
    names = ["canonical_mem_used_pct", "canonical_iowait_pct", "canonical_ddos_signal", "canonical_burst_balance_pct"]
    none = F.create_map().cast("map<string,string>")
    return F.map_concat(*[F.when(now[n].isNotNull(), details.payload(category, F.lit(n), now[n], risk)).otherwise(none) for n in names])


def predictions(rows: DataFrame, profiles: DataFrame, priors: DataFrame, models: DataFrame, features: dict[str, list[str]], now: DataFrame, bursty: tuple[str, ...] = (), most_minutes: float = 1440, least_hours: float = 24) -> DataFrame:
    """D-1: one prediction per metric that a resource reports: identity, gate, risk and alert, live forecast with its
    back-test, failures, advice, payload, profile and summary. A gate's advice replaces all other; a pool whose level has
    shifted adds its own. Nulls among readings aren't read; an empty table gives no rows."""
    x = known(rows, profiles, priors, models, features, now, most_minutes, least_hours)
    keys = forecast.KEYS
    ahead = forecast.forecasts(rows.where("value is not null"), x.select(*keys, "prior", "pool"), bursty, keys, x.select(*keys, "mixed"))
    y = x.drop("prior", "pool", "n").join(ahead, keys)
    failures = predict.failures(F.col("category"), F.col("feature"), F.col("now"), F.col("f_1h"), F.col("f_6h"))
    line = {k: F.col(k) for k in ("current", "trend", "reliability", "f_24h", "f_7d")}
    advice = predict.advice(F.col("category"), F.col("feature"), F.col("now"), line, F.col("score"))
    advice = F.when(F.col("gate") != "normal", F.array("gate_advice")).otherwise(F.when(F.col("shifted"), F.concat(advice, F.array(F.lit("review_baseline_shift")))).otherwise(advice))
    return y.withColumns({
        "failures": failures, "advice": advice, "payload": predict.shown(F.col("category"), F.col("now")), "derived": derived(F.col("category"), F.col("now"), F.col("risk")),
        "prediction_type": details.prediction_type(F.col("score"), F.col("trend")), "summary": details.summary(F.col("resource_id"), F.col("feature"), F.col("value"), F.col("severity"), F.col("trend")),
        "badge": C.badge(F.col("risk")), "channel": C.channel(F.col("severity")), "group_key": F.concat_ws("::", "account_id", "category"),
    })
