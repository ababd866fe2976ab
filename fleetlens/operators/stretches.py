"""Series mathematics on stretches: no group is a whole series.

A stretch is what one series reports within some hours. A recurrence with constant weights takes its state affinely through
a stretch, so a stretch is summed up by what it makes of a state: smoothing by (decay, level), Holt by a matrix and a vector
of two. These are folded over a series' stretches in order, which gives each stretch the state it begins with; sums of
errors are then taken within stretches. Slopes, sizes and gaps are plain partial aggregates. Only numbers per stretch, never
readings, meet in one group, so a series may be of any length; a stretch holds what one series reports in `hours`.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import series as S
from fleetlens.operators.forecast import KEYS
from fleetlens.operators.pools import quantiles

HOURS = 24


def stretches(rows: DataFrame, keys: list[str] = KEYS, hours: float = HOURS) -> DataFrame:
    """keys, stretch (its number, by time) and its readings r in order, each with t (hours since 1970) and v; null values
    are left out; readings of one time stand by event_id."""
    t = C.seconds(F.col("ts")) / 3600
    own = rows.where("value is not null").withColumn("_t", t).groupBy(*keys, F.floor(F.col("_t") / hours).alias("stretch"))
    r = F.sort_array(F.collect_list(F.struct(F.col("_t").alias("t"), F.col("event_id").alias("e"), F.col("value").cast("double").alias("v"))))
    return own.agg(r.alias("r"))


def series_totals(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Per series: n, first and last time, mean size, slope and intercept over hours since its first reading (T-1), and its
    first two values."""
    first = parts.groupBy(*keys).agg(F.min(F.get("r", 0).t).alias("t0"), F.max(F.element_at("r", -1).t).alias("t1"), F.slice(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("stretch", F.slice("r", 1, 2).alias("h")))), lambda x: x.h)), 1, 2).alias("head"))
    x, y = lambda p: p.t - F.col("t0"), lambda p: p.v
    total = lambda f: F.sum(F.aggregate("r", F.lit(0.0), lambda a, p: a + f(p)))
    sums = parts.join(first, keys).groupBy(*keys, "t0", "t1", "head").agg(
        F.sum(F.size("r")).alias("n"), total(lambda p: F.abs(p.v)).alias("size"), total(y).alias("sy"), total(x).alias("sx"),
        total(lambda p: x(p) * y(p)).alias("sxy"), total(lambda p: x(p) * x(p)).alias("sxx"),
    )
    n = F.col("n")
    slope = (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.nullif(F.col("sxx") - F.col("sx") * F.col("sx") / n, F.lit(0.0))
    slope = F.when((n < 2) | (F.col("t1") - F.col("t0") < 1e-9), 0.0).otherwise(slope)
    out = sums.withColumn("slope", slope).withColumn("start", (F.col("sy") - F.col("slope") * F.col("sx")) / n)
    return out.select(*keys, "n", "t0", "t1", (F.col("size") / n).alias("size"), "slope", "start", F.get("head", 0).v.alias("y0"), F.get("head", 1).v.alias("y1"))


def usual_step(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Median gap between readings in hours, those across stretches included."""
    end = F.lag(F.element_at("r", -1).t).over(Window.partitionBy(*keys).orderBy("stretch"))  # a row for each stretch
    times = F.transform("r", lambda p: p.t)
    gaps = F.zip_with(times, F.concat(F.array("before"), F.slice(times, 1, F.size("r") - 1)), lambda b, a: b - a)
    each = parts.withColumn("before", end).select(*keys, F.explode(gaps).alias("gap"))
    return quantiles(each, keys, "gap", {"step": 0.5}).select(*keys, "step")


def begin_states(maps: DataFrame, keys: list[str], first: Column, step) -> DataFrame:
    """maps: keys, stretch, m (what a stretch makes of a state) and what `first` needs. Adds to keys and stretch the state
    that it begins with, and after: the state after the last stretch. step(state, m) -> state.

    One row per series passes here, with a few numbers for each of its stretches.
    """
    ordered = maps.groupBy(*keys).agg(F.any_value(first).alias("_first"), F.sort_array(F.collect_list(F.struct("stretch", "m"))).alias("_maps"))
    walk = F.aggregate(
        "_maps",
        F.struct(F.col("_first").alias("now"), F.array().cast(f"array<struct<stretch:bigint,state:{_kind(maps, first)}>>").alias("seen")),
        lambda a, x: F.struct(step(a.now, x.m).alias("now"), F.concat(a.seen, F.array(F.struct(x.stretch.alias("stretch"), a.now.alias("state")))).alias("seen")),
    )
    return ordered.select(*keys, walk.alias("_w")).select(*keys, F.col("_w.now").alias("after"), F.explode("_w.seen").alias("_s")).select(*keys, "after", "_s.stretch", "_s.state")


def _kind(df: DataFrame, column: Column) -> str:
    return df.select(column.alias("c")).schema["c"].dataType.simpleString()


def level(rows: DataFrame, alpha: float = 0.3, keys: list[str] = KEYS, hours: float = HOURS) -> DataFrame:
    """T-4: keys and the last smoothed level. The weights of a reading are powers of 1 - alpha by how many come after it, so
    stretches need their lengths only, and everything is a sum."""
    parts = stretches(rows, keys, hours)
    fold = F.aggregate("r", F.lit(0.0), lambda a, p: (1 - alpha) * a + alpha * p.v)
    whole = Window.partitionBy(*keys)
    later = F.sum("n").over(whole.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1))
    sums = parts.select(*keys, "stretch", F.size("r").alias("n"), fold.alias("s"), F.get("r", 0).v.alias("head"))
    sums = sums.withColumn("later", F.coalesce(later, F.lit(0)))
    first = F.min_by("head", "stretch")
    return sums.groupBy(*keys).agg((F.sum(F.col("s") * F.pow(F.lit(1 - alpha), F.col("later"))) + first * F.pow(F.lit(1 - alpha), F.sum("n"))).alias("level"))


def _errors(parts: DataFrame, keys: list[str], begin: Column, step) -> DataFrame:
    """Per series the deviation of errors; step(state, reading) -> (state, error)."""
    fold = F.aggregate("r", F.struct(begin.alias("s"), F.lit(0.0).alias("e"), F.lit(0.0).alias("q")), lambda a, p: _added(a, *step(a.s, p)))
    sums = parts.select(*keys, F.size("r").alias("n"), fold.alias("f"))
    out = sums.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("f.e").alias("e"), F.sum("f.q").alias("q"))
    mean = F.col("e") / F.col("n")
    return out.select(*keys, F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean)).alias("noise"))


def _added(a: Column, state: Column, error: Column) -> Column:
    return F.struct(state.alias("s"), (a.e + error).alias("e"), (a.q + error * error).alias("q"))


def _banded(x: DataFrame, keys: list[str], name: str, point: Column, ahead: list[int]) -> DataFrame:
    """T-13 for a point forecast with noise."""
    margin = S.Z * F.when((F.col("size") > 1e-9) & (F.col("noise") < S.FLOOR * F.col("size")), S.FLOOR * F.col("size")).otherwise(F.col("noise"))
    out = x.select("*", F.explode(F.array(*map(F.lit, ahead))).alias("hours")).withColumn("point", point).withColumn("margin", margin)
    return out.select(*keys, F.lit(name).alias("method"), F.col("hours").cast("int").alias("hours"), "point", (F.col("point") - F.col("margin")).alias("lower"), (F.col("point") + F.col("margin")).alias("upper"))


def holt(rows: DataFrame, ahead: list[int], alpha: float = 0.3, beta: float = 0.1, keys: list[str] = KEYS, hours: float = HOURS) -> DataFrame:
    """T-9, T-13: Holt's linear trend for series of two readings or more: method, hours, point, lower, upper."""
    parts = stretches(rows, keys, hours)
    known = series_totals(parts, keys).where("n >= 2")

    def update(l, s, v):
        new = l + s + alpha * (v - l - s)
        return new, s + beta * (new - l - s)

    names = ("al", "as", "bl", "bs", "cl", "cs")  # what it makes of (1, 0) and of (0, 1) without readings, and of (0, 0) with them

    def through(a, p):
        out = [*update(a["al"], a["as"], F.lit(0.0)), *update(a["bl"], a["bs"], F.lit(0.0)), *update(a["cl"], a["cs"], p.v)]
        return F.struct(*[c.alias(n) for n, c in zip(names, out, strict=True)])

    unit = F.struct(*[F.lit(v).alias(n) for n, v in zip(names, (1.0, 0.0, 0.0, 1.0, 0.0, 0.0), strict=True)])
    maps = parts.join(known.select(*keys, "y0", "y1"), keys).select(*keys, "stretch", "y0", "y1", F.aggregate("r", unit, through).alias("m"))
    rise = F.col("y1") - F.col("y0")
    first = F.struct((F.col("y0") - rise).alias("l"), rise.alias("s"))  # the first reading takes it to (y0, y1 - y0)
    apply = lambda a, m: F.struct((m["al"] * a.l + m["bl"] * a.s + m["cl"]).alias("l"), (m["as"] * a.l + m["bs"] * a.s + m["cs"]).alias("s"))
    states = begin_states(maps, keys, first, apply)

    def missed(a, p):
        new, rate = update(a.l, a.s, p.v)
        return F.struct(new.alias("l"), rate.alias("s")), p.v - a.l - a.s

    noise = _errors(parts.join(states, [*keys, "stretch"]), keys, F.col("state"), missed)
    after = states.groupBy(*keys).agg(F.any_value("after").alias("after"))
    x = known.join(after, keys).join(noise, keys).join(usual_step(parts, keys), keys)
    return _banded(x, keys, "ets_trend", F.col("after.l") + F.col("after.s") * F.col("hours") / F.when(F.col("step") > 1e-9, F.col("step")).otherwise(1.0), ahead)


def theta(rows: DataFrame, ahead: list[int], alpha: float = 0.2, keys: list[str] = KEYS, hours: float = HOURS) -> DataFrame:
    """T-10, T-13: half a trend line, half the smoothed curve of doubled deviations from it, for series of four readings or
    more: method, hours, point, lower, upper."""
    parts = stretches(rows, keys, hours)
    known = series_totals(parts, keys).where("n >= 4")
    x = parts.join(known.select(*keys, "t0", "slope", "start", "y0"), keys)
    trend = lambda p: F.col("start") + F.col("slope") * (p.t - F.col("t0"))
    fold = F.aggregate("r", F.struct(F.lit(1.0).alias("d"), F.lit(0.0).alias("z")), lambda a, p: F.struct((a.d * (1 - alpha)).alias("d"), ((1 - alpha) * a.z + alpha * (2 * p.v - trend(p))).alias("z")))
    maps = x.select(*keys, "stretch", "start", "y0", fold.alias("m"))
    states = begin_states(maps, keys, 2 * F.col("y0") - F.col("start"), lambda a, m: m.d * a + m.z)
    missed = lambda a, p: ((1 - alpha) * a + alpha * (2 * p.v - trend(p)), p.v - (trend(p) + a) / 2)
    noise = _errors(x.join(states, [*keys, "stretch"]), keys, F.col("state"), missed)
    after = states.groupBy(*keys).agg(F.any_value("after").alias("after"))
    at = F.col("t1") - F.col("t0") + F.col("hours")
    return _banded(known.join(after, keys).join(noise, keys), keys, "theta", (F.col("start") + F.col("slope") * at + F.col("after")) / 2, ahead)


def croston(rows: DataFrame, ahead: list[int], alpha: float = 0.1, keys: list[str] = KEYS, hours: float = HOURS) -> DataFrame:
    """T-11, T-13: mean demand over mean interval, for series with three demands or more of which 30 to 90 % are zero:
    method, hours, point, lower, upper. Stretches carry the place of their last demand, so intervals cross them."""
    parts = stretches(rows, keys, hours)
    by = Window.partitionBy(*keys).orderBy("stretch")  # a row for each stretch
    earlier, later = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    at = F.filter(F.transform("r", lambda p, i: F.struct(i.cast("long").alias("i"), p.v.alias("v"))), lambda x: x.v != 0)
    x = parts.select(*keys, "stretch", F.size("r").alias("n"), at.alias("sales"), F.aggregate("r", F.lit(0.0), lambda a, p: a + p.v).alias("sy"), F.aggregate("r", F.lit(0.0), lambda a, p: a + p.v * p.v).alias("sq"), F.aggregate("r", F.lit(0.0), lambda a, p: a + F.abs(p.v)).alias("size"))
    x = x.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("m", F.size("sales"))
    last = F.when(F.col("m") > 0, F.col("offset") + F.element_at("sales", -1).i)
    x = x.withColumn("before", F.coalesce(F.max(last).over(earlier), F.lit(-1))).withColumn("later", F.coalesce(F.sum("m").over(later), F.lit(0))).withColumn("none_yet", F.coalesce(F.sum("m").over(earlier), F.lit(0)) == 0)
    places = F.transform("sales", lambda s: F.col("offset") + s.i)
    waits = F.zip_with(places, F.concat(F.array(F.col("before")), F.slice(places, 1, F.greatest(F.size("sales") - 1, F.lit(0)))), lambda b, a: (b - a).cast("double"))
    x = x.withColumn("waits", F.when(F.col("m") > 0, waits).otherwise(F.array().cast("array<double>")))
    keep = F.lit(1 - alpha)
    smooth = lambda c, v: F.sum(F.aggregate(c, F.lit(0.0), lambda a, s: (1 - alpha) * a + alpha * v(s)) * F.pow(keep, F.col("later")))
    head = lambda value: F.max(F.when(F.col("none_yet") & (F.col("m") > 0), value)) * F.pow(keep, F.sum("m"))
    y = x.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("sy").alias("sy"), F.sum("sq").alias("sq"), (F.sum("size") / F.sum("n")).alias("size"),
        (smooth("sales", lambda s: s.v) + head(F.get("sales", 0).v)).alias("demand"), (smooth("waits", lambda s: s) + head(F.get("waits", 0))).alias("wait"),
    ).where((F.col("m") >= 3) & (1 - F.col("m") / F.col("n")).between(0.3, 0.9))
    mean = F.col("sy") / F.col("n")
    noise = F.sqrt(F.greatest(F.lit(0.0), F.col("sq") / F.col("n") - mean * mean))  # the rate is a constant
    return _banded(y.withColumn("noise", noise), keys, "croston", F.when(F.col("wait") > 1e-9, F.col("demand") / F.col("wait")).otherwise(0.0), ahead)
