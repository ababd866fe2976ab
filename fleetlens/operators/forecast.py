"""Forecast operators: native columns where SQL can say it, series mathematics in Arrow batches of many whole series."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.functions import many as M
from fleetlens.functions import series as S
from fleetlens.functions import vocabulary as V

KEYS = ["resource_id", "category", "feature"]


def with_hours(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Adds x, hours since the series' first reading."""
    return rows.withColumn("x", C.hours_between(F.min("ts").over(Window.partitionBy(*keys)), F.col("ts")))


def ols(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """T-1."""
    out = with_hours(rows, keys).groupBy(*keys).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), (F.max("x") - F.min("x")).alias("xr"), F.regr_slope("value", "x").alias("s"), F.regr_intercept("value", "x").alias("i"))
    flat = (F.col("n") < 2) | (F.col("xr") < 1e-9)
    return out.select(*keys, "n", F.when(flat, 0.0).otherwise(F.col("s")).alias("slope"), F.when(flat, F.col("mean")).otherwise(F.col("i")).alias("intercept"))


def naive_last(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """T-6."""
    return rows.groupBy(*keys).agg(F.max_by("value", F.struct("ts", "event_id")).alias("last"))


def moving_average(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """T-7."""
    w = Window.partitionBy(*keys)
    x = rows.withColumn("back", F.row_number().over(w.orderBy(F.desc("ts"), F.desc("event_id")))).withColumn("n", F.count("*").over(w))
    width = F.least(F.lit(7), F.greatest(F.lit(3), F.floor(F.col("n") / 2)))
    return x.where(F.col("back") <= width).groupBy(*keys).agg(F.avg("value").alias("level"))


def seasonal_phase(rows: DataFrame, offsets: list[int], keys: list[str] = KEYS) -> DataFrame:
    """T-5: median, p10 and p90 of each target hour's phase."""
    x = with_hours(rows, keys)
    buckets = x.groupBy(*keys, F.pmod(F.rint("x").cast("long"), F.lit(24)).alias("phase")).agg(F.count("*").alias("n"), F.percentile("value", F.array(F.lit(0.5), F.lit(0.1), F.lit(0.9))).alias("p")).where("n >= 2").drop("n")
    whole = x.groupBy(*keys).agg(F.median("value").alias("middle"), F.max("x").alias("last"))
    targets = whole.select("*", F.explode(F.array(*map(F.lit, offsets))).alias("hours")).withColumn("phase", F.pmod(F.rint(F.col("last") + F.col("hours")).cast("long"), F.lit(24)))
    got = targets.join(buckets, [*keys, "phase"], "left")
    return got.select(*keys, "hours", *[F.coalesce(F.get("p", k), "middle").alias(n) for k, n in enumerate(("point", "lower", "upper"))])


def mase_scale(rows: DataFrame, keys: list[str] = KEYS, period: int | None = None) -> DataFrame:
    """T-17, W-9: mean step over `period` readings where there are two periods or more, else over one, with a floor."""
    back = lambda k: F.abs(F.col("value") - F.lag("value", k).over(Window.partitionBy(*keys).orderBy("ts", "event_id")))
    out = rows.withColumn("step", back(1)).withColumn("season", back(period or 1)).groupBy(*keys)
    out = out.agg(F.avg("step").alias("one"), F.avg("season").alias("far"), F.count("value").alias("n"), F.avg(F.abs("value")).alias("size"))
    out = out.withColumn("raw", F.when(F.col("n") >= 2 * (period or 1), F.col("far")).otherwise(F.col("one")))
    floor = S.FLOOR * F.col("size")
    value = F.when(F.col("size") <= 1e-9, F.when(F.col("raw") > 1e-9, F.col("raw"))).otherwise(F.greatest(F.col("raw"), floor))
    return out.where("raw is not null").select(*keys, value.alias("scale"), ((F.col("size") > 1e-9) & (F.col("raw") < floor)).alias("floored"))


def drift_halves(rows: DataFrame, keys: list[str] = KEYS, share: float = 0.2) -> DataFrame:
    """W-10."""
    w = Window.partitionBy(*keys)
    x = rows.withColumn("k", F.row_number().over(w.orderBy("ts", "event_id"))).withColumn("n", F.count("*").over(w))
    first = F.col("k") <= F.floor(F.col("n") / 2)
    out = x.groupBy(*keys).agg(F.max("n").alias("n"), F.median(F.when(first, F.col("value"))).alias("a"), F.median(F.when(~first, F.col("value"))).alias("b"))
    change = (F.col("b") - F.col("a")) / F.greatest(F.abs("a"), F.lit(1e-6))
    return out.select(*keys, F.when(F.col("n") < 8, "stable").when(change > share, "increasing").when(change < -share, "decreasing").otherwise("stable").alias("trend"))


def holdout_split(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """W-7: marks the last k points of each series."""
    w = Window.partitionBy(*keys)
    x = rows.withColumn("back", F.row_number().over(w.orderBy(F.desc("ts"), F.desc("event_id")))).withColumn("n", F.count("*").over(w))
    k = F.least(F.lit(S.MOST_HOLDOUT), F.greatest(F.lit(S.LEAST_HOLDOUT), F.rint(F.col("n") * S.HOLDOUT).cast("int")))
    return x.withColumn("held_out", (F.col("n") - k >= S.LEAST_TRAIN) & (F.col("back") <= k)).drop("back")


def time_split(rows: DataFrame, keys: list[str] = ("resource_id",)) -> DataFrame:
    """W-6: the first 80 percent of each resource's rows train."""
    w = Window.partitionBy(*keys)
    x = rows.withColumn("k", F.row_number().over(w.orderBy("ts", "event_id"))).withColumn("n", F.count("*").over(w))
    return x.withColumn("train", F.col("k") <= F.greatest(F.lit(1), F.floor(0.8 * F.col("n")))).drop("k", "n")


def breach_eta(rows: DataFrame, threshold: float, keys: list[str] = KEYS, cap_hours: float = 87_600) -> DataFrame:
    """T-19: hours until the line reaches a threshold: 0 if there now, null if never or too far."""
    now = naive_last(rows, keys)
    out = ols(rows, keys).where("n >= 2").join(now, keys)
    hours = (threshold - F.col("last")) / F.col("slope")
    return out.select(*keys, "last", "slope", F.when(F.col("last") >= threshold, 0.0).when((F.col("slope") > 0) & (hours <= cap_hours), hours).alias("hours"))


def shrunk(slopes: DataFrame, priors: DataFrame, on: list[str]) -> DataFrame:
    """T-20, T-21: slopes (n, slope, range) drawn towards their pool's prior; tier says whether they were."""
    x = slopes.join(priors, on, "left")
    w = F.col("n") / (F.col("n") + 15)
    use = F.col("prior").isNotNull() & (F.col("n") < 20)
    return x.withColumn("shrunk", F.when(use, w * F.col("slope") + (1 - w) * F.col("prior") * F.col("range")).otherwise(F.col("slope"))).withColumn("tier", F.when(~use, "individual").when(F.col("rtype").startswith("other_"), "category_pooled").otherwise("type_pooled"))


def error_proxies(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """T-24: errors of a line over the index, relative to the mean size (1 at least), for series of five points or more."""
    w = Window.partitionBy(*keys)
    x = rows.withColumn("i", (F.row_number().over(w.orderBy("ts", "event_id")) - 1).cast("double"))
    fit = x.groupBy(*keys).agg(F.count("*").alias("n"), F.regr_slope("value", "i").alias("s"), F.regr_intercept("value", "i").alias("c"), F.greatest(F.avg(F.abs("value")), F.lit(1.0)).alias("size")).where("n >= 5")
    e = x.join(fit, keys).withColumn("e", F.col("value") - F.col("s") * F.col("i") - F.col("c"))
    out = e.groupBy(*keys).agg((F.avg(F.abs("e")) / F.first("size")).alias("mae"), (F.sqrt(F.avg(F.col("e") * F.col("e"))) / F.first("size")).alias("rmse"))
    return out.withColumn("mape", F.least(F.lit(1000.0), F.col("mae") * 100))


def confidence(r2: Column, reliability: Column, method: Column, mae: Column, rmse: Column, mape: Column) -> Column:
    """T-25: 0 to 100."""
    good = lambda e: F.greatest(F.lit(0.0), 100 - F.least(F.lit(100.0), e))
    error = F.coalesce((good(mae * 100) + good(rmse * 100) + good(mape)) / 3, F.lit(50.0))
    weight = lambda table, key: F.coalesce(C.literal_map(table)[key], F.lit(0.5))
    score = 45 * r2 + 25 * weight(V.RELIABILITY_WEIGHTS, reliability) + 15 * weight(V.METHOD_WEIGHTS, method) + 0.15 * error
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), score))


# ---------------------------------------------------------------- whole series, many at once

#: So many readings are gathered before their series are worked through.
GATHER = 1 << 17


def starts_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the series of a sorted table start; a null key equals a null."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        a, b = table[key][1:], table[key][:-1]
        new[1:] |= pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy()
    return np.flatnonzero(new)


def whole_series(batches: Iterator[pa.RecordBatch], keys: list[str], gather: int = GATHER) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole series, with where each starts, from batches sorted by keys. What may go on in the next batch is held
    back; a series longer than `gather` is looked at again whenever what is held has doubled."""
    held, n, enough = [], 0, gather
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = starts_of(table, keys)
        if len(starts) > 1:
            yield table[: starts[-1]], starts[:-1]
            held, n = table[starts[-1] :].to_batches(), n - int(starts[-1])
        enough = max(gather, 2 * n)
    if n:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts_of(table, keys)


def of_one_length(table: pa.Table, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(first rows, x, y, together): series of one length as rows of x (hours) and y; those that functions/many.py leaves to
    functions/series.py come alone, as one row."""
    t, y = table["ts"].cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(), table["value"].to_numpy().astype(float)
    size = np.diff(np.append(starts, len(y)))
    odd = (size > M.MOST) | (np.add.reduceat(~(np.abs(y) < M.FAR) | (t == np.iinfo(np.int64).min), starts) > 0)
    for n in np.unique(size[~odd]):
        first = starts[(size == n) & ~odd]
        at = first[:, None] + np.arange(n)
        yield first, (t[at] - t[first, None]) / 3.6e9, y[at], True
    for first, n in zip(starts[odd], size[odd]):
        own = t[first : first + n].view("datetime64[us]")
        yield np.array([first]), ((own - own[0]).astype(np.int64) / 3.6e9)[None], y[None, first : first + n], False


def by_series(rows: DataFrame, keys: list[str], run: Callable, schema: str) -> DataFrame:
    """run over all series of rows (keys, ts, event_id, value and what else it reads): it is given a table of sorted readings,
    first rows, x, y and together (see of_one_length), and yields columns as the schema has them, the keys aside, each with the
    rows that the keys are taken from. Keys come out as strings. A task holds GATHER readings, or one series that is longer."""
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"string": pa.string(), "double": pa.float64(), "long": pa.int64(), "int": pa.int32()}

    def batches(got):
        for table, starts in whole_series(got, keys):
            for group in of_one_length(table, starts):
                for at, columns in run(table, *group):
                    own = [table[k].take(pa.array(at)).combine_chunks() for k in keys] + [pa.array(columns[n], kinds[kind], from_pandas=True) for n, kind in fields]
                    yield pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in own], [*keys, *[n for n, _ in fields]])

    dealt = rows.withColumns({k: F.col(k).cast("string") for k in keys}).repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_last("ts"), F.asc_nulls_last("event_id"))
    return dealt.mapInArrow(batches, ", ".join(f"{k} string" for k in keys) + ", " + schema)


FORECAST_SCHEMA = (
    "n long, current double, method string, trend string, r2 double, reliability string, tier string, note string, "
    + ", ".join(f"f_{h} double, f_{h}_lower double, f_{h}_upper double" for h in S.HORIZONS)
    + ", backtest_n int, backtest_mae double, backtest_mase double, backtest_coverage double, backtest_quality double, backtest_method string, trimmed int"
)


def _live_columns(live: dict) -> dict:
    out = {k: live[k] for k in ("method", "trend", "r2", "reliability", "tier", "note")}
    for k, h in enumerate(S.HORIZONS):
        out |= {f"f_{h}{end}": np.round(live[side][:, k], 3) for end, side in (("", "point"), ("_lower", "lower"), ("_upper", "upper"))}
    return out


def _tested(out: dict, test: dict | None, m: int) -> dict:
    """Columns with those of the back-test, whose quality becomes r2 and the reliability; nulls where there is none."""
    names = {"n": "holdout_n", "mae": "mae", "mase": "mase", "coverage": "coverage_pct", "quality": "quality", "method": "method"}
    if test is None:
        return out | {f"backtest_{k}": [None] * m for k in names} | {"trimmed": [None] * m}
    good = test["quality"]
    trust = np.where((good >= 80) & ~test["low_variance"], "high", np.where(good >= 50, "moderate", "low"))
    return out | {"reliability": trust, "r2": good / 100, "trimmed": test["trimmed"]} | {f"backtest_{k}": test[v] for k, v in names.items()}


def _forecast(bursty: tuple[str, ...]):
    def run(table, first, x, y, together):
        m, n = y.shape
        feature, rtype, mixed, prior, pool = (np.array(table[c].take(pa.array(first)).to_pylist(), object) for c in ("feature", "rtype", "mixed", "prior", "pool"))
        known = M.Series(
            np.isin(feature.astype(str), bursty), np.array([str(f).endswith("_pct") for f in feature]), mixed.astype(bool), np.array([np.nan if p is None else p for p in prior], float),
            np.array([p or 0 for p in pool], np.int64), np.array([not str(r).startswith("other_") for r in rtype]),
        )
        if together:
            live, test = vars(M.live(x, y, known)), M.backtest(x, y, known.bursty)
            if test:
                test["holdout_n"] = np.full(m, test["holdout_n"])
        else:
            noisy = bool(known.bursty[0])
            live = {k: np.array([v]) for k, v in S.live(x[0], y[0], noisy, bool(known.percent[0]), bool(known.mixed[0]), known.prior(0)).items()}
            test = S.backtest(x[0], y[0], noisy)
            test = test and {k: np.array([np.nan if v is None else v]) for k, v in test.items()}
        yield first, _tested(_live_columns(live), test, m) | {"n": np.full(m, n), "current": y[:, -1]}

    return run


def forecasts(rows: DataFrame, priors: DataFrame, bursty: tuple[str, ...] = (), on: list[str] = ("rtype", "category", "feature"), mixed: DataFrame | None = None) -> DataFrame:
    """T-22, T-23 and T-16 for every series of rows (with rtype): one row each, with five horizons and a back-test. Series of
    one length are worked through together. mixed: KEYS and whether the series mixes statistics."""
    joined = rows.select("resource_id", "category", "feature", "rtype", "ts", "event_id", "value").join(priors, list(on), "left")
    joined = joined.join(mixed, KEYS, "left").withColumn("mixed", C.is_true(F.col("mixed"))) if mixed is not None else joined.withColumn("mixed", F.lit(False))
    out = by_series(joined, KEYS, _forecast(tuple(bursty)), FORECAST_SCHEMA)
    proxies = error_proxies(rows)
    scored = out.join(proxies, KEYS, "left")
    return scored.withColumn("confidence", F.round(confidence(F.col("r2"), F.col("reliability"), F.col("method"), F.col("mae"), F.col("rmse"), F.col("mape")), 1)).drop("mae", "rmse", "mape")


def candidates(rows: DataFrame, names: list[str], hours: list[int], keys: list[str] = KEYS) -> DataFrame:
    """T-2, T-8 to T-12: forecasts of single candidates, long: method, hours, point, lower, upper."""

    def run(table, first, x, y, together):
        at = x[:, -1:] + np.array(hours, float)
        for name in names:
            if together:
                guess = M.CANDIDATES[name](x, y, at)
                if guess is None:
                    continue
                there = np.ones(len(y), bool) if guess.there is None else guess.there
                point, (low, high, _) = guess.point, M.band(guess, y, at)
            else:
                guess = S.CANDIDATES[name](x[0], y[0], at[0])
                if guess is None:
                    continue
                there, point, (low, high, _) = np.ones(1, bool), guess.point[None], S.band(guess, y[0], at[0])
                low, high = low[None], high[None]
            many = int(there.sum())
            yield np.repeat(first[there], len(hours)), {"method": [name] * (many * len(hours)), "hours": np.tile(hours, many), "point": point[there].ravel(), "lower": low[there].ravel(), "upper": high[there].ravel()}

    return by_series(rows.select(*keys, "ts", "event_id", "value"), keys, run, "method string, hours int, point double, lower double, upper double")


def breaks(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """T-14 for every series: where it breaks (null: nowhere) and its bootstrap slope bounds."""

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts", "event_id"])
        t = pdf["ts"].to_numpy("datetime64[us]")
        x, y = (t - t[0]).astype(np.int64) / 3.6e9, pdf["value"].to_numpy(float)
        mid, low, high = S.bootstrap_slope(x, y)
        return pd.DataFrame([(*pdf.iloc[0][keys], len(y), S.level_break(x, y, S.DAY), mid, low, high)], columns=[*keys, "n", "break_at", "slope", "slope_low", "slope_high"])

    return rows.groupBy(*keys).applyInPandas(per_series, ", ".join(f"{k} string" for k in keys) + ", n long, break_at int, slope double, slope_low double, slope_high double")
