"""Registered queries of series mathematics on stretches; their SQL folds each whole series as an ordered list."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import stretches
from fleetlens.plans.base_queries import P_SQL, SPARSE, r6, typed
from fleetlens.plans.registration import query

KEYS, KEY_SQL = ["resource_id", "category", "feature"], "resource_id, category, feature"
AHEAD = [1, 24, 168]


def whole(spark, d):
    """One series per resource: all its readings in time order."""
    return typed(spark, d).withColumn("feature", F.lit("all"))


def rounded(df):
    return df.select(*KEYS, "method", "hours", *[C.r(F.col(c), 5).alias(c) for c in ("point", "lower", "upper")])


def series_sql(value: str = "value") -> str:
    """ls: each series with its values v, hours since its first reading x, sizes and a line."""
    return f"""{P_SQL}, al AS (SELECT * REPLACE ('all' AS feature, {value} AS value), (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY resource_id, category))) / 1e6 / 3600 AS x FROM p),
gp AS (SELECT *, x - lag(x) OVER (PARTITION BY {KEY_SQL} ORDER BY ts, event_id) AS gap FROM al),
ls AS (SELECT {KEY_SQL}, list(value ORDER BY ts, event_id) AS v, list(x ORDER BY ts, event_id) AS xs, count(*) AS n, avg(abs(value)) AS size, median(gap) AS step, max(x) AS t1, CASE WHEN count(*) < 2 OR max(x) < 1e-9 THEN 0.0 ELSE regr_slope(value, x) END AS slope, CASE WHEN count(*) < 2 OR max(x) < 1e-9 THEN avg(value) ELSE regr_intercept(value, x) END AS start FROM gp GROUP BY ALL)"""


def band_sql(name: str, point: str) -> str:
    """From nz (size, noise and what the point needs)."""
    return f"""hz AS (SELECT *, unnest([1, 24, 168]) AS hours FROM nz), pt AS (SELECT *, {point} AS point, 1.28 * CASE WHEN size > 1e-9 AND noise < 0.01 * size THEN 0.01 * size ELSE noise END AS margin FROM hz)
SELECT {KEY_SQL}, '{name}' AS method, hours, round(point + 3.7e-8, 5) AS point, round(point - margin + 3.7e-8, 5) AS lower, round(point + margin + 3.7e-8, 5) AS upper FROM pt"""


SPREAD = "sqrt(greatest(0.0, f.q / n - (f.e / n) * (f.e / n)))"


@query(f"""WITH {series_sql()}, fo AS (SELECT *, list_reduce(list_concat([{{'l': 2 * v[1] - v[2], 's': v[2] - v[1], 'e': 0.0::DOUBLE, 'q': 0.0::DOUBLE, 'y': 0.0::DOUBLE}}], list_transform(v, lambda y: {{'l': 0.0::DOUBLE, 's': 0.0::DOUBLE, 'e': 0.0::DOUBLE, 'q': 0.0::DOUBLE, 'y': y}})),
 lambda a, b: {{'l': a.l + a.s + 0.3 * (b.y - a.l - a.s), 's': a.s + 0.1 * (0.3 * (b.y - a.l - a.s)), 'e': a.e + (b.y - a.l - a.s), 'q': a.q + (b.y - a.l - a.s) * (b.y - a.l - a.s), 'y': 0.0::DOUBLE}}) AS f FROM ls WHERE n >= 2),
nz AS (SELECT *, {SPREAD} AS noise FROM fo), {band_sql('ets_trend', 'f.l + f.s * hours / CASE WHEN step > 1e-9 THEN step ELSE 1.0 END')}""")
def holt_forecasts(spark, d):
    """T-9, T-13."""
    return rounded(stretches.holt(whole(spark, d), AHEAD))


@query(f"""WITH {series_sql()}, tz AS (SELECT *, list_transform(list_zip(v, xs), lambda z: {{'z': 0.0::DOUBLE, 'e': 0.0::DOUBLE, 'q': 0.0::DOUBLE, 'y': z[1], 't': start + slope * z[2]}}) AS r FROM ls WHERE n >= 4),
fo AS (SELECT *, list_reduce(list_concat([{{'z': 2 * v[1] - start, 'e': 0.0::DOUBLE, 'q': 0.0::DOUBLE, 'y': 0.0::DOUBLE, 't': 0.0::DOUBLE}}], r),
 lambda a, b: {{'z': 0.8 * a.z + 0.2 * (2 * b.y - b.t), 'e': a.e + (b.y - (b.t + a.z) / 2), 'q': a.q + (b.y - (b.t + a.z) / 2) * (b.y - (b.t + a.z) / 2), 'y': 0.0::DOUBLE, 't': 0.0::DOUBLE}}) AS f FROM tz),
nz AS (SELECT *, {SPREAD} AS noise FROM fo), {band_sql('theta', '(start + slope * (t1 + hours) + f.z) / 2')}""")
def theta_forecasts(spark, d):
    """T-10, T-13."""
    return rounded(stretches.theta(whole(spark, d), AHEAD))


@query(f"""WITH {series_sql(SPARSE)}, so AS (SELECT *, list_filter(range(1, n + 1), lambda i: v[i] <> 0) AS pos, list_filter(v, lambda y: y <> 0) AS sales FROM ls),
nz AS (SELECT *, list_reduce(sales, lambda a, b: 0.9 * a + 0.1 * b) AS demand, list_reduce(list_transform(range(1, len(pos) + 1), lambda k: (pos[k] - CASE WHEN k = 1 THEN 0 ELSE pos[k - 1] END)::DOUBLE), lambda a, b: 0.9 * a + 0.1 * b) AS wait, list_aggregate(v, 'stddev_pop') AS noise
 FROM so WHERE len(pos) >= 3 AND 1 - len(pos) / n BETWEEN 0.3 AND 0.9), {band_sql('croston', 'CASE WHEN wait > 1e-9 THEN demand / wait ELSE 0.0 END')}""")
def croston_forecasts(spark, d):
    """T-11, T-13: of readings of which those with a small sample count as zero."""
    sparse = whole(spark, d).withColumn("value", F.when(F.col("sample_count") < 40, 0.0).otherwise(F.col("value")))
    return rounded(stretches.croston(sparse, AHEAD))


LOOKS = f"""{series_sql()}, lv AS (SELECT {KEY_SQL}, list_reduce(v, lambda a, b: 0.3 * b + 0.7 * a) AS level, n FROM ls)"""


@query(f"WITH {LOOKS} SELECT {KEY_SQL}, {r6('level')} AS level FROM lv")
def resource_levels(spark, d):
    """T-4 of a resource's whole series."""
    return stretches.level(whole(spark, d)).withColumn("level", C.r(F.col("level")))
