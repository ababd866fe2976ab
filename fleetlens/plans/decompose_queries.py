"""Registered queries of decomposition: the hourly means of each category over the fleet."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import decompose
from fleetlens.plans.base_queries import P_SQL, r6, typed
from fleetlens.plans.registration import query

KEYS = ["category"]


def fleet_hours(spark, d):
    return decompose.hourly(typed(spark, d), KEYS)


@query(f"""WITH {P_SQL}, o AS (SELECT category, ts, arg_min(value, event_id) AS value FROM p WHERE value IS NOT NULL GROUP BY ALL), x AS (SELECT *, CAST(floor((epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY category))) / 1e6 / 3600) AS BIGINT) AS hour FROM o),
h AS (SELECT category, hour, avg(value) AS value FROM x GROUP BY ALL), g AS (SELECT *, lead(hour) OVER w AS upto, lead(value) OVER w AS after FROM h WINDOW w AS (PARTITION BY category ORDER BY hour)), e AS (SELECT *, unnest(range(hour, coalesce(upto, hour + 1))) AS hh FROM g)
SELECT category, hh AS hour, {r6('CASE WHEN hh = hour THEN value ELSE value + (after - value) * (hh - hour) / (upto - hour) END')} AS value, hh > hour AS filled FROM e""")
def hourly_means(spark, d):
    """T-3's input: even steps, gaps on lines."""
    return fleet_hours(spark, d).withColumn("value", C.r(F.col("value")))


@query()
def trend_decomposition(spark, d):
    """T-3: trend, season and rest of every hour."""
    return decompose.decomposed(fleet_hours(spark, d), KEYS)


@query()
def trend_strength(spark, d):
    """T-3: what trend and season explain."""
    return decompose.decomposition_fit(decompose.decomposed(fleet_hours(spark, d), KEYS), KEYS)
