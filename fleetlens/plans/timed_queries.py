"""Registered queries of timed state: events arrive in three parts, every seventh one part after its time."""

from datetime import timedelta

from pyspark.sql import functions as F

from fleetlens.plans.base_queries import P_SQL, typed
from fleetlens.plans.registration import query
from fleetlens.sources.shared import new_path
from fleetlens.streaming import jobs, timed

PART = "least(2, (dayofmonth(ts) - 1) div 10 + if(event_id % 7 = 0, 1, 0))"
LEVEL = "CASE WHEN value >= 100 THEN 'CRITICAL' WHEN value >= 20 THEN 'WARNING' ELSE 'INFO' END"
#: mark: the watermark, in milliseconds, that a part meets: the greatest time of earlier parts less five days, 0 at first.
A_SQL = f"""{P_SQL}, d AS (SELECT *, epoch_ms(ts) AS ms, {LEVEL} AS severity, least(2, (day(ts) - 1) // 10 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS part FROM p),
tops AS (SELECT part, max(ms) AS top FROM d GROUP BY part), ends AS (SELECT max(top) - 432000000 AS finish FROM tops),
a AS (SELECT d.*, greatest(0, coalesce((SELECT max(top) FROM tops WHERE tops.part < d.part) - 432000000, 0)) AS mark FROM d)"""
FIVE, LATENESS = timedelta(days=5), "5 days"


def run(spark, d, build):
    """The parts one by one through the stream that `build` makes of them, each in a run of its own that goes on where the
    last one ended."""
    rows = typed(spark, d).withColumn("part", F.expr(PART)).withColumn("severity", F.expr(LEVEL)).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("version", F.col("event_id"))
    path = new_path(spark, "timed")
    for part in range(3):
        rows.where(F.col("part") == part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        jobs.run_once(build(stream), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query(f"""WITH {A_SQL}, o AS (SELECT *, lag(severity) OVER w AS was, lag(ms) OVER w AS was_ms FROM a, ends WHERE ms >= mark AND ms < finish WINDOW w AS (PARTITION BY resource_id, category ORDER BY ts, severity)),
c AS (SELECT *, CASE WHEN ms - was_ms > 432000000 THEN NULL ELSE was END AS previous FROM o)
SELECT 'change' AS kind, resource_id, category, ts, severity, previous FROM c WHERE previous IS DISTINCT FROM severity
UNION ALL SELECT 'late', resource_id, category, ts, severity, NULL FROM a WHERE ms < mark""")
def timed_alert_changes(spark, d):
    """R-8, R-10: changes in order of time, whatever the order of arrival; late rows beside them."""
    out = run(spark, d, lambda s: timed.alert_changes(s, ["resource_id", "category"], lateness=LATENESS, quiet=FIVE))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(f"""WITH {A_SQL}, n AS (SELECT resource_id, feature, arg_max(value, event_id) AS value, max(event_id) AS version, max(ms) AS heard FROM a WHERE ms >= mark GROUP BY ALL)
SELECT resource_id, feature, version, value, CASE WHEN heard + 432000000 < finish THEN 'quiet' ELSE 'state' END AS kind FROM n, ends UNION ALL SELECT resource_id, feature, event_id, value, 'late' FROM a WHERE ms < mark""")
def timed_latest_state(spark, d):
    """R-3, R-8: each key's newest value and whether its state is held or was let go (quiet); rows set aside beside them."""
    out = run(spark, d, lambda s: timed.latest_state(s, ["resource_id", "feature"], "ts", "version", {"value": "double"}, LATENESS, FIVE))
    held = out.where("kind <> 'late'").groupBy("resource_id", "feature").agg(F.max_by(F.struct("version", "value", "kind"), F.struct("at", "version", F.col("kind") == "quiet")).alias("x"))
    return held.select("resource_id", "feature", "x.*").unionByName(out.where("kind = 'late'").select("resource_id", "feature", "version", "value", "kind"))
