"""Registered queries of incremental pools: events in three stages, some of them replaced, over four runs."""

from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import incremental
from fleetlens.operators.profiles import POOL
from fleetlens.plans.base_queries import CADENCE_SQL, DIURNAL_SQL, P_SQL, SLOPE_SQL, r6, typed
from fleetlens.plans.registration import query
from fleetlens.sources.shared import new_path

#: When a row is merged: every eleventh at the end, the last days of a quarter of the resources before that.
STAGE = "CASE WHEN event_id % 11 = 0 THEN 2 WHEN substring(resource_id, 2)::BIGINT % 4 = 0 AND {day}(ts) > 15 THEN 1 ELSE 0 END"
#: Rows of that quarter that come with a wrong value first.
WRONG = "substring(resource_id, 2)::BIGINT % 4 = 0 AND event_id % 13 = 0"
ALL = "rtype, category, feature"
PARTS = [x[len(P_SQL) :] for x in (DIURNAL_SQL, CADENCE_SQL, SLOPE_SQL)]


def after_runs(spark, d) -> tuple[str, list[str]]:
    """The folder of states after all runs, and what each run did."""
    rows = typed(spark, d).withColumn("merged", F.expr(STAGE.format(day="day")))
    wrong = F.expr(WRONG) & (F.col("merged") == 0)
    raised = F.col("value") + 50
    path = new_path(spark, "pools")
    first = rows.withColumn("value", F.when(wrong, raised).otherwise(F.col("value"))).where("merged = 0")
    right = rows.withColumn("merged", F.when(wrong, 1).otherwise(F.col("merged")))
    before = rows.where(wrong).withColumn("value", raised)
    did = [incremental.run(first, path), incremental.run(first, path), incremental.run(right.where("merged <= 1"), path, before=before), incremental.run(right, path)]
    return path, did


@query(f"""WITH {P_SQL}{"".join(PARTS)}, st AS (SELECT *, {STAGE.format(day="day")} AS merged FROM p), k AS (SELECT DISTINCT resource_id, category, feature, merged, {WRONG} AS wrong FROM st)
SELECT 'mean' AS what, {ALL}, -1 AS bucket, count(value) AS n, {r6("avg(value)")} AS x FROM p GROUP BY {ALL} HAVING count(value) >= 5
UNION ALL SELECT 'sd', {ALL}, -1, count(value), {r6("stddev_pop(value)")} FROM p GROUP BY {ALL} HAVING count(value) >= 5
UNION ALL SELECT 'p95', {ALL}, -1, count(value), {r6("quantile_cont(value, 0.95)")} FROM p GROUP BY {ALL} HAVING count(value) >= 5
UNION ALL SELECT 'diurnal', {ALL}, dow * 24 + hod, n, {r6("expected")} FROM di
UNION ALL SELECT 'cadence', {ALL}, -1, resources, {r6("cadence_hours")} FROM ca
UNION ALL SELECT 'prior', {ALL}, -1, count(*), {r6("median(norm_slope)")} FROM sl WHERE n >= 5 GROUP BY {ALL}
UNION ALL SELECT 'full', '', '', '', 0, count(DISTINCT (resource_id, category, feature)), 0 FROM k WHERE merged = 0
UNION ALL SELECT 'none', '', '', '', 1, 0, 0
UNION ALL SELECT 'changed', '', '', '', 2, count(DISTINCT (resource_id, category, feature)), 0 FROM k WHERE merged = 1 OR merged = 0 AND wrong
UNION ALL SELECT 'full', '', '', '', 3, count(DISTINCT (resource_id, category, feature)), 0 FROM k""")
def incremental_pools(spark, d):
    """S-7 with A-4 to A-6 and A-9: a full sweep, a run without news, one of changed series, a full sweep; what each did
    with the number of series it read, and the pools that stand at the end."""
    path, did = after_runs(spark, d)
    stats, none = incremental.profile_stats(spark, path), F.lit(-1).alias("bucket")
    one = lambda t, what, bucket, n, x: t.select(F.lit(what).alias("what"), *POOL, bucket, F.col(n).alias("n"), C.r(F.col(x)).alias("x"))
    out = [one(stats, what, none, "n", what) for what in ("mean", "sd", "p95")]
    out.append(one(incremental.diurnal(spark, path), "diurnal", (F.col("dow") * 24 + F.col("hod")).alias("bucket"), "n", "expected"))
    out.append(one(incremental.cadence(spark, path), "cadence", none, "resources", "cadence_hours"))
    out.append(one(incremental.slope_priors(spark, path), "prior", none, "pool", "prior"))
    number = 0
    for at, what in enumerate(did):
        read = F.lit(0).cast("long") if what == incremental.NONE else None
        runs = spark.range(1) if read is not None else spark.read.parquet(f"{path}/series/run={number}").agg(F.count("*").alias("n"))
        number += read is None
        out.append(runs.select(F.lit(what).alias("what"), *[F.lit("").alias(c) for c in POOL], F.lit(at).alias("bucket"), (F.col("n") if read is None else read).alias("n"), F.lit(0.0).alias("x")))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole
