"""Incremental pools (S-4, S-5, S-7 for A-4 to A-6 and A-9): stored states that a run brings up to date from changed documents.

Two tables stand in a folder. `counts` holds how often each value stands in a pool, by weekday and hour; a run adds what
changed, with a minus for what was there before, and the state is the sum over runs. `series` holds what one series makes of
its rows (points, slope, usual gap); a run writes those of changed series anew and the newest run counts. A run's tables are
named by its number and count once its row in `commits` is there, written last, with the cursor in it: a run that broke off
is done again under the same number and leaves no trace. Counts add up, so no pool is read to update it, and quantiles are
those of all values.

Rows need the cursor's column (`merged`), which grows with each change. A row where it is null is never counted; one that
appears below the cursor is counted from the next full sweep on. Replaced or deleted rows are told by `before`.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators.pools import quantiles
from fleetlens.operators.profiles import POOL, series_slopes

SERIES = ["resource_id", *POOL]
CELL = [*POOL, "dow", "hod", "value"]
NONE, CHANGED, FULL = "none", "changed", "full"


def counts(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Values of each pool, weekday and hour with how often they stand there, times sign."""
    told = rows.where("value is not null").select(*POOL, F.weekday("ts").alias("dow"), F.hour("ts").alias("hod"), F.col("value").cast("double").alias("value"))
    return told.groupBy(*CELL).agg((F.count("*") * sign).alias("c"))


def own(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """n, norm_slope (five points or more) and usual (median positive gap) of each of the series in ids; nulls where there
    are none."""
    before = F.lag("ts").over(Window.partitionBy(*SERIES).orderBy("ts", "event_id"))
    gaps = quantiles(rows.withColumn("gap", C.hours_between(before, F.col("ts"))).where("gap > 0"), SERIES, "gap", {"usual": 0.5})
    parts = [ids.select(*SERIES), series_slopes(rows).select(*SERIES, "n", "norm_slope"), gaps.select(*SERIES, "usual")]
    all_ = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
    return all_.groupBy(*SERIES).agg(F.max("n").alias("n"), F.max("norm_slope").alias("norm_slope"), F.max("usual").alias("usual"))


def commits(spark: SparkSession, path: str) -> DataFrame | None:
    """run, base (the first run whose tables still count), kind and cursor of each run that ended; None before the first."""
    try:
        return spark.read.parquet(f"{path}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def last(spark: SparkSession, path: str):
    """The newest commit as a row."""
    found = commits(spark, path)
    return None if found is None else found.orderBy(F.desc("run")).first()


def table(spark: SparkSession, path: str, name: str, commit) -> DataFrame:
    """A table's rows of all runs that count, with their run."""
    return spark.read.option("basePath", f"{path}/{name}").parquet(*[f"{path}/{name}/run={k}" for k in range(commit.base, commit.run + 1)])


def counted(spark: SparkSession, path: str, commit) -> DataFrame:
    return table(spark, path, "counts", commit).groupBy(*CELL).agg(F.sum("c").alias("c")).where("c <> 0")


def series(spark: SparkSession, path: str, commit) -> DataFrame:
    newest = table(spark, path, "series", commit).groupBy(*SERIES).agg(F.max_by(F.struct("n", "norm_slope", "usual"), "run").alias("x"))
    return newest.select(*SERIES, "x.*")


def run(rows: DataFrame, path: str, merged: str = "merged", before: DataFrame | None = None, share: float = 0.5, most: int = 16) -> str:
    """One run; returns what it did. `none`: nothing is newer than the cursor. `changed`: newer rows are counted, those of
    `before` (as they were, of rows that were replaced or deleted since the last run) are taken off, and only their series
    are read again. `full`: at first, or if at least `share` of the stored series changed, all rows are. After `most` runs
    their tables are summed into one. Numbers of series, and the cursor, are all that reaches the driver."""
    spark = rows.sparkSession
    commit = last(spark, path)
    newer = rows.where(F.col(merged) > F.lit(commit.cursor)) if commit else rows
    mark = newer.agg(F.max(merged)).first()[0]
    if mark is None and (before is None or before.isEmpty() or not commit):
        return NONE
    number, mark = commit.run + 1 if commit else 0, commit.cursor if mark is None else mark
    present = rows.where(F.col(merged) <= F.lit(mark))
    newer = newer.where(F.col(merged) <= F.lit(mark))
    kind, base = FULL, number
    if commit:
        ids = newer.select(*SERIES).union(before.select(*SERIES) if before is not None else newer.select(*SERIES).limit(0)).distinct()
        if ids.count() < share * series(spark, path, commit).count():
            kind, base = CHANGED, commit.base
    if kind == FULL:
        ids, delta, touched = present.select(*SERIES).distinct(), counts(present), present
    else:
        delta = counts(newer) if before is None else counts(newer).unionByName(counts(before, -1))
        alike = [F.col(f"p.{c}").eqNullSafe(F.col(f"i.{c}")) for c in SERIES]
        touched = present.alias("p").join(ids.alias("i"), alike, "left_semi")
    fresh = own(touched, ids)
    if kind == CHANGED and number - base >= most:
        kept = series(spark, path, commit).alias("p").join(ids.alias("i"), alike, "left_anti")
        delta, fresh, base = counted(spark, path, commit).unionByName(delta), kept.unionByName(fresh), number
    delta.groupBy(*CELL).agg(F.sum("c").alias("c")).write.mode("overwrite").parquet(f"{path}/counts/run={number}")
    fresh.write.mode("overwrite").parquet(f"{path}/series/run={number}")
    done = spark.range(1).select(F.lit(base).alias("base"), F.lit(kind).alias("kind"), F.lit(mark).alias("cursor"))
    done.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/run={number}")
    return kind


def profile_stats(spark: SparkSession, path: str) -> DataFrame:
    """A-4 from the stored counts."""
    cells = counted(spark, path, last(spark, path))
    moments = cells.groupBy(*POOL).agg(F.sum("c").alias("n"), (F.sum(F.col("value") * F.col("c")) / F.sum("c")).alias("mean"))
    off = cells.alias("a").join(moments.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in POOL])
    sd = F.sqrt(F.sum(F.col("c") * F.pow(F.col("value") - F.col("mean"), 2)) / F.first("b.n"))
    out = off.groupBy(*[F.col(f"a.{c}") for c in POOL]).agg(F.first("b.n").alias("n"), F.first("mean").alias("mean"), sd.alias("sd")).where("n >= 5")
    ends = quantiles(cells, POOL, "value", {"p5": 0.05, "p95": 0.95}, "c")
    return out.alias("a").join(ends.drop("n").alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in POOL]).select("a.*", "p5", "p95")


def diurnal(spark: SparkSession, path: str) -> DataFrame:
    """A-5 from the stored counts."""
    return quantiles(counted(spark, path, last(spark, path)), [*POOL, "dow", "hod"], "value", {"expected": 0.5}, "c").where("n >= 2")


def cadence(spark: SparkSession, path: str) -> DataFrame:
    """A-6 from the stored series."""
    return quantiles(series(spark, path, last(spark, path)), POOL, "usual", {"cadence_hours": 0.5}).withColumnRenamed("n", "resources")


def slope_priors(spark: SparkSession, path: str) -> DataFrame:
    """A-9 from the stored series."""
    return quantiles(series(spark, path, last(spark, path)), POOL, "norm_slope", {"prior": 0.5}).withColumnRenamed("n", "pool")
