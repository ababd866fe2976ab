"""L-2: chunks of a token budget by pointer doubling; no group is a project.

Rows stand in one order over all projects, dealt to parts by ranges of it. Where the chunk that begins at a row ends depends
on prefix sums of tokens alone: it is the row whose tokens span the place `budget` tokens on, or the start of that row's
category. These jumps, composed with themselves, reach all chunks of a project in as many rounds as the number of its chunks
has binary digits.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.sources.shared import cut

SLICES = 16


def in_order(rows: DataFrame, order: list[str], weight: str) -> DataFrame:
    """rows with _part, pos (gapless from 0, by order) and before (sum of weight of all earlier rows). Numbers of parts pass
    through one task, never rows."""
    dealt = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = dealt.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(weight).alias("_w"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_n", "_w")])
    x = dealt.join(F.broadcast(starts), "_part")  # a row for each part
    return x.withColumn("pos", F.col("_n") + F.count("*").over(inside) - 1).withColumn("before", F.col("_w") + F.sum(weight).over(inside) - F.col(weight)).drop("_n", "_w")


def newest(x: DataFrame, name: str, value: Column, own: bool = True) -> DataFrame:
    """x (from in_order) with the last value that isn't null up to each row, or before it where own is false."""
    held = x.withColumn("_v", value)
    some = F.when(F.col("_v").isNotNull(), F.col("pos"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = held.groupBy("_part").agg(F.max_by("_v", some).alias("_e")).select("_part", F.last("_e", True).over(earlier).alias("_e"))
    inside = Window.partitionBy("_part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    return held.withColumn("_l", F.last("_v", True).over(inside)).join(F.broadcast(ends), "_part").withColumn(name, F.coalesce("_l", "_e")).drop("_v", "_l", "_e")


def first_of(x: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """x with the place at which the run of equal keys (nulls are equal) that holds the row begins."""
    was = newest(x, "_was", F.struct(*keys), own=False)
    changed = ~reduce(lambda a, b: a & b, [F.col("_was")[k].eqNullSafe(F.col(k)) for k in keys])
    return newest(was, name, F.when(F.col("_was").isNull() | changed, F.col("pos"))).drop("_was")


def jumps(x: DataFrame, budget: int) -> DataFrame:
    """pos and goal: where the next chunk of the same project begins if one begins at pos; no row where none does."""
    width = max(1, budget // 16)
    after = F.col("before") + F.col("tokens")
    tiles = x.select(F.explode(F.sequence(F.floor(F.col("before") / width), F.floor((after - 1) / width))).alias("tile"), F.col("before").alias("low"), after.alias("high"), F.col("pos").alias("end"), F.col("in_category").alias("c"), F.col("in_project").alias("p"))
    asked = x.select("pos", (F.col("before") + budget).alias("place")).withColumn("tile", F.floor(F.col("place") / width))
    met = asked.join(tiles, "tile").where("place >= low and place < high and p <= pos")
    goal = F.when(F.col("end") == F.col("pos"), F.col("pos") + 1).when(F.col("c") > F.col("pos"), F.col("c")).otherwise(F.col("end"))
    return met.select("pos", goal.alias("goal"))


def token_chunks(rows: DataFrame, budget: int = 2000) -> DataFrame:
    """project, category, resource_id, feature, tokens and chunk (from 0 in its project).

    Rows stand by their category's least rank, category, rank, resource_id, feature, tokens. A chunk ends where the next row
    would take it above the budget, and before a category that wouldn't fit whole into it; only a category above the budget
    is divided. A row above the budget is a chunk of its own. Tokens below one or null count as one; nulls in keys are values
    of their own and come first; a null rank counts as the last. Repeated rows are all kept. No rows: no rows.
    """
    x = rows.select("project", "category", "resource_id", "feature", F.coalesce("rank", F.lit(2**31 - 1)).cast("int").alias("rank"), F.greatest(F.lit(1), F.coalesce("tokens", F.lit(1))).cast("long").alias("tokens"))
    least = x.groupBy("project", "category").agg(F.min("rank").alias("least")).withColumnsRenamed({"project": "_p", "category": "_c"})
    least = least.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))  # a category may hold most rows
    x = x.withColumn("_slice", F.pmod(F.xxhash64("resource_id", "feature"), F.lit(SLICES)).cast("int"))
    x = x.join(least, F.col("project").eqNullSafe(F.col("_p")) & F.col("category").eqNullSafe(F.col("_c")) & (F.col("_slice") == F.col("_s"))).drop("_p", "_c", "_s", "_slice")
    x = in_order(x, ["project", "least", "category", "rank", "resource_id", "feature", "tokens"], "tokens")
    x = cut(first_of(first_of(x, "in_project", ["project"]), "in_category", ["project", "category"]))
    leap, begun, step = cut(jumps(x, budget)), cut(x.where("pos = in_project").select("pos", F.lit(0).alias("chunk"))), 1
    while True:
        found = begun.join(leap, "pos").select(F.col("goal").alias("pos"), (F.col("chunk") + step).alias("chunk"))
        more = cut(begun.union(found).groupBy("pos").agg(F.min("chunk").alias("chunk")))
        # The row after one above the budget may be another project's first: it is known with 0 already.
        if more.count() == begun.count():
            break
        begun, step = more, step * 2
        again = leap.select(F.col("pos").alias("goal"), F.col("goal").alias("_to"))
        leap = cut(leap.join(again, "goal").select("pos", F.col("_to").alias("goal")))  # a goal has at most `budget` rows
    known = x.join(begun, "pos", "left")
    out = newest(known.withColumnRenamed("chunk", "_begun"), "chunk", F.col("_begun"))
    return out.select("project", "category", "resource_id", "feature", "tokens", F.col("chunk").cast("int").alias("chunk"))
