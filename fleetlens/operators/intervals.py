"""Which spans of time hold which rows, by a tree of cells instead of comparing all with all.

A cell of level 0 is a quarter of an hour, one of level 1 four hours (16 of them), one of level 2 sixteen of those. A span is
cut into the fewest cells that cover it; a row looks up the cells of each level that it lies in. Cells of level 2 are dealt to
16 slices, so no key holds the rows of more than about four hours, however long a span is.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import columns as C

TICK, FAN = 900, 16
LEVELS = (2, 1, 0)
KEYS = ["_level", "_cell", "_slice"]


def tick(ts: Column) -> Column:
    return F.floor(C.seconds(ts) / TICK).cast("long")


def slices(level: int) -> int:
    return FAN ** max(0, level - 1)


def cells(spans: DataFrame, start: str, end: str) -> DataFrame:
    """spans, one row for each cell that they touch (KEYS). A span whose end lies before its start, or without one of them,
    touches none."""
    lo, hi = tick(F.col(start)), tick(F.col(end)) + 1
    left = F.array(F.struct(lo.alias("lo"), hi.alias("hi")))
    found = []
    for level in LEVELS:
        size = FAN**level
        cut = F.transform(left, lambda p: F.struct(p.lo.alias("lo"), p.hi.alias("hi"), F.ceil(p.lo / size).cast("long").alias("a"), F.floor(p.hi / size).cast("long").alias("b")))
        whole = F.filter(cut, lambda p: p.a < p.b)
        found.append(F.flatten(F.transform(whole, lambda p: F.transform(F.sequence(p.a, p.b - 1), lambda c: F.struct(F.lit(level).alias("_level"), c.alias("_cell"))))))
        beside = F.flatten(F.transform(whole, lambda p: F.array(F.struct(p.lo.alias("lo"), (p.a * size).alias("hi")), F.struct((p.b * size).alias("lo"), p.hi.alias("hi")))))
        as_is = F.transform(F.filter(cut, lambda p: p.a >= p.b), lambda p: F.struct(p.lo.alias("lo"), p.hi.alias("hi")))
        left = F.filter(F.concat(beside, as_is), lambda p: p.lo < p.hi)
    each = spans.where(F.col(start) <= F.col(end)).select("*", F.explode(F.concat(*found)).alias("_c")).select("*", "_c.*").drop("_c")
    dealt = F.when(F.col("_level") == 2, F.sequence(F.lit(0), F.lit(slices(2) - 1))).otherwise(F.array(F.lit(0)))
    return each.withColumn("_slice", F.explode(dealt))


def places(rows: DataFrame, ts: str, salt: Column, levels: list[int]) -> DataFrame:
    """rows, one for each of the levels, with the cell that ts lies in (KEYS); rows without a time have none. Rows spread
    over slices by salt."""
    t = tick(F.col(ts))
    own = F.array(*[F.struct(F.lit(n).alias("_level"), F.floor(t / FAN**n).cast("long").alias("_cell"), F.pmod(F.xxhash64(salt), F.lit(slices(n))).cast("int").alias("_slice")) for n in levels])
    return rows.where(F.col(ts).isNotNull()).select("*", F.explode(own).alias("_c")).select("*", "_c.*").drop("_c")


def held(rows: DataFrame, spans: DataFrame, ts: str, start: str, end: str, salt: Column) -> DataFrame:
    """Pairs of a row and a span with start <= ts <= end, all columns of both; a pair comes once, as a span's cells don't
    overlap. The levels in use (three at most) come to the driver."""
    touched = cells(spans, start, end)
    levels = sorted(r[0] for r in touched.select("_level").distinct().collect())
    near = places(rows, ts, salt, levels or [0]).join(touched, KEYS)
    return near.where(F.col(ts).between(F.col(start), F.col(end))).drop(*KEYS)
