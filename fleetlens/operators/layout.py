"""Layout for several lookups (K-8, S-5): rows ordered along a curve through the ranges of some columns, so that a lookup by
any of them opens few files; Bloom filters for ids."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounds(rows: DataFrame, column: str, bits: int) -> list:
    """Least value of each of at most 2**bits ranges of a column's distinct values; these alone reach the driver. Ranges are
    about equal in distinct values."""
    values = rows.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(2**bits, column)
    least = values.groupBy(F.spark_partition_id().alias("part")).agg(F.min(column).alias("least"))
    return sorted(r.least for r in least.collect())


def place(columns: list[str], ends: list[list], bits: int) -> Column:
    """Place on the curve: the bits of the columns' ranks in turn, the highest first. Nulls come first."""

    def rank_of(column: str, cuts: list) -> Column:
        reached = F.filter(F.array(*map(F.lit, cuts)), lambda b: b <= F.col(column))
        return F.greatest(F.lit(0), F.size(reached) - 1) if cuts else F.lit(0)

    parts = []
    for d, (column, cuts) in enumerate(zip(columns, ends)):
        rank = rank_of(column, cuts)
        parts += [F.shiftleft(F.shiftright(rank, i).bitwiseAND(1).cast("long"), i * len(columns) + len(columns) - 1 - d) for i in range(bits)]
    return sum(parts[1:], parts[0])


def write_curved(rows: DataFrame, path: str, columns: list[str], ids: list[str] = (), files: int = 64, bits: int = 5) -> None:
    """Writes rows to about `files` files along the curve through `columns`, with Bloom filters of `ids`. Rows of one cell
    that is too large for a file are told apart by a hash, so no task holds a hot value; equal rows stay together."""
    ends = [bounds(rows, c, bits) for c in columns]
    spread = rows.withColumn("_place", place(columns, ends, bits)).withColumn("_mix", F.xxhash64(*rows.columns))
    ordered = spread.repartitionByRange(files, "_place", "_mix").sortWithinPartitions("_place", *columns).drop("_place", "_mix")
    writer = ordered.write.mode("overwrite")
    for c in ids:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
