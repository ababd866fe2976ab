"""Shared helpers of the corpus operators: table access, cutting lineage, byte kernels and connected components."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.sources.shared import cut, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_cut(spark: SparkSession, df: DataFrame) -> None:
    """Deletes a table made by cut() whose readers have all been written."""
    jvm = spark._jvm
    for path in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def test_remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo; the hold-out rule of the learned operators."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


# ---------------------------------------------------------------- byte kernels


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the len+1 offsets of its rows in them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches, rows: int = 1024):
    """The same rows in batches of fewer, so that what a task makes of a batch stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def blocks(offsets: np.ndarray, most: int = 1 << 22):
    """Ranges (first, last+1) of rows holding about `most` bytes each; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (the murmur3 finaliser)."""
    x = x.copy()
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BASE = pow(0x9E3779B97F4A7C15 | 1, 1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, at least n of each; kept between calls."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            np.multiply.accumulate(out, out=out)
            _powers[k : k + 1] = [out]
    return _powers[0][:n], _powers[1][:n]


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Rolling:
    """Hashes of substrings of a byte block; equal substrings have equal hashes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * up[:-1], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def windows(self, k: int) -> np.ndarray:
        """Of every k bytes, by start."""
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[: len(self.sums) - k])


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the smallest node of its component.

    Alternates large-star and small-star steps on the edge table until it stays as it is; each round is written to the shared folder, and
    what reaches the driver is one count. Hub nodes are met by partial aggregation and by AQE's skew join.
    """
    spark = edges.sparkSession
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    stable = False
    while not stable:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v")
        new = cut(small.distinct())
        stable = new.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == now.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_cut(spark, now)
        now = new
    return now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


__all__ = ["Rolling", "blocks", "components", "cut", "drop_cut", "mix", "shared_dir", "slices", "table", "test_remainder", "utf8"]
