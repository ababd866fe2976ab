"""Integer vectors: which rows count, scaled entries as exact integers, sums of them that Spark adds without overflow.

A vector of integers is a binary value: four bytes an entry where all entries lie within NARROW, else as many bytes an
entry as the widest needs. So equal vectors are equal bytes, and values of any size stay exact: narrow ones in 64-bit
arithmetic, the others in Python's.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Squared distances of vectors within this, of up to 512 entries, fit in 63 bits.
NARROW = 1 << 26
#: Sums travel as digits of so many bits, so that 2**32 partial sums can be added in a long.
DIGIT = 31
DIGITS = "array<struct<g:int,i:int,limb:int,v:bigint>>"


def finite(column: str) -> Column:
    """True for vectors that are not null and hold neither nulls nor anything but finite numbers."""
    bad = F.exists(column, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return F.col(column).isNotNull() & ~F.coalesce(bad, F.lit(False))


def scaled(values: np.ndarray, factor: int) -> np.ndarray:
    """floor(factor * value), exact; int64 where all are narrow, else Python integers. factor is a power of two."""
    if not values.size or np.abs(values).max() < NARROW / factor:
        return np.floor(values * factor).astype(np.int64)
    whole = [int(v) * factor if abs(v) >= 2**53 else int(np.floor(v * factor)) for v in values.ravel().tolist()]
    return np.array(whole, object).reshape(values.shape)


def packed(x: np.ndarray) -> list[bytes]:
    """One binary value for each row."""
    if x.dtype != object:
        rows = np.ascontiguousarray(x.astype("<i4"))
        return [r.tobytes() for r in rows]
    out = []
    for row in x.tolist():
        most = max(map(abs, row), default=0)
        wide = 4 if most <= NARROW else max(5, most.bit_length() // 8 + 1)
        out.append(b"".join(v.to_bytes(wide, "little", signed=True) for v in row))
    return out


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    """The rows' integers, as one matrix: int64 where all rows are narrow, else Python integers."""
    raw = column.to_pylist()
    if all(len(r) == 4 * dims for r in raw):
        return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), dims).astype(np.int64)
    wide = [len(r) // dims for r in raw]
    rows = [[int.from_bytes(r[k : k + w], "little", signed=True) for k in range(0, len(r), w)] for r, w in zip(raw, wide, strict=True)]
    return np.array(rows, object).reshape(len(raw), dims)


def _integers(batches, factor: int):
    for batch in batches:
        lists = batch.column(1)
        sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(sizes)
        out = [b""] * batch.num_rows
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            rows = flat[(ends[at] - d)[:, None] + np.arange(d)]
            wide = np.abs(rows).max(1, initial=0) >= NARROW / factor
            for part in (at[~wide], at[wide]):
                for k, raw in zip(part, packed(scaled(flat[(ends[part] - d)[:, None] + np.arange(d)], factor)), strict=True):
                    out[k] = raw
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dims", "x"])


def integers(vectors: DataFrame, factor: int, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, dims and x, the packed floor(factor * entry), of the finite vectors; as many rows as those."""
    kept = vectors.where(finite(column)).select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    return kept.mapInArrow(lambda it: _integers(it, factor), "vec_id long, dims int, x binary")


def digits(group: list[int], place: list[int], values) -> list[dict]:
    """The non-zero values as rows of DIGITS: value = sum of v << DIGIT * limb over the rows of its (group, place)."""
    out, mask = [], (1 << DIGIT) - 1
    for g, i, v in zip(group, place, values, strict=True):
        v, limb = int(v), 0
        while not -(1 << DIGIT) <= v < 1 << DIGIT:
            out.append({"g": g, "i": i, "limb": limb, "v": v & mask})
            v, limb = v >> DIGIT, limb + 1
        if v:
            out.append({"g": g, "i": i, "limb": limb, "v": v})
    return out


def totals(rows: DataFrame, column: str = "delta") -> dict[tuple[int, int], int]:
    """Exact sums by (group, place) of a column of DIGITS; what reaches the driver is one row a sum and limb."""
    parts = rows.where(F.col(column).isNotNull()).select(F.explode(column).alias("d")).select("d.*").groupBy("g", "i", "limb").agg(F.sum("v").alias("v"))
    out: dict[tuple[int, int], int] = {}
    for r in parts.collect():
        out[r.g, r.i] = out.get((r.g, r.i), 0) + (r.v << DIGIT * r.limb)
    return out
