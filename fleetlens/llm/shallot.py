"""Exact k-means over integer vectors by Shallot search.

Each vector remembers its nearest and second-nearest centroid, an upper bound of the distance to the first and a lower
bound of the distance to all others. Where a round's moves leave the bounds apart, nothing is computed. Else the search
starts from the closer of the two remembered centroids and walks its neighbours by rising distance, inside a ball of
d(vector, start) + d(vector, second found so far), which shrinks with every nearer second; survivors are compared by
their squared distances in integers, so ties and results are exact whatever the bounds' rounding.

A round is one pass without a shuffle: it writes vectors with their bounds to the shared folder, and with each Arrow
batch the sums that its moved vectors add to and take from centroids. Only those sums, k * dims numbers, reach the driver.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import cut, drop_cut
from fleetlens.llm.vectors import DIGITS, NARROW, digits, integers, totals, unpacked

STATE = f"vec_id long, x binary, a int, b int, u double, l double, delta {DIGITS}"
#: Bounds are widened by this factor, far more than a square root and a sum can be off.
UP, DOWN = 1 + 1e-11, 1 - 1e-11
_DELTA = pa.list_(pa.struct([("g", pa.int32()), ("i", pa.int32()), ("limb", pa.int32()), ("v", pa.int64())]))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    gap = x - c
    return np.einsum("ij,ij->i", gap, gap) if gap.dtype != object else (gap * gap).sum(1)


class Search:
    """A round's centroids with their neighbours by distance, and how far each moved since the round before."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None):
        self.wide = any(abs(v) > NARROW for c in centroids + (before or []) for v in c)
        self.c = np.array(centroids, object if self.wide else np.int64)
        k = len(centroids)
        if self.wide or k == 1:
            return
        gaps = np.sqrt(np.array([squared(self.c, c) for c in self.c], np.float64))
        order = np.argsort(gaps, axis=1, kind="stable")
        self.order = order[order != np.arange(k)[:, None]].reshape(k, k - 1)
        self.gaps = np.take_along_axis(gaps, self.order, 1) * DOWN
        self.half = self.gaps[:, 0] / 2 * DOWN
        moved = np.sqrt(squared(self.c, np.array(before, np.int64)).astype(np.float64)) * UP if before else np.zeros(k)
        self.moved, top = moved, int(moved.argmax())
        self.others = np.full(k, moved[top])
        self.others[top] = np.delete(moved, top).max()

    def plain(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid by all distances, for integers beyond 64-bit arithmetic."""
        x = x.astype(object)
        all_ = np.array([squared(x, c) for c in self.c.astype(object)], object).reshape(len(self.c), len(x))
        best = [min(range(len(self.c)), key=lambda j: (all_[j, i], j)) for i in range(len(x))]
        return np.array(best, np.int32), np.array([all_[j, i] for i, j in enumerate(best)], object)

    def assign(self, x: np.ndarray, a: np.ndarray, b: np.ndarray, u: np.ndarray, low: np.ndarray):
        """The state after this round; the arrays given are not changed."""
        if self.wide or x.dtype == object or len(self.c) == 1:
            best = np.zeros(len(x), np.int32) if len(self.c) == 1 else self.plain(x)[0]
            return best, (best == 0).astype(np.int32), np.full(len(x), np.inf), np.zeros(len(x))
        a, b, u, low = a.copy(), b.copy(), (u + self.moved[a]) * UP, (low - self.others[a])
        low -= np.abs(low) * (1 - DOWN)
        i = np.flatnonzero(~(u < np.maximum(low, self.half[a])))
        d1 = squared(x[i], self.c[a[i]])
        u[i] = np.sqrt(d1) * UP
        left = ~(u[i] < np.maximum(low[i], self.half[a[i]]))
        i, d1 = i[left], d1[left]
        first, second = a[i], b[i]
        d2 = squared(x[i], self.c[second])
        turn = (d2 < d1) | (d2 == d1) & (second < first)
        first, second, d1, d2 = np.where(turn, second, first), np.where(turn, first, second), np.where(turn, d2, d1), np.where(turn, d1, d2)
        start, reach, live = first.copy(), np.sqrt(d1), np.arange(len(i))
        for j in range(len(self.c) - 1):
            live = live[self.gaps[start[live], j] <= (reach[live] + np.sqrt(d2[live])) * UP]
            if not len(live):
                break
            other = self.order[start[live], j]
            d = squared(x[i[live]], self.c[other])
            nearer = (d < d1[live]) | (d == d1[live]) & (other < first[live])
            p, q = live[nearer], live[~nearer & (d < d2[live])]
            second[p], d2[p] = first[p], d1[p]
            first[p], d1[p] = other[nearer], d[nearer]
            at = ~nearer & (d < d2[live])
            second[q], d2[q] = other[at], d[at]
        a[i], b[i], u[i], low[i] = first, second, np.sqrt(d1) * UP, np.sqrt(d2) * DOWN
        return a, b, u, low


def _moves(x: np.ndarray, was: np.ndarray, now: np.ndarray) -> list[dict]:
    """What the vectors that changed their centroid add to and take from sums (place i) and counts (place -1)."""
    out, moved = [], np.flatnonzero(was != now)
    for g in np.union1d(was[moved], now[moved]).tolist():
        if g < 0:
            continue
        come, go = moved[now[moved] == g], moved[was[moved] == g]
        sums = x[come].sum(0) - x[go].sum(0)
        out += digits([g] * (len(sums) + 1), [-1, *range(len(sums))], [len(come) - len(go), *sums.tolist()])
    return out


def _round(batches, dims: int, centroids, before):
    search = Search(centroids, before)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = unpacked(batch.column("x"), dims)
        was, b, u, low = (batch.column(c).to_numpy(zero_copy_only=False) for c in "abul")
        a, b, u, low = search.assign(x, np.maximum(was, 0), b, u, low)
        moved = _moves(x, was, a)
        delta = pa.array([moved or None] + [None] * (batch.num_rows - 1), _DELTA)
        columns = [batch.column("vec_id"), batch.column("x"), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(u, pa.float64()), pa.array(low, pa.float64()), delta]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "a", "b", "u", "l", "delta"])


def _distances(batches, dims: int, centroids):
    for batch in batches:
        if not batch.num_rows:
            continue
        x, a = unpacked(batch.column("x"), dims), batch.column("a").to_numpy(zero_copy_only=False)
        wide = x.dtype == object or any(abs(v) > NARROW for c in centroids for v in c)
        c = np.array(centroids, object if wide else np.int64)
        d = squared(x.astype(c.dtype), c[a]).tolist()
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("a"), pa.array([v if v < 1 << 63 else None for v in d], pa.int64())], ["vec_id", "cluster", "distance"])


def fit(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, factor: int = 1024, seed: int = 3) -> tuple[list[list[int]], DataFrame]:
    """The final centroids, and vec_id, cluster and squared distance of every kept vector.

    Kept are the vectors (column embedding) with exactly dims entries, none null or non-finite; entry v counts as
    floor(factor * v). Centroids start as the k kept rows with the smallest sha256 of "seed:vec_id", null ids last, equal
    hashes by the smaller vector; with fewer rows there are fewer centroids. Repeated rows count as often as they stand,
    a distance tie goes to the smaller centroid, an empty centroid stays, other columns are not read, and an empty table
    gives no centroids and no rows. A distance beyond 63 bits (entries of some 10**9) is null; its cluster is right.
    """
    spark = vectors.sparkSession
    kept = cut(integers(vectors.where(F.size("embedding") == dims), factor).select("vec_id", "x"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = kept.orderBy(key.asc_nulls_last(), "x").select("x").limit(k).collect()
    centroids = [unpacked(pa.array([bytes(r.x)]), dims)[0].tolist() for r in starts]
    if not centroids:
        return [], spark.createDataFrame([], "vec_id long, cluster int, distance long")
    state = kept.select("vec_id", "x", F.lit(-1).alias("a"), F.lit(min(1, len(centroids) - 1)).alias("b"), F.lit(float("inf")).alias("u"), F.lit(0.0).alias("l"))
    held, before = kept, None
    sums = [[0] * (dims + 1) for _ in centroids]  # the last entry is the count
    for left in range(rounds, -1, -1):
        new = cut(state.mapInArrow(lambda it, c=centroids, w=before: _round(it, dims, c, w), STATE))
        drop_cut(spark, held)
        held, state = new, new.drop("delta")
        if not left:
            break
        for (g, i), v in totals(new).items():
            sums[g][i] += v
        moved = [[s // t[-1] for s in t[:-1]] if t[-1] else c for t, c in zip(sums, centroids, strict=True)]
        if moved == centroids:  # nothing moves any more: all further rounds would repeat this one
            break
        before, centroids = centroids, moved
    found = cut(state.select("vec_id", "x", "a").mapInArrow(lambda it, c=centroids: _distances(it, dims, c), "vec_id long, cluster int, distance long"))
    drop_cut(spark, held)
    return centroids, found


def op11_shallot_clusters(spark, sf_dir: str) -> DataFrame:
    centroids, found = fit(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(20,0)")))
    each = {r.cluster: r.s for r in found.groupBy("cluster").agg(whole.alias("s")).collect()}
    fits = lambda v: int(v) if v is not None and v < 1 << 63 else None
    total = fits(None if None in each.values() else sum(each.values()))
    rows = [(g, fits(each.get(g, 0)), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for g, c in enumerate(centroids)]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
