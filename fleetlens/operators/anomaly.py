"""Anomaly scores: residuals against pooled expectations, bursts, and a pooled isolation forest."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions import columns as C
from fleetlens.operators import profiles as P
from fleetlens.operators.pools import quantiles
from fleetlens.sources.shared import cut

SERIES = ["resource_id", *P.POOL]
WINDOW_ROWS, LEAST_ROWS, LEAST_WINDOW = 168, 12, 6


def residuals(rows: DataFrame) -> DataFrame:
    """N-1, J-10: value minus the pool's expectation of that weekday and hour, the pool's mean where there is none.
    Profiles are far smaller than the rows, so Spark may broadcast them; nothing forces it to."""
    d = P.diurnal(rows).select(*P.POOL, "dow", "hod", "expected")
    s = P.profile_stats(rows).select(*P.POOL, "mean", "sd")
    x = rows.withColumn("dow", F.weekday("ts")).withColumn("hod", F.hour("ts")).join(s, P.POOL).join(d, [*P.POOL, "dow", "hod"], "left")
    return x.withColumn("residual", F.col("value") - F.coalesce("expected", "mean"))


def rolling_baseline(rows: DataFrame) -> DataFrame:
    """W-4: mean of the 168 rows before, the series' mean where fewer than six are there."""
    w = Window.partitionBy(*SERIES).orderBy("ts", "event_id").rowsBetween(-WINDOW_ROWS, -1)
    return rows.withColumn("baseline", F.when(F.count("value").over(w) >= LEAST_WINDOW, F.avg("value").over(w)).otherwise(F.avg("value").over(Window.partitionBy(*SERIES))))


def rolling_deviation(res: DataFrame) -> DataFrame:
    """W-5: median over the series of the standard deviation of the 168 residuals before."""
    w = Window.partitionBy(*SERIES).orderBy("ts", "event_id").rowsBetween(-WINDOW_ROWS, -1)
    sd = F.when(F.count("residual").over(w) >= LEAST_WINDOW, F.stddev_samp("residual").over(w))
    return res.withColumn("rolling_sd", sd).groupBy(*SERIES).agg(F.median("rolling_sd").alias("sigma"))


def zscore_signal(res: DataFrame) -> DataFrame:
    """N-2: per resource and time the largest |residual| / pool deviation over its features, over 3.42, from 0 to 1."""
    z = F.max(F.when(F.col("sd") > 0, F.abs("residual") / F.col("sd")))
    n = F.count("*").over(Window.partitionBy("resource_id", "category"))
    counted = res.withColumn("rows", n)
    return counted.groupBy("resource_id", "category", "ts").agg(F.when(F.max("rows") >= LEAST_ROWS, F.least(F.lit(1.0), F.coalesce(z, F.lit(0.0)) / 3.42)).otherwise(0.0).alias("z_signal"))


def burst_signal(rows: DataFrame) -> DataFrame:
    """N-3: largest ratio of maximum to value over the features, from 1 to 50, then (ratio - 1) / 4 from 0 to 1."""
    ratio = F.least(F.lit(50.0), F.greatest(F.lit(1.0), F.coalesce(F.max(F.when(F.col("value") != 0, F.col("vmax") / F.col("value"))), F.lit(1.0))))
    return rows.groupBy("resource_id", "category", "ts").agg(F.least(F.lit(1.0), (ratio - 1) / 4).alias("burst_signal"))


def composite(signals: DataFrame, pool_size=None) -> DataFrame:
    """N-7: weighted score of z_signal, burst_signal and forest_signal (null: no forest, its weight splits 70 to 30)."""
    w = F.when(F.col("forest_signal").isNull(), F.lit(0.0)).otherwise(F.when(pool_size >= 2000, 0.55).otherwise(0.35) if pool_size is not None else F.lit(0.35))
    free = 0.35 - w
    score = (0.45 + 0.7 * free) * F.col("z_signal") + (0.20 + 0.3 * free) * F.col("burst_signal") + w * F.coalesce("forest_signal", F.lit(0.0))
    hot = (F.col("z_signal") > 0.5) | (F.col("burst_signal") > 0.6) | C.is_true(F.col("forest_signal") > 0.55)
    drivers = F.filter(F.array(*[F.when(F.col(f"{n}_signal") > 0.4, F.lit(n)) for n in ("z", "burst", "forest")]), lambda x: x.isNotNull())
    return signals.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))).withColumn("dominant", hot).withColumn("drivers", drivers)


# ---------------------------------------------------------------- isolation forest

TREES, SAMPLE, LEAST_POOL = 200, 1024, 100


def _length(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, seed: int = 42, trees: int = TREES) -> list[np.ndarray]:
    """Trees as arrays of (feature or -1, threshold, left child, right child, points), grown level by level: all nodes of
    a level are cut at once."""
    rng = np.random.default_rng(seed)
    n, width = min(SAMPLE, len(x)), x.shape[1]
    most = max(1, int(np.ceil(np.log2(max(n, 2)))))
    forest = []
    for _ in range(trees):
        part = x[rng.choice(len(x), n, replace=False)]
        at = np.zeros(n, np.int64)
        tree = np.array([[-1.0, 0, 0, 0, n]])
        level = np.array([0])
        for _ in range(most):
            order = np.argsort(at, kind="stable")
            rows, nodes = part[order], at[order]
            first = np.searchsorted(nodes, level)
            low, high = np.minimum.reduceat(rows, first), np.maximum.reduceat(rows, first)
            luck = np.where(high > low, rng.random((len(level), width)), -1.0)
            f = luck.argmax(1)
            open_ = luck.max(1) >= 0
            if not open_.any():
                break
            pick = np.flatnonzero(open_)
            ids, f = level[pick], f[pick]
            cut = rng.uniform(low[pick, f], high[pick, f])
            left = len(tree) + 2 * np.arange(len(ids))
            tree[ids, :4] = np.stack([f, cut, left, left + 1], 1)
            slot = np.full(len(tree), -1)
            slot[ids] = np.arange(len(ids))
            moving = np.flatnonzero(slot[at] >= 0)
            k = slot[at[moving]]
            at[moving] = left[k] + (part[moving, f[k]] > cut[k])
            sizes = np.bincount(at[moving] - len(tree), minlength=2 * len(ids))
            new = np.zeros((2 * len(ids), 5))
            new[:, 0], new[:, 4] = -1, sizes
            level = len(tree) + np.flatnonzero(sizes)
            at_done = np.isin(at, level)
            tree = np.concatenate([tree, new])
            part, at = part[at_done], at[at_done]
        forest.append(tree)
    return forest


def isolation_score(forest: list[np.ndarray], x: np.ndarray, sample: int) -> np.ndarray:
    """2 to the minus mean depth over the expected one; near 1: set apart."""
    depth = np.zeros(len(x))
    for tree in forest:
        at = np.zeros(len(x), int)
        for _ in range(64):
            inner = np.flatnonzero(tree[at, 0] >= 0)
            if not len(inner):
                break
            node = tree[at[inner]]
            go_left = x[inner, node[:, 0].astype(int)] <= node[:, 1]
            at[inner] = np.where(go_left, node[:, 2], node[:, 3]).astype(int)
            depth[inner] += 1
        depth += _length(tree[at, 4])
    return 2.0 ** (-depth / len(forest) / max(float(_length(np.array([sample]))[0]), 1e-9))


def matrix(lists) -> np.ndarray:
    """A column of equally long arrays of numbers as rows."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def forest_features(res: DataFrame) -> DataFrame:
    """N-4: per resource and time an array x: the residual of each feature, then each one's burst ratio (50 at most);
    null where there is none. The features are the columns of the matrix: as many as the registry has."""
    names = [r[0] for r in res.select("feature").distinct().orderBy("feature").collect()]
    ratio = F.least(F.lit(50.0), F.when(F.col("value") != 0, F.col("vmax") / F.col("value")))
    cells = [F.max(F.when(F.col("feature") == f, c)) for c in (F.col("residual"), ratio) for f in names]
    return res.groupBy("resource_id", "category", "rtype", "ts").agg(F.array(*cells).alias("x"))


def scaled(features: DataFrame) -> DataFrame:
    """features of types with LEAST_POOL rows or more with pool (the type's rows) and z: x with medians for nulls, less the
    median, over the distance of the quartiles. Both are those of the type's whole pool."""
    sizes = features.groupBy("rtype").agg(F.count("*").alias("pool")).where(F.col("pool") >= LEAST_POOL)
    cells = features.join(sizes, "rtype").select("rtype", F.posexplode("x").alias("k", "v"))
    middles = quantiles(cells, ["rtype", "k"], "v", {"m": 0.5}).select("rtype", "k", "m")
    filled = cells.join(middles, ["rtype", "k"], "left").select("rtype", "k", F.coalesce("v", "m", F.lit(0.0)).alias("v"))
    spread = quantiles(filled, ["rtype", "k"], "v", {"a": 0.25, "m": 0.5, "b": 0.75})
    scale = F.struct("k", "m", F.when(F.col("b") > F.col("a"), F.col("b") - F.col("a")).otherwise(1.0).alias("s"))
    types = spread.groupBy("rtype").agg(F.sort_array(F.collect_list(scale)).alias("scale")).join(sizes, "rtype")  # two entries a feature
    z = F.zip_with("x", "scale", lambda v, s: (F.coalesce(v, s.m) - s.m) / s.s)
    return features.join(types, "rtype").select("resource_id", "category", "rtype", "ts", "pool", z.alias("z"))


def trees(rows: DataFrame, count: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """N-5: (rtype, tree, nodes): each tree of a type is grown on its own draw of about `sample` rows of the type's whole
    pool (all rows of a smaller pool). A pool of more than count x sample rows gives each row to one tree at most."""
    draw = lambda *seed: F.pmod(F.xxhash64("resource_id", "category", "ts", *seed), F.lit(1 << 40)) / float(1 << 40)
    wide = F.col("pool") > count * sample
    every = rows.where(~wide).withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).where(draw(F.col("tree")) < sample / F.col("pool"))
    once = rows.where(wide & (draw(F.lit(-1)) < count * sample / F.col("pool"))).withColumn("tree", F.floor(draw(F.lit(-2)) * count).cast("int"))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("resource_id", "category", "ts")])
        first = table.slice(0, 1)
        nodes = grow(matrix(table.column("z")), seed=42 + first["tree"][0].as_py(), trees=1)[0]
        return first.select(["rtype", "tree", "pool"]).append_column("nodes", pa.array([nodes.tobytes()], pa.binary()))

    drawn = every.unionByName(once).select("rtype", "tree", "pool", "resource_id", "category", "ts", "z")
    return drawn.groupBy("rtype", "tree").applyInArrow(fit, "rtype string, tree int, pool long, nodes binary")


#: Bytes of trees that a task holds at once; types are scored in as many passes as that takes.
HELD = 256 << 20


def forest_scores(rows: DataFrame, model: DataFrame) -> DataFrame:
    """rows (rtype, pool, z and others) with raw, the isolation score of each. model: a written table of trees. Trees are
    broadcast, those of one type (2,047 nodes each at most) always together."""
    spark = rows.sparkSession
    sizes = model.groupBy("rtype").agg(F.sum(F.length("nodes")).alias("bytes")).orderBy("rtype").collect()
    passes, held = [[]], 0
    for r in sizes:
        if held and held + r["bytes"] > HELD:
            passes.append([])
            held = 0
        passes[-1].append(r["rtype"])
        held += r["bytes"]
    schema = rows.drop("z").withColumn("raw", F.lit(0.0)).schema

    def score(batches, shared):
        for batch in batches:
            x, types, pools = matrix(batch.column("z")), batch.column("rtype").dictionary_encode(), batch.column("pool").to_numpy()
            raw, codes = np.full(batch.num_rows, np.nan), types.indices.to_numpy()
            for k, rtype in enumerate(types.dictionary.to_pylist()):
                own = np.flatnonzero(codes == k)
                raw[own] = isolation_score(shared.value[rtype], x[own], min(SAMPLE, int(pools[own[0]])))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in batch.schema.names if n != "z"), pa.array(raw)], [*(n for n in batch.schema.names if n != "z"), "raw"])

    out = None
    for names in passes:
        forest: dict = {}
        for r in model.where(F.col("rtype").isin(names)).orderBy("rtype", "tree").toLocalIterator():
            forest.setdefault(r["rtype"], []).append(np.frombuffer(r["nodes"]).reshape(-1, 5))
        shared = spark.sparkContext.broadcast(forest)
        found = rows.where(F.col("rtype").isin(names)).mapInArrow(lambda it, s=shared: score(it, s), schema)
        out = found if out is None else out.union(found)
    return out


def forest_signals(features: DataFrame) -> DataFrame:
    """N-6: resource_id, category, ts, pool and forest_signal, clip((raw - the pool's threshold + 0.3) / 0.6), for the rows
    of types that have a forest. The threshold is the quantile of all the pool's scores that its contamination asks for."""
    rows = cut(scaled(cut(features)))
    model = cut(trees(rows))
    raw = cut(forest_scores(rows, model))
    share = F.least(F.lit(0.49), F.greatest(F.lit(0.01), F.least(F.lit(0.05), F.greatest(F.lit(0.02), 5 / F.col("n")))))
    limits = quantiles(raw, ["rtype"], "raw", {"limit": 1 - share}).select("rtype", "limit")
    signal = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("raw") - F.col("limit") + 0.3) / 0.6))
    return raw.join(limits, "rtype").select("resource_id", "category", "ts", "pool", signal.alias("forest_signal"))


def scored(rows: DataFrame, with_forest: bool = False) -> DataFrame:
    """Composite score of every resource and time; rows have rtype."""
    res = residuals(rows)
    keys = ["resource_id", "category", "ts"]
    signals = zscore_signal(res).join(burst_signal(rows), keys)
    if with_forest:
        signals = signals.join(forest_signals(forest_features(res)), keys, "left")
        return composite(signals, F.col("pool"))
    return composite(signals.withColumn("forest_signal", F.lit(None).cast("double")))
