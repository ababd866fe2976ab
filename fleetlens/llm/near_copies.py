"""Near copies: five-word shingles shared to 0.8 or more (Jaccard), for the pipeline.

Candidates come from op9's method with this stage's shingles: SimHash fingerprints linked at RADIUS bits or fewer by covering
masks, forests and star contraction; each component is a bucket. Pairs at 0.8 differ in about 10 of 64 bits, so those
further apart than RADIUS are found by MinHash besides: BANDS bands of ROWS minima each, so that a pair at 0.8 shares no
band with a chance of (1 - 0.8**4)**24 = 3.2e-6. Candidates of both are then compared by their whole shingle sets, because a
text that repeats one shingle very often has that shingle's fingerprint. Texts with equal words are one class
and cost one row. A bucket up to a size is searched by a breadth-first walk that gives a spanning forest, never all pairs.
The classes of larger buckets are joined by their rarest shingles instead (prefix filtering, which loses no pair): heavily
edited copies of one text then meet few others, and what still meets many is linked through its most typical member.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm import simhash
from fleetlens.llm.common import Rolling, blocks, components, cut, mix, slices, utf8

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 24, 4
RADIUS = simhash.RADIUS
#: Classes and shingles that a task walks at once; larger buckets are dealt out.
BUCKET, WEIGHT = 256, 4_000_000
_B = np.arange(256)
_SPACE = np.isin(_B, [9, 10, 11, 12, 13, 32])
_LOWER = np.where((_B >= 65) & (_B <= 90), _B + 32, _B).astype(np.uint8)
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_ODD = np.array([pow(0xD1342543DE82EF95, k, 1 << 64) for k in range(SHINGLE + 1)], np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: word hashes and the offsets of the rows in them, shingle hashes and their rows. A text of
    fewer words than a shingle is one shingle; one without words has none."""
    n = len(offsets) - 1
    kind = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    edge = np.concatenate([[False], kind, [False]])
    begin = np.flatnonzero(kind & (~edge[:-2] | first[:-1]))
    end = np.flatnonzero(kind & (~edge[2:] | first[1:])) + 1
    row = np.searchsorted(offsets, begin, "right") - 1
    words = Rolling(_LOWER[data]).spans(begin, end) if len(begin) else np.zeros(0, np.uint64)
    starts = np.searchsorted(row, np.arange(n + 1))
    m = max(0, len(words) - SHINGLE + 1)
    total = np.zeros(m, np.uint64)
    for k in range(SHINGLE):
        total += words[k : k + m] * _ODD[k + 1]
    ok = np.flatnonzero(row[:m] == row[SHINGLE - 1 :]) if m else np.zeros(0, np.int64)
    short = np.flatnonzero((np.diff(starts) > 0) & (np.diff(starts) < SHINGLE)).tolist()
    whole = np.array([xxhash.xxh64_intdigest(words[starts[k] : starts[k + 1]].tobytes(), 7) for k in short], np.uint64)
    hashes, rows = np.concatenate([mix(total[ok]), whole]), np.concatenate([row[ok], np.array(short, np.int64)])
    order = np.argsort(rows, kind="stable")
    return words, starts, hashes[order], rows[order]


def _parts(batches, rows: int, least: int):
    """Slices of the batches, each with its ids and shingles by block."""
    for batch in slices(batches, rows):
        data, offsets = utf8(batch.column(1))
        for a, b in blocks(offsets, least):
            part = offsets[a : b + 1]
            yield batch.column(0).slice(a, b - a), shingles(data[part[0] : part[-1]], part - part[0])


def _keys(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(words[a:b].tobytes(), 3) for a, b in zip(starts[:-1], starts[1:], strict=True)], np.uint64).view(np.int64)


def _sketch(batches):
    for ids, (words, starts, hashes, rows) in _parts(batches, 1024, 1 << 20):
        n = len(starts) - 1
        has = np.flatnonzero(np.bincount(rows, minlength=n))
        at = np.searchsorted(rows, has)
        bands = np.zeros((len(has), BANDS), np.uint64)
        if len(has):
            for k, factor in enumerate(_FACTORS):
                bands[:, k // ROWS] = mix(bands[:, k // ROWS] * _ODD[1] + np.minimum.reduceat(hashes * factor, at) + np.uint64(k))
        ends = np.zeros(n + 1, np.int32)
        ends[has + 1] = BANDS
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(bands.reshape(-1).view(np.int64)))
        fp = np.zeros(n, np.uint64)
        fp[has] = simhash.votes(hashes, at)
        columns = [ids, pa.array(_keys(words, starts)), pa.array(np.bincount(rows, minlength=n)), lists, pa.array(fp.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n", "bands", "fp"])


def _sets(batches):
    for _, (words, starts, hashes, rows) in _parts(batches, 64, 1 << 20):
        at = np.searchsorted(rows, np.arange(len(starts)))
        sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(_keys(words, starts)), pa.array(sets, pa.list_(pa.int64()))], ["key", "s"])


def forest(keys: list[int], sets: list[np.ndarray], similar: float = SIMILAR) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the sets linked at a Jaccard similarity of `similar` or more."""
    size = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    flags = np.zeros(int(flat.max()) + 1, bool)
    left, edges = np.ones(len(keys), bool), []
    while left.any():
        todo = [int(np.flatnonzero(left)[0])]
        left[todo[0]] = False
        while todo and left.any():
            x = todo.pop()
            own = flat[first[x] : first[x] + size[x]]
            flags[own] = True
            shared = np.add.reduceat(flags[flat], first, dtype=np.int64)
            flags[own] = False
            near = np.flatnonzero(left & (shared >= similar * (size + size[x] - shared) - 1e-9))
            left[near] = False
            todo += near.tolist()
            edges += [(keys[x], keys[y]) for y in near.tolist()]
    return edges


def _walk(table: pa.Table) -> pa.Table:
    edges = forest(table.column("key").to_pylist(), [np.asarray(s.values) for s in table.column("s")])
    ends = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({"a": ends[:, 0], "b": ends[:, 1]})


def _walked(members: DataFrame, sets: DataFrame) -> DataFrame:
    """members: distinct (g, key). Edges (a, b) of each group's forest."""
    return members.join(sets, "key").groupBy("g").applyInArrow(_walk, "a long, b long")


def _listed(keyed: DataFrame, group: str) -> DataFrame:
    """(g, key): the members of groups of keyed (group, key) as they are walked, groups of the same members once."""
    lists = keyed.groupBy(group).agg(F.sort_array(F.collect_list("key")).alias("keys")).where(F.size("keys") > 1)
    return lists.select(F.xxhash64("keys").alias("g"), "keys").distinct().select("g", F.explode("keys").alias("key"))


def prefixes(sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(token, key, n, score): of each set (key, s) its rarest shingles, so many that two sets as similar as that have one in
    common; those that stand in one set only are left out. score is the mean number of sets that hold a set's shingles."""
    tokens = sets.select("key", F.size("s").alias("n"), F.explode("s").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("key")
    ranked = tokens.join(common, "token").select("token", "key", "n", "df", F.row_number().over(own.orderBy("df", "token")).alias("place"), F.count("*").over(own).alias("shared"), F.sum("df").over(own).alias("sum"))
    alone = F.col("n") - F.col("shared")
    most = F.col("n") - F.ceil(similar * F.col("n") - 1e-9) + 1
    return ranked.where(F.col("place") <= most - alone).select("token", "key", "n", ((F.col("sum") + alone) / F.col("n")).alias("score"))


def _large(keyed: DataFrame, group: str, bucket: int, weight: int) -> DataFrame:
    """Groups of keyed (group, key, n) that are too large for one task."""
    return keyed.groupBy(group).agg(F.count("*").alias("m"), F.sum("n").alias("w")).where((F.col("m") > bucket) | (F.col("m") > 1) & (F.col("w") > weight)).select(group)


def _dealt(hot: DataFrame, sets: DataFrame, known_edges: DataFrame, bucket: int, weight: int) -> DataFrame:
    """Edges that, with known_edges, connect whatever is similar among the classes of hot (key), with no group in one task.

    Classes meet by rare shingles in common. A group that is still large is compared with the member whose shingles are
    the most common; members that are then in one component with most of the group are settled among themselves, and only
    the others are dealt out in blocks against all.
    """
    keyed = cut(prefixes(sets.join(hot, "key", "left_semi")))
    large = cut(_large(keyed, "token", bucket, weight))
    edges = cut(known_edges.union(_walked(cut(_listed(keyed.join(large, "token", "left_anti"), "token")), sets)))
    if large.isEmpty():
        return edges
    members_ = cut(keyed.join(large, "token", "left_semi"))
    centres = members_.groupBy("token").agg(F.max_by("key", F.struct("score", "key")).alias("c"))
    pairs = members_.join(centres, "token").where("key <> c").select("key", "c").distinct()
    shared = F.size(F.array_intersect("s", "sc"))
    both = pairs.join(sets, "key").join(sets.select(F.col("key").alias("c"), F.col("s").alias("sc")), "c")
    edges = cut(edges.union(both.where(shared >= SIMILAR * (F.size("s") + F.size("sc") - shared) - 1e-9).select(F.col("c").alias("a"), F.col("key").alias("b"))))
    labelled = cut(members_.join(components(edges).withColumnRenamed("node", "key"), "key", "left").select("token", "key", "n", F.coalesce("root", "key").alias("root")))
    most = labelled.groupBy("token", "root").agg(F.count("*").alias("m")).groupBy("token").agg(F.max_by("root", F.struct("m", "root")).alias("main"))
    blocks_ = lambda: F.ceil(F.greatest(2 * F.count("*") / bucket, 2 * F.sum("n") / weight))
    judged = labelled.join(most, "token").withColumn("other", F.col("root") != F.col("main"))
    far = judged.where("other").groupBy("token").agg(blocks_().alias("rows"))
    open_ = judged.join(far, "token").join(judged.groupBy("token").agg(blocks_().alias("cols")), "token")
    at = lambda seed, count: F.pmod(F.xxhash64("key", F.lit(seed)), F.col(count))
    down = open_.where("other").select("token", "key", at(1, "rows").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols") - 1)).alias("y"))
    across = open_.select("token", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("x"), at(2, "cols").alias("y"))
    members = down.union(across).select(F.xxhash64("token", "x", "y").alias("g"), "key").distinct()
    return edges.union(_walked(members, sets))


def near_copies(docs: DataFrame, bucket: int = BUCKET, weight: int = WEIGHT, radius: int = RADIUS, bands: int = BANDS) -> DataFrame:
    """doc_id, key (of the text's words) and component_id, the smallest doc_id reachable through texts at 0.8 or more.

    radius: bits of SimHash fingerprints that may differ; bands: MinHash bands for pairs beyond it (0: SimHash alone).
    Null and empty texts are one class; rows of one doc_id each keep a row; a null doc_id is never a component's id unless
    all its ids are null; an empty table gives no rows; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = cut(texts.mapInArrow(_sketch, "doc_id long, key long, n long, bands array<long>, fp long"))
    classes = rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.max("bands").alias("bands"), F.min("fp").alias("fp"))
    worded = rows.where("n > 0").select("key", "n", "fp").distinct()
    near = components(simhash.links(cut(worded.select("fp").distinct()), radius)).withColumnRenamed("node", "fp")
    linked = worded.join(near, "fp", "left").select("key", "n", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("band"))
    keyed = cut(classes.select("key", "n", F.explode(F.slice("bands", 1, bands)).alias("band")).union(linked))
    large = cut(_large(keyed, "band", bucket, weight))
    small = cut(_listed(keyed.join(large, "band", "left_anti"), "band"))
    hot = cut(keyed.join(large, "band", "left_semi").select("key").distinct())
    wanted = cut(small.select("key").union(hot).distinct())
    owners = classes.join(wanted, "key", "left_semi").select(F.col("least").alias("__id")).distinct()
    read = texts.join(owners, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    found = read.mapInArrow(_sets, "key long, s array<long>").join(wanted, "key", "left_semi")
    sets = cut(found.groupBy("key").agg(F.max("s").alias("s")))
    edges = _walked(small, sets)
    if not large.isEmpty():
        edges = _dealt(hot, sets, edges, bucket, weight)
    named = classes.select("key", "least").join(components(edges).withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.select("doc_id", "key").join(named.join(least, "root").select("key", "component_id"), "key").select("doc_id", "key", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of their component."""
    first = near_copies(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__first")).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col("__first")), "left_semi")
