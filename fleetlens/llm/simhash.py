"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint is a 64-bit vote of the hashes of a text's 3-word shingles. Fifteen bit masks, one for every non-zero
vector v of four bits, are built so that any three bit positions are left out by one mask at least; hence two
fingerprints at distance 3 or less agree under some mask, and no pair is missed. Fingerprints, not documents, are
linked, so equal documents cost one row. Buckets up to a size are searched by a breadth-first walk that gives a
spanning forest, never all pairs; larger buckets are linked through keys with three bits blanked, which is exact and
linear in the bucket.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import blocks, components, cut

RADIUS = 3
#: Larger buckets are dealt out by blanked keys instead of being walked in one task.
BUCKET = 4096


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """A mask for each non-zero vector of radius+1 bits; bit i belongs to it if position i's own vector has an odd
    product with it. Any `radius` position vectors leave some vector orthogonal to all of them."""
    size = 1 << radius + 1
    return [sum(1 << i for i in range(bits) if (i % size & v).bit_count() % 2) for v in range(1, size)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bit i is set if more than half of the shingles' XXH64 (seed 42) have it; 0 without a word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    votes, n = np.zeros(64, np.int64), len(hashes)
    for k in range(0, n, 1 << 16):
        part = np.array(hashes[k : k + (1 << 16)], "<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def votes(hashes: np.ndarray, at: np.ndarray, part: int = 1 << 15) -> np.ndarray:
    """The fingerprint of each text from its shingles' hashes, those of a text from at[i] on (one at least): a bit is set if
    more than half of them have it. `part` hashes are spread to bits at once."""
    out, edges = np.zeros(len(at), np.uint64), np.append(at, len(hashes))
    for a, b in blocks(edges, part):
        first, last = int(edges[a]), int(edges[b])
        if b - a == 1:
            count = sum(_bits(hashes[k : min(k + part, last)]).sum(0, dtype=np.int64) for k in range(first, last, part))[None]
        else:
            count = np.add.reduceat(_bits(hashes[first:last]), edges[a:b] - first, axis=0, dtype=np.int64)
        out[a:b] = np.packbits(2 * count > np.diff(edges[a : b + 1])[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _fingerprints(batches):
    for batch in batches:
        got = [signed(fingerprint((t.as_py() or "").encode())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the values linked at `radius` bits or fewer. Memory: one row of the distances."""
    left, edges = np.unique(values), []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                todo += list(left[near])
                edges += [(int(x), int(y)) for y in left[near]]
                left = left[~near]
    return edges


def _walk(batches, radius: int):
    for batch in batches:
        edges = [e for group in batch.column(0) for e in forest(np.array(group.as_py(), np.int64).view(np.uint64), radius)]
        ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])


def links(values: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """values: distinct longs fp. Edges (a, b), all at `radius` or fewer bits, that connect whatever is so linked."""
    masks = covering_masks(radius)
    keyed = values.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(masks)])).alias("m")).select("fp", "m.t", "m.key")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n"))
    large = cut(sizes.where(F.col("n") > bucket).select("t", "key"))
    rest = keyed.join(large, ["t", "key"], "left_anti")
    groups = rest.groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")
    found = groups.mapInArrow(lambda it: _walk(it, radius), "a long, b long")
    if large.isEmpty():
        return found
    hot = keyed.join(large, ["t", "key"], "left_semi")
    blanks = {k: [signed((1 << 64) - 1 ^ sum(1 << i for i in c)) for c in itertools.combinations([i for i in range(64) if not m >> i & 1], radius)] for k, m in enumerate(masks)}
    table = values.sparkSession.createDataFrame([(k, b) for k, bs in blanks.items() for b in bs], "t int, blank long")  # fixed size: all masks' triples
    spread = hot.join(F.broadcast(table), "t").select("fp", "t", "key", "blank", F.col("fp").bitwiseAND(F.col("blank")).alias("at"))
    stars = spread.groupBy("t", "blank", "at").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return found.union(spread.join(stars, ["t", "blank", "at"]).where("fp <> b").select(F.col("fp").alias("a"), "b").distinct())


def near_duplicates(docs: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable through links of `radius` bits or fewer.

    Null and empty texts have fingerprint 0 and are linked like any other; rows of one doc_id each keep a row; a null
    doc_id is never a component's id unless all its ids are null; an empty table gives no rows; other columns are not
    read.
    """
    rows = cut(fingerprints(docs))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp"), radius, bucket)).withColumnRenamed("node", "fp")
    named = classes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(least, "root").select("fp", "component_id"), "fp")


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of their component."""
    first = near_duplicates(docs, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__first")).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col("__first")), "left_semi")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
