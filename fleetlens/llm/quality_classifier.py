"""A quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Every token has a sparse ternary index vector given by its hash; a token's own vector is the sum of the index vectors of
its neighbours over all documents, brought to length one, so tokens used alike lie close. A document is the mean of
its tokens' vectors, their spread, and the shares of a few kinds of characters. A network of one hidden layer, written in
numpy, is fitted on labelled rows; a temperature fitted on rows left out of that makes its probabilities honest.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Rolling, blocks, slices, test_remainder, utf8

#: Tokens are hashed into so many vectors of so many numbers.
BUCKETS, SIZE = 1 << 15, 32
#: Neighbours on either side that count.
REACH = 2
#: The network is fitted on about so many labelled rows of each class, drawn by a hash of the id.
FIT_ROWS = 2500
THRESHOLD = 0.7
_BYTES = np.arange(256)
#: Kinds of bytes: white space, letters (with all of UTF-8's higher bytes), capitals, digits, others.
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_KIND = np.select([_SPACE, _LETTER, _DIGIT], [0, 1, 2], 3).astype(np.uint8)
_LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of rows: each token's bucket, its row and the token's hash. A token is a run of letters, of digits or
    of other signs; one in capitals only is told from the same in small letters."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    kind = _KIND[data]
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    begins = np.flatnonzero(first | np.concatenate([[True], kind[1:] != kind[:-1]]))
    ends = np.append(begins[1:], len(data))
    real = kind[begins] != 0
    begins, ends = begins[real], ends[real]
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shout = (upper[ends] - upper[begins] == ends - begins) & (ends - begins > 1)
    hashes = Rolling(_LOWER[data]).spans(begins, ends) ^ shout.astype(np.uint64)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(offsets, begins, "right") - 1, hashes


def sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows' values; rows ascend."""
    out = np.zeros((n, values.shape[1]), np.float64)
    if len(rows):
        at = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        out[rows[at]] = np.add.reduceat(values, at, axis=0)
    return out


def distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Different hashes (their upper 40 bits) of each row of a block of fewer than 2**24 rows."""
    keys = np.sort(rows.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    return np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=n)


def index_vectors(seed: int = 11) -> np.ndarray:
    """Of each word four numbers of 1 or -1 at different places, elsewhere 0."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS, SIZE), np.float32)
    at = rng.random((BUCKETS, SIZE)).argsort(1)[:, :4]
    np.put_along_axis(out, at, rng.choice([-1.0, 1.0], (BUCKETS, 4)).astype(np.float32), 1)
    return out


#: Rows in which tasks send their sums of word vectors, each of BUCKETS / PARTS words; tasks for every core.
PARTS, TASKS = 256, 4


def _neighbours(batches):
    """A task's sums, for every word, of the index vectors of its neighbours, in PARTS rows (part, 4-byte floats)."""
    index = index_vectors()
    order = np.argsort(index == 0, axis=1, kind="stable")[:, :4]  # where an index vector has its numbers, and those
    signs = np.take_along_axis(index, order, 1)
    total, seen = np.zeros(BUCKETS * SIZE), False
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for a, b in blocks(offsets, 1 << 20):
            part = offsets[a : b + 1]
            ids, rows, _ = tokens(data[part[0] : part[-1]], part - part[0])
            for d in range(1, REACH + 1):
                same = rows[d:] == rows[:-d]
                left, right = ids[:-d][same], ids[d:][same]
                for word, near in ((left, right), (right, left)):
                    if len(word):
                        total += np.bincount((word[:, None] * SIZE + order[near]).reshape(-1), signs[near].reshape(-1), BUCKETS * SIZE)
                        seen = True
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in total.astype(np.float32).reshape(PARTS, -1)], pa.binary())], ["part", "sums"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of length one for all words, from all texts. Every task sends one matrix of a fixed size, of which there are
    TASKS for every core at most; their sums are made part by part, and a matrix of that size reaches the driver."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(BUCKETS * SIZE // PARTS), None
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = k
                total += np.frombuffer(raw.as_buffer(), np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["part", "sums"])

    most = TASKS * docs.sparkSession.sparkContext.defaultParallelism
    sums = docs.where("text is not null").select("text").coalesce(most).mapInArrow(_neighbours, "part int, sums binary")
    got = sums.groupBy("part").applyInArrow(added, "part int, sums binary").toArrow().sort_by("part")
    out = index_vectors().astype(np.float64)
    if got.num_rows:
        out += np.frombuffer(b"".join(got.column("sums").to_pylist()), np.float32).reshape(BUCKETS, SIZE)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One row of features for each text of a block."""
    n = len(offsets) - 1
    ids, rows, hashes = tokens(data, offsets)
    count = np.maximum(np.bincount(rows, minlength=n), 1)[:, None]
    mean, spread = np.zeros((n, SIZE)), np.zeros((n, SIZE))
    step = 1 << 18
    for k in range(0, len(ids), step):
        v = vectors[ids[k : k + step]]
        mean += sums(v, rows[k : k + step], n)
        spread += sums(v * v, rows[k : k + step], n)
    mean, spread = mean / count, spread / count
    size = np.maximum(np.diff(offsets), 1)
    kinds = np.concatenate([np.zeros((1, 3)), np.cumsum(np.stack([_KIND[data] == 3, _KIND[data] == 2, _UPPER[data]], 1), axis=0)]) if len(data) else np.zeros((1, 3))
    shares = (kinds[offsets[1:]] - kinds[offsets[:-1]]) / size[:, None]
    variety = distinct(rows, hashes, n)[:, None] / count
    same = rows[2:] == rows[:-2]
    triples = ((hashes[2:] * np.uint64(31) + hashes[1:-1]) * np.uint64(31) + hashes[:-2])[same] if len(hashes) > 2 else np.zeros(0, np.uint64)
    at = rows[2:][same] if len(hashes) > 2 else np.zeros(0, np.int64)
    fresh = distinct(at, triples, n)[:, None] / np.maximum(np.bincount(at, minlength=n), 1)[:, None]
    return np.concatenate([mean, spread, shares, variety, fresh, np.log1p(count)], 1)


def features(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    out = [pooled(data[(p := offsets[a : b + 1])[0] : p[-1]], p - p[0], vectors) for a, b in blocks(offsets, 1 << 20)]
    return np.concatenate(out) if out else np.zeros((0, 2 * SIZE + 6))


@dataclass
class Model:
    vectors: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.shift) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def learn(texts: list[str], labels: np.ndarray, vectors: np.ndarray, hidden: int = 24, epochs: int = 150, seed: int = 3) -> Model:
    """Adam over mini-batches; every fifth row is left out for the temperature. Classes weigh the same."""
    x, y = features(texts, vectors), labels.astype(np.float64)
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 5 == 4
    xt, yt = x[~held], y[~held]
    shift, scale = xt.mean(0), xt.std(0) + 1e-6
    m = Model(vectors, shift, scale, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), 0.0)
    z = (xt - shift) / scale
    weight = np.where(yt == 1, 0.5 / max(yt.mean(), 1e-6), 0.5 / max(1 - yt.mean(), 1e-6))
    par = [m.w1, m.b1, m.w2, np.zeros(1)]
    mom, var, step = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par], 0
    for _ in range(epochs):
        order = rng.permutation(len(yt))
        for k in range(0, len(order), 64):
            i = order[k : k + 64]
            h = np.maximum(z[i] @ par[0] + par[1], 0)
            p = 1 / (1 + np.exp(-np.clip(h @ par[2] + par[3], -60, 60)))
            d = (p - yt[i]) * weight[i] / len(i)
            back = np.outer(d, par[2]) * (h > 0)
            step += 1
            for j, g in enumerate((z[i].T @ back + 1e-3 * par[0], back.sum(0), h.T @ d + 1e-3 * par[2], np.array([d.sum()]))):
                mom[j] = 0.9 * mom[j] + 0.1 * g
                var[j] = 0.999 * var[j] + 0.001 * g * g
                par[j] -= 0.003 * mom[j] / (1 - 0.9**step) / (np.sqrt(var[j] / (1 - 0.999**step)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = par[0], par[1], par[2], float(par[3][0])
    if held.any():
        logits, truth = m.logits(x[held]), y[held]
        loss = lambda t: np.mean(np.logaddexp(0, logits / t) - truth * logits / t)
        m.temperature = float(min(np.geomspace(0.7, 8, 41), key=loss))
    return m


def fit(docs: DataFrame, labels: DataFrame, rows_each: int = FIT_ROWS) -> Model | None:
    """A model from documents and labels (doc_id, quality). Of each class about rows_each rows are drawn by a hash of the
    id, so what is broadcast and what reaches the driver have that bound. None if a class is missing."""
    counts = {r[0]: r[1] for r in labels.where("quality in (0, 1)").groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30))
    share = F.when(F.col("quality") == 0, F.lit(rows_each / counts[0])).otherwise(F.lit(rows_each / counts[1]))
    drawn = labels.where(F.col("quality").isin(0, 1) & (draw < share * (1 << 30))).select("doc_id", "quality")
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "quality", draw.alias("h")).distinct().collect()
    got = sorted(((r[2], r[0] or "", r[1]) for r in rows))
    labels_ = np.array([r[2] for r in got])
    return learn([r[1] for r in got], labels_, word_vectors(docs)) if len(set(labels_.tolist())) == 2 else None


def _score(batches, shared):
    model = shared.value
    for batch in slices(batches):
        texts = [t.as_py() or "" for t in batch.column(1)]
        scores = model.scores(features(texts, model.vectors)) if model else np.full(len(texts), 0.5)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score, from 0 to 1. Null texts count as empty ones and are scored too; whole texts are read; repeated
    rows score alike; a null doc_id stays; without a model (one class only, or no labels) every score is 0.5; an empty
    table gives no rows; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB of vectors and a small network
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: _score(it, shared), "doc_id long, score double")


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    known = labels.where(F.col("quality").isNotNull() & (test_remainder("doc_id", 4) != 2)).select("doc_id", "quality")
    return fit(docs, known)


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", F.coalesce(test_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
