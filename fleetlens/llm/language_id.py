"""Language identification with a bit-sliced Bloom filter of n-grams.

The filter is an array of words for every 64 languages; a bit of each word belongs to one of them. An n-gram's three positions are read and
ANDed, which gives all languages that contain it at once. A document's score for a language is the share of its n-grams
with that bit, corrected for the language's own false-positive rate, and the best score decides. N-grams are of three and
four bytes of the lower-cased text in which every run of non-letters is one space.
"""

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import blocks, slices, test_remainder, utf8

HASHES = 3
#: Words of the filter (a power of two) for every 64 languages, of 8 bytes at most.
SLOTS = 1 << 20
#: The filter is fitted on about so many labelled rows of each language, drawn by a hash of the id.
FIT_ROWS = 1500
#: An n-gram belongs to a language if so many of its rows there hold it, or this share of them.
LEAST_ROWS, LEAST_SHARE = 2, 0.004
#: Below this corrected share of known n-grams a text is in none of the languages.
UNKNOWN = 0.2
UND = "und"
_NOT_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower case, a space for every run of signs, and a space at each end; two spaces if there is no letter (of any
    script; a numeral like \u00bd is none)."""
    out = _NOT_LETTER.sub(" ", text.lower()).strip()
    return f" {out} " if any(map(str.isalpha, out)) else "  "


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of every row of a block and the row each belongs to; none crosses rows."""
    wide = data.astype(np.uint32)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    out, rows = [], []
    for n in (3, 4):
        if len(wide) < n:
            continue
        packed = wide[: len(wide) - n + 1].copy()
        for k in range(1, n):
            packed |= wide[k : len(wide) - n + 1 + k] << np.uint32(8 * k)
        ok = row[: len(packed)] == row[n - 1 :]
        out.append(packed[ok])
        rows.append(row[: len(packed)][ok])
    return (np.concatenate(out), np.concatenate(rows)) if out else (np.zeros(0, np.uint32), np.zeros(0, np.int32))


def positions(packed: np.ndarray, slots: int):
    """Hash positions of n-grams, one array after the other."""
    shift = np.uint32(32 - (slots - 1).bit_length())
    for k in range(HASHES):
        yield ((packed ^ (packed >> np.uint32(15 + k))) * np.uint32((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)[k])) >> shift


@dataclass
class Filter:
    languages: list[str]
    words: list[np.ndarray]
    false_rate: np.ndarray

    def masks(self, packed: np.ndarray, plane: int = 0) -> np.ndarray:
        """Of each n-gram the languages of a plane that contain it, as bits."""
        words = self.words[plane]
        return functools.reduce(np.bitwise_and, (words[at] for at in positions(packed, len(words))))

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows x languages: the corrected share of a row's n-grams that the language contains."""
        packed, row = grams(data, offsets)
        n = len(offsets) - 1
        all_of = np.maximum(np.bincount(row, minlength=n), 1)
        out = np.empty((n, len(self.languages)))
        masks = None
        for k, rate in enumerate(self.false_rate):
            if k % 64 == 0:
                masks = self.masks(packed, k // 64)
            hits = np.bincount(row, weights=(masks >> masks.dtype.type(k % 64) & masks.dtype.type(1)).astype(np.float32), minlength=n)
            out[:, k] = np.clip((hits / all_of - rate) / max(1 - rate, 1e-9), 0, 1)
        return out


def build(rows: list[tuple[str, str]], slots: int = SLOTS) -> Filter:
    """rows: (language, text)."""
    languages = sorted({x for x, _ in rows})
    kind = next(t for t, b in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 1 << 60)) if len(languages) <= b)
    words = [np.zeros(slots, kind) for _ in range(0, len(languages), 64)]
    rate = np.zeros(len(languages))
    for k, name in enumerate(languages):
        seen: list[np.ndarray] = []
        texts = [t for x, t in rows if x == name]
        for t in texts:
            raw = np.frombuffer(letters(t).encode(), np.uint8)
            seen.append(np.unique(grams(raw, np.array([0, len(raw)]))[0]))
        known, counts = np.unique(np.concatenate(seen), return_counts=True)
        known = known[counts >= min(len(texts), max(LEAST_ROWS, LEAST_SHARE * len(texts)))]
        plane, bit = words[k // 64], kind(1 << k % 64)
        for at in positions(known, slots):
            plane[at] |= bit
        rate[k] = np.mean(plane & bit != 0) ** HASHES
    return Filter(languages, words, rate)


def fit(labelled: DataFrame, rows_each: int = FIT_ROWS) -> Filter:
    """A filter from (doc_id, text, lang), learned from about rows_each rows of each language, drawn by a hash of the id.
    Rows of one text count once. What reaches the driver is bounded by that and by the number of languages."""
    usable = labelled.where("text is not null and lang is not null").withColumn("h", F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 30)))
    counts = usable.groupBy("lang").count().collect()
    if not counts:
        return build([])
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r[0], int((1 << 30) * min(1.0, rows_each / r[1])))])
    rows = usable.where(F.col("h") < shares[F.col("lang")]).select("lang", "text", "h").distinct().collect()
    return build([(r[0], r[1]) for r in sorted(rows, key=lambda r: (r[0], r[2], r[1]))])


def _predict(batches, filter_, with_text: bool):
    model: Filter = filter_.value
    for batch in slices(batches):
        texts = [letters(t.as_py() or "") for t in batch.column(1)]
        data, offsets = utf8(pa.array(texts, pa.large_string()))
        names, scores, cover = [], [], []
        for a, b in blocks(offsets, 1 << 20):
            part = offsets[a : b + 1]
            shares = model.shares(data[part[0] : part[-1]], part - part[0])
            best = shares.argmax(1) if shares.shape[1] else np.zeros(len(shares), int)
            for i, k in enumerate(best):
                if texts[a + i] == "  " or not shares.shape[1]:
                    names.append(UND), scores.append(0.0), cover.append(0.0)
                else:
                    total = shares[i].sum()
                    names.append(model.languages[k]), scores.append(float(shares[i, k] / total) if total > 0 else 0.0), cover.append(float(shares[i, k]))
        kept = [k for k in range(batch.num_columns) if k != 1 or with_text]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(cover, pa.float64())], [*(batch.schema.names[k] for k in kept), "lang_pred", "score", "known_share"])


def identify(docs: DataFrame, model: Filter, keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """doc_id, the text if it is wanted, the columns named in keep, lang_pred, score (the best language's part of all corrected shares) and
    known_share (its own corrected share).

    A text that is null or has no letter (Unicode's L) is `und` with score 0; any length is read whole; repeated rows get the same
    answer; a null doc_id stays; ties go to the language first in order; an empty table gives no rows; a model without
    languages says `und`.
    """
    keep = keep or []
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots x 8 bytes at most
    fields = {f.name: f for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in ["doc_id", *["text"] * with_text, *keep]) + ", lang_pred string, score double, known_share double"
    return docs.select("doc_id", "text", *keep).mapInArrow(lambda it: _predict(it, shared, with_text), schema)


def train(docs: DataFrame) -> Filter:
    return fit(docs.where(test_remainder("doc_id", 5) != 0).select("doc_id", "text", "lang"))


def keep_known(docs: DataFrame, least: float = UNKNOWN) -> DataFrame:
    """docs without the texts that are `und` or whose n-grams are known to no language. The text is read once: the
    prediction carries the other columns along."""
    model = train(docs)
    held = {c: "text" if c == "text" else f"__held_{k}" for k, c in enumerate(docs.columns)}  # so that none clashes with the prediction's
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"`{c}`").alias(h) for c, h in held.items()])
    out = identify(plain, model, [h for h in held.values() if h != "text"], with_text=True).where((F.col("lang_pred") != UND) & (F.col("known_share") >= least))
    return out.select(*[F.col(h).alias(c) for c, h in held.items()])


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, train(docs))
    return out.select("doc_id", F.coalesce(test_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "known_share")
