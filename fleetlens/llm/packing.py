"""Packing by power-of-two decomposition.

Every document becomes a token string (its ids, then the end id 0), which is cut into full sequences and, for the rest,
into pieces whose lengths are the powers of two of its binary form. Each piece is one sequence, so no sequence crosses
documents and none is padded; pieces of equal length share a bucket and are batched together. No row is shuffled: a
document is cut where it is read.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary"
MOST = 1024
#: Token strings are sent to Spark in batches of about so many bytes.
BATCH_BYTES = 8 << 20


@functools.cache
def encoder(vocabulary: str):
    """text -> uint32 ids, as the tokenizers library gives with add_special_tokens=False.

    The rank file beside the JSON file holds the same vocabulary; its encoder is several times faster and is used for
    texts of Latin letters, where the libraries' Unicode tables can't differ. Everything else goes to tokenizers.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = public_tokenizers.path(f"{vocabulary}.json")
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {t.content: i for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items()}
    quick = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    slow = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if text.isascii() or max(text) < "ɐ":
            ids = quick.encode(text, allowed_special="all")
        else:
            ids = slow.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4")

    return encode


def lengths(n: int, most: int = MOST) -> list[int]:
    """Full sequences, then the powers of two of the remainder, largest first."""
    return [most] * (n // most) + [1 << k for k in range(most.bit_length() - 1, -1, -1) if n % most >> k & 1]


def _cut(batches, vocabulary: str, most: int):
    encode = encoder(vocabulary)

    def out(rows):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])

    for batch in batches:
        rows, held = [], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.append(encode(text.as_py() or ""), np.uint32(0)).astype("<u4")
            raw, at = ids.tobytes(), 0
            for n in lengths(len(ids), most):
                rows.append((doc, at, n, len(ids), raw[4 * at : 4 * (at + n)]))
                at += n
            held += len(raw)
            if held >= BATCH_BYTES:
                yield out(rows)
                rows, held = [], 0
        if rows:
            yield out(rows)


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k", most: int = MOST) -> DataFrame:
    """One row per piece: doc_id, start and length in the document's ids, doc_tokens, sequence_id, offset (always 0),
    bucket (the length) and ids (packed little-endian unsigned 32-bit).

    A null or empty text is the end id alone; a document of any length is cut whole; repeated rows are packed as often
    as they occur; a null doc_id stays null; an empty table gives no rows; other columns are not read. most is a power
    of two.
    """
    if most & (most - 1) or most < 1:
        raise ValueError("most is not a power of two")
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(lambda it: _cut(it, vocabulary, most), SCHEMA)
    return pieces.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("bucket"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per length, so that a trainer batches sequences of one length without padding."""
    packed.write.partitionBy("bucket").parquet(path)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
