"""The corpus pipeline: language ID, near-duplicates, repeated passages, benchmark leaks, packing.

Every stage takes an empty table to an empty one, keeps all columns but for the last, whatever their names, and works on
whole texts of any length.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import decontaminate, language_id, near_copies, packing, suffix_dedup
from fleetlens.llm.common import shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is known; null texts and texts without a letter have none and go. Equal rows fare alike."""
    return language_id.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near copies (five-word shingles, similarity 0.8 or more),
    found by SimHash as op9 has it, beyond its radius by MinHash too, and compared exactly; rows that share that id all stay. So rows with a null doc_id all stay if some group has no other id, else they all go."""
    return near_copies.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages (100 bytes or more) out of the texts after their first place, whole characters only; no row
    goes, a text that only repeats others becomes empty, and a row with a null doc_id is left as it is."""
    return suffix_dedup.remove_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that leak a benchmark item; equal texts go together, null and empty ones stay."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the documents into sequences of a power of two; a null or empty text is the end id alone, equal rows are packed
    as often as they are there."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", pack),
]
#: Hash fingerprints, sorted suffixes and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again as the next one's input."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, out, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
    return out
