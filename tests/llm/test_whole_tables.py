"""Registered corpus queries over whole tables: against brute force, held-out rows and what the pipeline promises."""

import re
import zlib
from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

from fleetlens.llm import packing, queries

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_base_phrases(spark):
    """Every base column of op8 against a scan of each text word by word."""
    got = {r.doc_id: r for r in queries.QUERIES["op8_license_scan"](spark, MIDDLE).collect()}
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    places = 0
    for d in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (d.text or "").translate(LOWER))
        at = [(k, label) for label, phrase in PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase)] == phrase]
        places += len(at)
        r, starts = got[d.doc_id], [k for k, _ in at]
        assert (r.n_words, r.n_base) == (len(words), len(at)), d.doc_id
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if at else (None, None)), d.doc_id
        assert r.base_labels == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert places


def test_languages_of_held_out_rows(spark):
    found = queries.QUERIES["op4_language_id"](spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/documents.parquet"), "doc_id").select("doc_id", "held_out", "lang", "lang_pred", "text").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all((r.lang_pred == "und") >= (r.text is None or not any(c.isalpha() for c in r.text)) for r in found)
    asked = [r for r in found if r.held_out and r.lang is not None and r.text and any(c.isalpha() for c in r.text)]
    assert len(asked) > 100 and sum(r.lang == r.lang_pred for r in asked) >= 0.98 * len(asked)


def test_quality_of_held_out_rows(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").where("quality is not null").select("doc_id", "quality")
    asked = queries.QUERIES["op6_quality_classifier"](spark, MIDDLE).where("held_out").join(labels, "doc_id").collect()
    assert len(asked) > 50 and sum(r.predicted == r.quality for r in asked) >= 0.95 * len(asked)
    good, bad = ([r.score for r in asked if r.quality == q] for q in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) >= 0.97 * len(good) * len(bad)


def test_run(spark):
    """The pipeline as a whole: pieces are gapless, no two documents have one text, and no unknown language is left."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    text = {d.doc_id: d.text for d in docs}
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, SMALL).collect():
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        assert r.length & (r.length - 1) == 0 and r.length <= packing.MOST and len(r.ids) == 4 * r.length
    assert 0.5 * len(text) < len(pieces) <= len(text) and set(pieces) <= set(text)
    for parts in pieces.values():
        at = 0
        for start, length, whole in sorted(parts):
            assert start == at
            at += length
        assert at == whole
    kept = [text[k] for k in pieces]
    assert len(set(kept)) == len(kept) and all(t and any(c.isalpha() for c in t) for t in kept)


def test_buckets(spark, tmp_path):
    """Each folder holds the pieces of one length, and nothing is lost."""
    rows = spark.createDataFrame([(1, "one two three " * 40), (None, "null id"), (3, None), (4, "")], "doc_id long, text string")
    packed = packing.pack(rows)
    packing.write_buckets(packed, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.where(F.col("bucket") != F.col("length")).count() == 0
    key = ["doc_id", "start", "length", "ids"]
    assert sorted(map(str, back.select(*key).collect())) == sorted(map(str, packed.select(*key).collect()))
