"""op12: round trip, capacity, how few sequences, odd rows and levels; local search alone against exact packings."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import best_fit, queries

SF = "/root/testdata/sf0.01"


def sequences(rows):
    out = {}
    for r in rows:
        out.setdefault(r.sequence_id, []).append(r)
    return out


def assert_packed(rows, most):
    """Gapless, within capacity; gives the number of sequences."""
    found = sequences(rows)
    for parts in found.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= most
    return len(found)


def test_whole_table(spark):
    rows = queries.QUERIES["op12_best_fit"](spark, SF).collect()
    used, total = assert_packed(rows, best_fit.MOST), sum(r.length for r in rows)
    assert used <= -(-total // best_fit.MOST) + 1
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(docs)
    encode = best_fit.encoder("byte_bpe_50k")
    for doc, text in docs.items():
        ids, at = np.append(encode(text or ""), np.uint32(0)).astype("<u4"), 0
        parts = sorted(pieces[doc], key=lambda r: r.piece)
        for k, r in enumerate(parts):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert k == 0 or r.length == best_fit.MOST
            at += r.length
        assert at == len(ids) and len(parts) == -(-len(ids) // best_fit.MOST)


def test_odd_rows(spark):
    long = "the long word and another one " * 3000
    rows = [(1, None, "x"), (2, "", "x"), (None, "no id", "x"), (3, "same", "x"), (3, "same", "x"), (4, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    got = best_fit.pack(best_fit.pieces(docs)).collect()
    assert assert_packed(got, best_fit.MOST) == -(-sum(r.length for r in got) // best_fit.MOST)
    assert [r.length for r in got if r.doc_id in (1, 2)] == [1, 1] and sum(r.doc_id == 3 for r in got) == 2
    assert {r.ids for r in got if r.doc_id == 1} == {b"\0\0\0\0"}
    assert best_fit.pack(best_fit.pieces(docs.limit(0))).collect() == []


def assert_bins(bins, lengths, most):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(0 < sum(lengths[i] for i in b) <= most for b in bins)


def test_search_improves_best_fit():
    rng = random.Random(1)
    for make in (lambda: rng.randint(600, 760), lambda: rng.randint(400, 1500), lambda: rng.randint(500, 700)):
        lengths = [make() for _ in range(4000)]
        first = best_fit.best_fit(lengths, 2048)
        last = best_fit.search(first, lengths, 2048)
        assert_bins(first, lengths, 2048)
        assert_bins(last, lengths, 2048)
        assert len(last) < len(first)


@pytest.mark.parametrize("seed", range(30))
def test_search_near_the_fewest(seed):
    """Never more bins than it began with, squared fills never fall, and at most one bin above the fewest there can be."""
    rng = random.Random(seed)
    lengths = [rng.randint(1, 19) for _ in range(9)]

    # by subsets: (bins, fill of the last), the least there can be
    least = [(0, 20)] + [(99, 0)] * (2 ** len(lengths) - 1)
    for have in range(1, len(least)):
        for i, n in enumerate(lengths):
            if have >> i & 1:
                bins, fill = least[have ^ 1 << i]
                least[have] = min(least[have], (bins, fill + n) if fill + n <= 20 else (bins + 1, n))
    first = best_fit.best_fit(lengths, 20)
    last = best_fit.search(first, lengths, 20)
    assert_bins(last, lengths, 20)
    squares = [sum(sum(lengths[i] for i in b) ** 2 for b in bins) for bins in (first, last)]
    assert squares[1] >= squares[0] and len(last) <= len(first)
    assert len(last) <= least[-1][0] + 1


def test_levels(spark):
    """Small groups leave many underfull bins; levels pack them together, and other columns stay with their rows."""
    items = spark.range(6000).select((F.col("id") % 700 + F.xxhash64("id") % 97 + 200).cast("long").alias("length"), F.col("id").alias("fill"), F.concat(F.lit("p"), "id").alias("bin"))
    got = best_fit.pack(items, 2048, group=100).collect()
    assert len(got) == 6000 and all(r.bin == f"p{r.fill}" for r in got)
    total = sum(r.length for r in got)
    assert assert_packed(got, 2048) <= 1.01 * total / 2048 + 1
