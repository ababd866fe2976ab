"""The pipeline's near-copy stage against brute-force pairs at 0.8."""

import itertools
import random

import numpy as np
import pytest

import corpus_pipeline
from fleetlens.llm import near_copies, simhash


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, similar=0.8):
    sets, parent = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] == sets[j] or len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j]) - 1e-9 and sets[i]]
    for i, j in pairs:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[root(i)][0] for i in range(len(rows))}, len(pairs)


def edited(words, rng, edits):
    out = list(words)
    for k in rng.sample(range(len(out)), edits):
        out[k] = f"edit{rng.randrange(10**6)}"
    return out


def corpus(seed):
    rng, rows = random.Random(seed), []
    for _ in range(12):
        base = [f"w{rng.randrange(10**5)}" for _ in range(rng.choice([60, 120, 400, 900]))]
        rows.append(" ".join(base))
        for _ in range(6):
            base = edited(base, rng, rng.choice([1, 1, 2])) if rng.random() < 0.5 else base
            rows.append(" ".join(edited(base, rng, max(1, len(base) // rng.choice([50, 80, 120])))))
    return [*enumerate(rows), (900, None), (901, ""), (902, "two words"), (903, "Two  words"), (904, "other words")]


@pytest.mark.parametrize("bucket", [256, 3])
def test_near_copies_equal_brute_force(spark, bucket):
    rows = corpus(256)
    want, pairs = brute(rows)
    assert pairs > 60
    got = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), bucket=bucket).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_stage_drops_near_copies(spark):
    rows = corpus(1)
    want, _ = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns and {r.doc_id for r in got.collect()} == set(want.values())
    assert near_copies.near_copies(df.where("false")).count() == 0


def bits_of(text):
    words = text.lower().encode()
    data = np.frombuffer(words, np.uint8)
    _, _, hashes, _ = near_copies.shingles(data, np.array([0, len(data)]))
    counts = [sum(int(h) >> b & 1 for h in hashes) for b in range(64)]
    return sum(1 << b for b, c in enumerate(counts) if 2 * c > len(hashes))


def test_simhash_finds_near_copies_and_an_exact_check_follows(spark):
    """The stage's candidates by SimHash alone: whatever is within three bits and at 0.8, nothing else."""
    rng, rows = random.Random(9), []
    for _ in range(20):
        base = [f"w{rng.randrange(10**5)}" for _ in range(700)]
        rows += [" ".join(base), *(" ".join(edited(base, rng, k)) for k in (1, 2, 8))]
    rows += [" ".join(["again"] * 900 + [f"{x}{k}" for k in range(90)]) for x in "ab"]  # one fingerprint, similarity near 0
    rows = [*enumerate(rows), (900, None), (901, " \t")]
    sets, fps = [shingle_set(t) for _, t in rows], [bits_of(t or "") for _, t in rows]
    assert fps[80] == fps[81] != 0 and not any(fps[82:])
    parent = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.combinations(range(len(rows)), 2):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and (sets[i] == sets[j] or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                parent[i] = parent[j] = min(parent[i], parent[j])
    want = {rows[i][0]: rows[parent[i]][0] for i in range(len(rows))}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert 20 < sum(a != b for a, b in want.items()) < 60
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs, bands=0).collect()}
    assert all(got[i] == got[want[i]] for i in got) and got[80] == 80 and got[81] == 81 and got[901] == 900
    whole = brute(rows)[0]
    assert all(whole[i] == whole[got[i]] for i in got)
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == whole


@pytest.mark.parametrize("part", [1 << 15, 50])
def test_votes_by_parts(part):
    rng = np.random.default_rng(3)
    sizes = [1, 2, 700, 3, 40, 30, 1]
    hashes = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, sum(sizes), dtype=np.uint64)
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    want = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes[a : a + n]) > n) for a, n in zip(at, sizes, strict=True)]
    assert simhash.votes(hashes, at, part).tolist() == want and not len(simhash.votes(hashes[:0], at[:0]))
