"""Chunks of a token budget against the greedy loop."""

import random
from collections import Counter
from itertools import groupby

import pytest

from fleetlens.operators.chunks import token_chunks

SCHEMA = "project string, category string, resource_id string, feature string, tokens long, rank int"
first = lambda v: (v is not None, v or "")


def greedy(rows, budget):
    """One row after another, a project at a time."""
    out = []
    for p, own in groupby(sorted(rows, key=lambda r: first(r[0])), key=lambda r: r[0]):
        own = [(*r[:4], max(1, r[4] or 1), 2**31 - 1 if r[5] is None else r[5]) for r in own]
        least = {c: min(r[5] for r in own if r[1] == c) for c in {r[1] for r in own}}
        own.sort(key=lambda r: (least[r[1]], first(r[1]), r[5], first(r[2]), first(r[3]), r[4]))
        used = chunk = 0
        for c, part in groupby(own, key=lambda r: r[1]):
            part = list(part)
            if used and used + sum(r[4] for r in part) > budget:
                used, chunk = 0, chunk + 1
            for r in part:
                if used and used + r[4] > budget:
                    used, chunk = 0, chunk + 1
                used += r[4]
                out.append((p, c, r[2], r[3], r[4], chunk))
    return Counter(out)


@pytest.mark.parametrize("seed, budget, most", [(1, 40, 12), (2, 7, 20), (3, 1000, 50), (4, 1, 3), (5, 60, 60)])
def test_equals_the_greedy_loop(spark, seed, budget, most):
    r = random.Random(seed)
    rows = [(r.choice(["hot", "hot", "hot", "b", "c", None]), r.choice(["X", "Y", "Z", None]), r.choice([None, *map(str, range(40))]), r.choice("fg"), r.choice([None, 0, -3, *range(1, most)]), r.choice([None, 0, 1, 2, 3])) for _ in range(400)]
    rows += rows[:30]
    got = token_chunks(spark.createDataFrame(rows, SCHEMA), budget)
    assert got.columns == ["project", "category", "resource_id", "feature", "tokens", "chunk"]
    assert Counter(map(tuple, got.collect())) == greedy(rows, budget)


def test_many_projects_of_one_row_above_the_budget(spark):
    rows = [(f"p{k}", "X", "r", "f", 50, 0) for k in range(40)]
    assert Counter(map(tuple, token_chunks(spark.createDataFrame(rows, SCHEMA), 10).collect())) == greedy(rows, 10)


def test_no_rows_and_more_columns(spark):
    none = spark.createDataFrame([], SCHEMA + ", pos int, chunk string, _part int, least int")
    assert token_chunks(none, 10).count() == 0
    one = spark.createDataFrame([("p", "X", "r", "f", 5, 0, 7, "c", 3, 9)], SCHEMA + ", pos int, chunk string, _part int, least int")
    assert [tuple(x) for x in token_chunks(one, 10).collect()] == [("p", "X", "r", "f", 5, 0)]
