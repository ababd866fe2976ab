"""op11 and op13 against brute force, with ties, repeated rows, odd vectors and integers beyond 64 bits."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from fleetlens.llm import queries, shallot, vectors, whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, dims int, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2, "x") for i, v in rows], SCHEMA).repartition(3)


def plain_means(rows, k, rounds, dims):
    """Clusters by all distances in Python integers."""
    kept = [(i, [int(Fraction(v) * 1024 // 1) for v in e]) for i, e in rows if e is not None and len(e) == dims and all(v is not None and np.isfinite(v) for v in e)]
    start = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())[:k]
    centroids = [list(v) for _, v in start]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), g) for g, c in enumerate(centroids))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for g in range(len(centroids)):
            own = [v for (_, v), a in zip(kept, at, strict=True) if a == g]
            if own:
                centroids[g] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return centroids, sorted((i, nearest(v)[1], nearest(v)[0]) for i, v in kept)


def rows_of(found):
    return sorted((r.vec_id, r.cluster, r.distance) for r in found.collect())


def test_clusters_of_the_table(spark):
    rows = [(r.vec_id, [float(v) for v in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    centroids, want = plain_means(rows, 8, 10, 64)
    got = queries.QUERIES["op11_shallot_clusters"](spark, SF).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == want
    for r in got:
        assert r.cluster_inertia == sum(d for _, g, d in want if g == r.cluster) and r.inertia == sum(d for *_, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


@pytest.mark.parametrize("k", [1, 2, 5, 40])
def test_clusters_with_ties_and_odd_rows(spark, k):
    rng = random.Random(k)
    rows = [(i, [float(rng.randrange(-2, 3)) / 512 for _ in range(3)]) for i in range(150)] + [(500 + i, [0.25, 0.25, -0.125]) for i in range(60)]
    odd = [(900, None), (901, [1.0, None, 2.0]), (902, [1.0, float("nan"), 0.0]), (903, [float("inf"), 0.0, 0.0]), (904, []), (905, [1.0, 2.0])]
    centroids, want = plain_means(rows, k, 6, 3)
    got_centroids, got = shallot.fit(frame(spark, rows + odd), k, 6, 3)
    assert got_centroids == centroids and rows_of(got) == want


def test_clusters_of_huge_entries(spark):
    rows = [(i, [float(i % 3), float(i % 7)]) for i in range(30)] + [(40, [3.0e38, 1.0]), (41, [3.0e38, 2.0]), (42, [-1.0e30, 0.5])]
    rows = [(i, [float(np.float32(v)) for v in e]) for i, e in rows]
    centroids, want = plain_means(rows, 4, 5, 2)
    got_centroids, got = shallot.fit(frame(spark, rows), 4, 5, 2)
    assert got_centroids == centroids
    assert rows_of(got) == [(i, g, d if d < 1 << 63 else None) for i, g, d in want]


def test_few_or_no_vectors(spark):
    assert shallot.fit(frame(spark, [(1, None)]), dims=3)[0] == []
    centroids, got = shallot.fit(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [5.0, 5.0])]), 8, 3, 2)
    assert centroids == [[1024, 2048], [1024, 2048], [5120, 5120]] and sorted((r.vec_id or 0, r.cluster, r.distance) for r in got.collect()) == [(0, 2, 0), (1, 0, 0), (1, 0, 0)]


def test_bounds_spare_distances():
    """Most vectors of settled clusters aren't compared again, and the search's result is that of all distances."""
    rng = np.random.default_rng(5)
    middle = rng.integers(-900, 900, (50, 16))
    x = middle[rng.integers(0, 50, 4000)] + rng.integers(-40, 40, (4000, 16))
    cents, before, asked = middle + 3, None, 0
    a, b, u, low = np.zeros(4000, int), np.ones(4000, int), np.full(4000, np.inf), np.zeros(4000)
    real = shallot.squared
    for move in range(6):
        search = shallot.Search(cents.tolist(), before)
        asked = 0

        def counted(p, q):
            nonlocal asked
            asked += len(p)
            return real(p, q)

        shallot.squared = counted
        try:
            a, b, u, low = search.assign(x, a, b, u, low)
        finally:
            shallot.squared = real
        d = np.array([((x - c) ** 2).sum(1) for c in cents])
        assert (a == d.argmin(0)).all() and (np.sqrt(d.min(0)) <= u).all() and (np.sqrt(np.sort(d, 0)[1]) >= low).all(), move
        before, cents = cents.tolist(), cents + rng.integers(-1, 2, cents.shape)
    assert asked < 4000 * 50 / 20


def test_binary_vectors():
    x = np.array([[1, -5], [1 << 26, -(1 << 26)], [1 << 90, -1], [0, -(1 << 39)]], object)
    import pyarrow as pa

    assert (vectors.unpacked(pa.array(vectors.packed(x)), 2) == x).all()
    for v in (0, 5, -5, 1 << 31, -(1 << 31), (1 << 100) + 7, -(1 << 100) - 7):
        assert sum(d["v"] << 31 * d["limb"] for d in vectors.digits([0], [0], [v])) == v


def test_whitening_of_the_table(spark):
    raw = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    y = np.array([[int(np.floor(64 * float(v))) + 1_000_000 for v in r.embedding] for r in raw])
    fit = np.unique(y, axis=0)
    n, s = len(fit), fit.sum(0)
    e, w = np.linalg.eigh(np.cov((fit - 1_000_000).astype(float).T, bias=True))
    e, w = e[::-1], w[:, ::-1]
    got = {(r.vec_id, r.component): r for r in queries.QUERIES["op13_whitening"](spark, SF).collect()}
    assert len(got) == 16 * len(raw)
    flip = {}
    for r, row in zip(raw, y, strict=True):
        deviation = sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s, strict=True))
        want = (row - s / n) @ w[:, :16] / np.sqrt(e[:16])
        for c in range(1, 17):
            g = got[r.vec_id, c]
            flip.setdefault(c, np.sign(g.whitened * want[c - 1]))
            assert g.n == n and g.deviation == deviation and abs(g.whitened - flip[c] * want[c - 1]) < 1e-8
            assert abs(g.explained - e[c - 1] / e.sum()) < 1e-12 and 0 <= g.identity_error < 1e-10


def test_polynomial_and_roots(spark):
    """(t-1)(t-1)(t-4)(t-9)... rotated into a full integer matrix: P D P' scaled; repeated and zero roots."""
    rng = np.random.default_rng(2)
    b = [[int(v) for v in r] for r in rng.integers(-9, 10, (6, 3))]
    m = [[sum(x * y for x, y in zip(p, q, strict=True)) for q in b] for p in b]  # rank 3
    poly = whitening.polynomial(spark, m)
    roots = whitening.largest_roots(poly, 16)
    want = np.sort(np.linalg.eigvalsh(np.array(m, float)))[::-1][:3]
    assert poly[:3] == [0, 0, 0] and poly[6] == 1 and -poly[5] == sum(m[i][i] for i in range(6))
    assert len(roots) == 3 and np.allclose([r / (1 << whitening.ROOT_BITS) for r, _ in roots], want, rtol=1e-12)
    same = [[7 if i == j else 0 for j in range(5)] for i in range(5)]
    same[4][4] = 11
    values, w = whitening.components(spark, same, 4)
    assert [v >> whitening.ROOT_BITS for v in values] == [11, 7, 7, 7]
    assert np.allclose(np.array(w) @ np.array(w).T, np.eye(4), atol=1e-14) and np.allclose(np.abs(w[0]), [0, 0, 0, 0, 1])


def test_close_roots():
    """Two roots that differ by one in 2**80 are told apart, with their own vectors."""
    big = 1 << 80
    m = [[big, 0, 0], [0, big + 1, 0], [0, 0, 5]]
    poly = [-big * (big + 1) * 5, big * (big + 1) + 5 * (2 * big + 1), -(2 * big + 6), 1]
    roots = whitening.largest_roots(poly, 3)
    assert [(r >> whitening.ROOT_BITS, n) for r, n in roots] == [(big + 1, 1), (big, 1), (5, 1)]
    assert np.allclose(np.abs(whitening.null_space(m, roots[0][0], 1)), [[0, 1, 0]]) and np.allclose(np.abs(whitening.null_space(m, roots[1][0], 1)), [[1, 0, 0]])


def test_whitening_of_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1), rng.gauss(0, 2), 0.5]) for i in range(40)]
    odd = [(7, rows[7][1]), (7, rows[7][1]), (None, rows[8][1]), (50, None), (51, [1.0, None, 1.0]), (52, [float("nan"), 1.0, 1.0]), (53, []), (54, [2.0])]
    got, found = whitening.whiten(frame(spark, rows + odd))
    got = got.collect()
    assert found[3]["n"] == 40 and len(found[3]["components"]) == 2 and found[3]["identity_error"] < 1e-10
    assert len(got) == 45 and sum(r.vec_id == 7 for r in got) == 3 and sum(r.vec_id is None for r in got) == 1
    z = np.array([r.whitened for r in got if r.dims == 3 and r.vec_id is not None])[:, :]
    assert z.shape == (42, 2) and [r.whitened for r in got if r.dims == 1] == [[]] and [r.deviation for r in got if r.dims == 1] == [0]
    assert whitening.whiten(frame(spark, [(1, None)]))[0].count() == 0
    huge = whitening.whiten(frame(spark, [(1, [1.0e30, 1.0]), (2, [1.0, 3.0]), (3, [-1.0e30, 2.0]), (3, [-1.0e30, 2.0])]))
    assert huge[1][2]["n"] == 3 and huge[1][2]["identity_error"] < 1e-6 and all(r.deviation is None for r in huge[0].where("vec_id <> 2").collect())


def test_queries_over_nothing(spark, tmp_path):
    frame(spark, [(1, None)]).write.parquet(str(tmp_path / "embeddings.parquet"))
    for name in ("op11_shallot_clusters", "op13_whitening"):
        assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []
