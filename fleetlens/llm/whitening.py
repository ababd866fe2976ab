"""Whitening through the exact characteristic polynomial of an integer scatter matrix.

The fit list's scatter n * sum(x x') - S S' is summed exactly in Spark. Its characteristic polynomial is found modulo
many primes (Hessenberg reduction, primes dealt to tasks) and put together by Chinese remaindering, which is exact once
the primes' product passes a bound of the coefficients. All its roots are real, so the sign changes of the polynomial
moved to a (Descartes) count the roots above a exactly; bisection isolates the largest ones and halves them down to
2**-160. Each one's components come from inverse iteration on scatter - root in 384-bit fixed point, one task a root;
equal roots share an iteration with as many start vectors, kept orthogonal.

Only the scatter (dims**2 numbers), residues and components reach the driver; whitening is one pass without a shuffle.
"""

import decimal
import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.vectors import DIGITS, digits, integers, totals, unpacked

#: Fraction bits of a root, of the fixed point in which components are found, and of the latter's steps.
ROOT_BITS, WORK_BITS = 160, 384
PRIMES_A_TASK = 16


# ---------------------------------------------------------------- scatter


def _scatter(batches):
    """For each length of vectors: counts (place -1), sums (0 to dims-1) and products (dims + i * dims + j, i <= j)."""
    kind = pa.list_(pa.struct([("g", pa.int32()), ("i", pa.int32()), ("limb", pa.int32()), ("v", pa.int64())]))
    for batch in batches:
        out, sizes = [], batch.column("dims").to_numpy(zero_copy_only=False)
        for d in np.unique(sizes).tolist():
            x = unpacked(batch.column("x").filter(pa.array(sizes == d)), d)
            most = int(np.abs(x).max(initial=0))
            if x.dtype != object and len(x) * most * most >= 1 << 62:
                x = x.astype(object)
            products, (i, j) = x.T @ x, np.triu_indices(d)
            out += digits([d] * (d + 1 + len(i)), [-1, *range(d), *(d + i * d + j).tolist()], [len(x), *x.sum(0).tolist(), *products[i, j].tolist()])
        yield pa.RecordBatch.from_arrays([pa.array([out], kind)], ["delta"])


def scatters(rows: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """By length: n, sums and n**2 times the covariance of the distinct vectors, all exact."""
    sums = totals(rows.select("dims", "x").distinct().mapInArrow(_scatter, f"delta {DIGITS}"))
    out = {}
    for d in sorted({g for g, i in sums if i == -1}):
        n, s = sums[d, -1], [sums.get((d, i), 0) for i in range(d)]
        c = [[0] * d for _ in range(d)]
        for i in range(d):
            for j in range(i, d):
                c[i][j] = c[j][i] = n * sums.get((d, d + i * d + j), 0) - s[i] * s[j]
        out[d] = n, s, c
    return out


# ---------------------------------------------------------------- characteristic polynomial


def is_prime(n: int) -> bool:
    """Miller-Rabin; with these bases exact below 3.2e9."""
    if n % 2 == 0:
        return n == 2
    s = ((n - 1) & -(n - 1)).bit_length() - 1
    for base in (2, 3, 5, 7):
        x = pow(base, (n - 1) >> s, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2**31 whose product has more than so many bits."""
    out, p, product = [], (1 << 31) + 1, 1
    while product.bit_length() <= bits:
        p -= 2
        if is_prime(p):
            out.append(p)
            product *= p
    return out


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """det(t - matrix) modulo a prime below 2**31, lowest coefficient first."""
    a = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        k = m + int(below[0])
        a[[m, k]] = a[[k, m]]
        a[:, [m, k]] = a[:, [k, m]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - int(a[k - 1, k - 1]) * polys[k - 1] % p) % p
        chain = 1
        for i in range(1, k):
            chain = chain * int(a[k - i, k - i - 1]) % p
            if not chain:
                break
            polys[k] = (polys[k] - int(a[k - i - 1, k - 1]) * chain % p * polys[k - i - 1] % p) % p
    return polys[d].tolist()


def _residues(batches, matrix):
    for batch in batches:
        found = [polynomial_mod(matrix, p) for p in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["p", "c"])


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """The integers of smallest size that have these residues, by Newton's mixed radix."""
    value, product = None, 1
    for p, c in sorted(residues.items()):
        if value is None:
            value = list(c)
        else:
            inverse = pow(product, -1, p)
            value = [v + product * ((r - v) * inverse % p) for v, r in zip(value, c, strict=True)]
        product *= p
    return [v - product if 2 * v > product else v for v in value]


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """det(t - matrix) of a positive semidefinite integer matrix, exact, lowest coefficient first.

    Its coefficients are at most the product of 1 + root, so at most (1 + trace / dims) ** dims.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    wanted = primes(d * (1 + trace // d).bit_length() + d + 2)
    rows = spark.createDataFrame([(p,) for p in wanted], "p long").repartition(max(1, len(wanted) // PRIMES_A_TASK))
    found = rows.mapInArrow(lambda it: _residues(it, matrix), "p long, c array<long>").collect()  # dims numbers a prime
    return remaindered({r.p: list(r.c) for r in found})


# ---------------------------------------------------------------- roots


def above(poly: list[int], m: int, s: int) -> int:
    """How many roots, with multiplicity, lie above m / 2**s; exact because all are real."""
    while s and not m & 1:
        m, s = m >> 1, s - 1
    d = len(poly) - 1
    c = [v << s * (d - k) for k, v in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += m * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def sign(poly: list[int], m: int, s: int) -> int:
    v, d = 0, len(poly) - 1
    for k in range(d, -1, -1):
        v = v * m + (poly[k] << s * (d - k))
    return (v > 0) - (v < 0)


def largest_roots(poly: list[int], most: int, bits: int = ROOT_BITS) -> list[tuple[int, int]]:
    """The positive roots among the `most` largest, falling: (root times 2**bits, rounded up; how many share it)."""
    count = functools.cache(lambda m: above(poly, m, bits))
    wanted, top = min(most, count(0)), 1 << bits
    while count(top):
        top <<= 1
    out: list[tuple[int, int]] = []
    while sum(n for _, n in out) < wanted:
        r = sum(n for _, n in out)  # the next root has r above it
        lo, hi = 0, top
        while hi - lo > 1 and count(lo) - count(hi) > 1:
            mid = (lo + hi) >> 1
            lo, hi = (mid, hi) if count(mid) > r else (lo, mid)
        single, after = count(lo) - count(hi) == 1, (-1) ** (count(hi) & 1)
        while single and hi - lo > 1:
            mid = (lo + hi) >> 1
            lo, hi = (lo, mid) if sign(poly, mid, bits) in (0, after) else (mid, hi)
        out.append((hi, count(lo) - count(hi) if not single else 1))
    return out


# ---------------------------------------------------------------- components


def null_space(matrix: list[list[int]], root: int, count: int, bits: int = WORK_BITS) -> list[list[float]]:
    """`count` orthonormal vectors that matrix - root / 2**ROOT_BITS all but takes to zero, by inverse iteration."""
    d, shift = len(matrix), bits - ROOT_BITS
    a = np.array([[v << bits for v in row] for row in matrix], object).reshape(d, d)
    for i in range(d):
        a[i, i] -= root << shift
    swaps, factors = [], []
    for i in range(d):
        k = i + max(range(d - i), key=lambda j: abs(a[i + j, i]))
        a[[i, k]] = a[[k, i]]
        a[i, i] = a[i, i] or 1  # one unit in the last place: the matrix is singular to all its digits
        pivot = a[i, i]
        f = np.array([(v << bits) // pivot for v in a[i + 1 :, i]], object)
        a[i + 1 :, i:] -= (f[:, None] * a[i, i:]) >> bits
        swaps.append(k)
        factors.append(f)

    def solve(v):
        v = v.copy()
        for i in range(d):
            k = swaps[i]
            v[i], v[k] = v[k], v[i]
            v[i + 1 :] -= (factors[i] * v[i]) >> bits
        for i in range(d - 1, -1, -1):
            rest = v[i] - ((a[i, i + 1 :] * v[i + 1 :]).sum() >> bits) if i + 1 < d else v[i]
            v[i] = (rest << bits) // a[i, i]
        return v

    def unit(v, others):
        size = max(abs(x) for x in v).bit_length()
        v = np.array([x << bits - size if size < bits else x >> size - bits for x in v], object)
        for o in others:
            v = v - ((o * ((o * v).sum() >> bits)) >> bits)
        return np.array([(x << bits) // (math.isqrt(int((v * v).sum())) or 1) for x in v], object)

    now: list = [np.array([1 << bits if i == (j * 7919) % d else (((i + 1) * (j + 3) * 2654435761) % (1 << 32)) << bits - 33 for i in range(d)], object) for j in range(count)]
    for _ in range(3):
        done: list = []
        for v in now:
            done.append(unit(unit(solve(v), done), done))
        now = done
    return [[float(x / (1 << bits)) if abs(x) < 1 << 1000 else 0.0 for x in v.tolist()] for v in now]


def _null_spaces(batches, matrix):
    for batch in batches:
        for rank, root, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array([rank]), pa.array([null_space(matrix, int(root), count)], pa.list_(pa.list_(pa.float64())))], ["rank", "w"])


def components(spark: SparkSession, matrix: list[list[int]], most: int) -> tuple[list[int], list[list[float]]]:
    """Roots (times 2**ROOT_BITS, falling) and unit vectors of the largest positive eigenvalues of the matrix.

    Of a repeated root that passes `most`, as many of its vectors are given as there is room for.
    """
    roots = largest_roots(polynomial(spark, matrix), most)
    if not roots:
        return [], []
    rows = spark.createDataFrame([(k, str(r), n) for k, (r, n) in enumerate(roots)], "rank long, root string, n int").repartition(len(roots), "rank")
    found = {r.rank: r.w for r in rows.mapInArrow(lambda it: _null_spaces(it, matrix), "rank long, w array<array<double>>").collect()}  # at most `most` vectors
    values = [r for r, n in roots for _ in range(n)][:most]
    return values, [list(w) for k in range(len(roots)) for w in found[k]][:most]


# ---------------------------------------------------------------- whitening


def _whiten(batches, spaces):
    context = decimal.Context(prec=60)
    for batch in batches:
        sizes = batch.column("dims").to_numpy(zero_copy_only=False)
        deviation, white = [None] * batch.num_rows, [None] * batch.num_rows
        for d in np.unique(sizes).tolist():
            n, s, roots, w = spaces[d]
            at = np.flatnonzero(sizes == d)
            x = unpacked(batch.column("x").filter(pa.array(sizes == d)), d)
            most, sums = int(np.abs(x).max(initial=0)), np.array(s, object)
            small = x.dtype != object and most * sum(map(abs, s)) < 1 << 62 and n * most + max(map(abs, s), default=0) < 1 << 62
            if small:
                sums = sums.astype(np.int64)
            else:
                x = x.astype(object)
            squares, cross, own = (x * x).sum(1).tolist(), (x @ sums).tolist(), sum(v * v for v in s)
            for k, q, r in zip(at.tolist(), squares, cross, strict=True):
                value = n * n * int(q) - 2 * n * int(r) + own
                deviation[k] = context.create_decimal(value) if value < 10**38 else None
            z = (x * n - sums).astype(np.float64) @ np.array(w, np.float64).reshape(len(w), d).T
            z /= np.sqrt(np.array([r / (1 << ROOT_BITS) for r in roots], np.float64))
            for k, row in zip(at.tolist(), z.tolist(), strict=True):
                white[k] = row
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("dims"), pa.array(deviation, pa.decimal128(38, 0)), pa.array(white, pa.list_(pa.float64()))], ["vec_id", "dims", "deviation", "whitened"])


def whiten(vectors: DataFrame, most: int = 16, factor: int = 64) -> tuple[DataFrame, dict[int, dict]]:
    """vec_id, dims, deviation and whitened (its components, the largest eigenvalue's first) of every remaining row; and
    by length of vectors what they were found with: n, sums, explained, components, identity_error.

    Dropped are null vectors (column embedding) and those with a null or non-finite entry. Entry v counts as
    floor(factor * v); a fixed offset changes neither covariance nor deviation. Each distinct vector is in the fit list
    once, each row is whitened, repeated ones too. Vectors of different lengths are whitened apart. Directions without
    variance have no component, so a list of one vector, and an empty vector, has none. A deviation of more than 38
    digits is null; null ids stay; other columns are not read; an empty table gives no rows.
    """
    spark, rows = vectors.sparkSession, integers(vectors, factor)
    spaces, found = {}, {}
    for d, (n, s, c) in scatters(rows).items():
        trace = sum(c[i][i] for i in range(d))
        roots, w = components(spark, c, most) if trace else ([], [])
        spaces[d] = n, s, roots, w
        share = [r / (trace << ROOT_BITS) for r in roots]
        error = 0.0
        if roots:
            v, scale = np.array(w), np.sqrt([r / (1 << ROOT_BITS) for r in roots])
            error = float(np.abs(v @ np.array(c, object).astype(np.float64) @ v.T / np.outer(scale, scale) - np.eye(len(w))).max())
        found[d] = {"n": n, "sums": s, "explained": share, "components": w, "identity_error": error}
    out = rows.mapInArrow(lambda it: _whiten(it, spaces), "vec_id long, dims int, deviation decimal(38,0), whitened array<double>")
    return out, found


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    rows, found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    worst = max((f["identity_error"] for f in found.values()), default=0.0)
    table = spark.createDataFrame([(d, f["n"], f["explained"]) for d, f in found.items()], "dims int, n long, explained array<double>")
    each = rows.join(F.broadcast(table), "dims").select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode(F.arrays_zip("whitened", "explained")))
    return each.select("vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", "col.whitened", "col.explained", F.lit(worst).alias("identity_error"))
