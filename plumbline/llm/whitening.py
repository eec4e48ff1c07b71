"""Whitening by the exact characteristic polynomial of the scatter matrix.

Vectors become whole numbers x = floor(1024 * c) + 100000. Tasks add up products of their own rows exactly, Spark adds the
tasks' sums in limbs of 40 bits, so the scatter M = n * sum(x x') - S S' (n * n times the covariance) is known as whole numbers
of any size. From there on only matrices of the vectors' width are handled:

* The characteristic polynomial of M is found modulo primes below 2**31, by reduction to Hessenberg form, a few primes to a
  task; Chinese remaindering gives its coefficients, the bound on them how many primes it takes.
* All roots are real, so the sign changes of the polynomial shifted to a count exactly the roots above a. Bisection by that
  count isolates the largest roots, with multiplicity; a root that is alone is narrowed down by the polynomial's sign. Roots
  are known to 64 binary places and 64 significant bits at least.
* A component spans the null space of M - root * I, found by inverse iteration in decimal arithmetic of as many digits as
  the whole numbers need. Roots that agree in all places share one space; any orthonormal basis of it will do.

Defined cases: vectors that are NULL or empty, or have an entry that is NULL, not finite or, times 1024, beyond 2**62 are
dropped; so are those that are not as long as most (the longer of two equally common lengths counts). Rows are not told apart
by id: repeated ones count and are returned each, NULL ids too. Components whose eigenvalue is zero do not exist; with a
single vector, or equal ones only, there are none and no rows. A component's sign makes its largest entry positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import settle
from plumbline.llm.vectors import matrices

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries times SCALE must stay below this.
LARGEST = 2.0**62
LIMB, LIMBS = 40, 5
#: Binary places of a root, and the least number of its significant bits.
PLACES, SIGNIFICANT = 64, 64
PRIMES_PER_TASK = 16

SUMS = "dim int, i int, j int, " + ", ".join(f"limb{k} long" for k in range(LIMBS))


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """floor(SCALE * c), and which rows stay within bounds."""
    whole = np.floor(vectors * SCALE)
    good = (np.abs(whole) < LARGEST).all(axis=1)
    return whole[good], good


def products(y: np.ndarray) -> np.ndarray:
    """Sums of products of whole columns, exactly: by floating point where no sum can reach 2**53."""
    most = float(np.abs(y).max(initial=0))
    step = int(min(len(y), 2.0**53 // (most * most))) if most else len(y)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    if step < 1:
        whole = np.array([[int(v) for v in row] for row in y.tolist()], object)
        return total + whole.T.dot(whole)
    for at in range(0, len(y), step):
        part = y[at : at + step]
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _limbs(value: int) -> list[int]:
    return [(value >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)] + [value >> (LIMB * (LIMBS - 1))]


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows, per length: n under (-1, -1), sums under (i, -1), sums of products under (i, j)."""
    found: dict[int, list] = {}
    for batch in batches:
        for _, vectors in matrices(batch.column(0)):
            y, _ = scaled(vectors)
            if len(y):
                own = found.setdefault(y.shape[1], [0, 0, 0])
                own[0] += len(y)
                own[1] = own[1] + np.array([int(v) for v in y.sum(axis=0)] if np.abs(y).max() * len(y) < 2.0**53 else [sum(map(int, c)) for c in y.T.tolist()], object)
                own[2] = own[2] + products(y)
    for dim, (n, sums, square) in found.items():
        rows = [(dim, -1, -1, *_limbs(n))] + [(dim, i, -1, *_limbs(int(sums[i]))) for i in range(dim)]
        rows += [(dim, i, j, *_limbs(int(square[i, j]))) for i in range(dim) for j in range(i + 1)]
        columns = [pa.array(c, pa.int32() if k < 3 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "i", "j", *(f"limb{k}" for k in range(LIMBS))])


def scatter(vectors: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """n, the sums and n * n times the covariance of floor(SCALE * c), over the vectors of the commonest length."""
    own = vectors.mapInArrow(_partial_sums, SUMS).groupBy("dim", "i", "j").agg(*(F.sum(f"limb{k}").alias(f"limb{k}") for k in range(LIMBS)))
    values = {(r.dim, r.i, r.j): sum(r[3 + k] << (LIMB * k) for k in range(LIMBS)) for r in own.collect()}  # as wide as a vector, squared
    if not values:
        return 0, np.zeros(0, object), np.zeros((0, 0), object)
    n, dim = max((n, dim) for (dim, i, j), n in values.items() if i < 0)
    sums = np.array([values[dim, i, -1] for i in range(dim)], object)
    square = np.array([[values[dim, max(i, j), min(i, j)] for j in range(dim)] for i in range(dim)], object)
    return n, sums, n * square - np.outer(sums, sums)


# --- the characteristic polynomial


def primes(count: int) -> list[int]:
    """The largest primes below 2**31, by Miller and Rabin with bases that decide up to 3 * 10**9."""
    out, p = [], (1 << 31) - 1
    while len(out) < count:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        if all((x := pow(a, odd, p)) in (1, p - 1) or any((x := x * x % p) == p - 1 for _ in range(twos - 1)) for a in (2, 3, 5, 7)):
            out.append(p)
        p -= 2
    return out


def polynomial_modulo(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients, from the constant one on, of det(x - h) modulo each prime; `h` is a matrix for each, reduced."""
    count, d = h.shape[:2]
    h, each, m = h.copy(), np.arange(count), p[:, None]
    for k in range(d - 2):
        below = h[:, k + 1 :, k] != 0
        row = below.argmax(axis=1) + k + 1
        h[each, row], h[each, k + 1] = h[each, k + 1].copy(), h[each, row].copy()
        h[each, :, row], h[each, :, k + 1] = h[each, :, k + 1].copy(), h[each, :, row].copy()
        inverse = np.array([pow(int(x), -1, int(q)) if x else 0 for x, q in zip(h[:, k + 1, k], p, strict=True)])
        u = h[:, k + 2 :, k] * inverse[:, None] % m
        h[:, k + 2 :] = (h[:, k + 2 :] - u[:, :, None] * h[:, k + 1][:, None, :] % m[..., None]) % m[..., None]
        h[:, :, k + 1] = (h[:, :, k + 1] + (u[:, None, :] * h[:, :, k + 2 :] % m[..., None]).sum(axis=2)) % m
    leading = np.zeros((d + 1, count, d + 1), np.int64)
    leading[0, :, 0] = 1
    for k in range(d):
        new = np.zeros((count, d + 1), np.int64)
        new[:, 1:] = leading[k, :, :-1]
        new = (new - h[:, k, k][:, None] * leading[k]) % m
        chain = np.ones(count, np.int64)
        for i in range(1, k + 1):
            chain = chain * h[:, k - i + 1, k - i] % p
            new = (new - (h[:, k - i, k] * chain % p)[:, None] * leading[k - i]) % m
        leading[k + 1] = new
    return leading[d]


def _polynomials(matrix: list[list[int]]):
    def run(batches):
        for batch in batches:
            p = batch.column(0).to_numpy()
            reduced = np.array([[[x % int(q) for x in row] for row in matrix] for q in p], np.int64)
            found = polynomial_modulo(reduced, p)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(found), pa.list_(pa.int64()))], names=["p", "coefficients"])

    return run


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(x - matrix), from the constant one on, of a positive semidefinite matrix of whole numbers."""
    d, trace = len(matrix), int(sum(matrix.diagonal()))
    # sums of products of k roots are at most those of equal roots with the same trace
    largest = max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    own = primes((2 * largest).bit_length() // 30 + 1)
    rows = spark.createDataFrame(pa.table({"p": pa.array(own, pa.int64())})).repartition(-(-len(own) // PRIMES_PER_TASK))
    found = rows.mapInArrow(_polynomials([[int(x) for x in row] for row in matrix]), "p long, coefficients array<long>").collect()
    product = math.prod(own)
    total = [0] * (d + 1)
    for r in found:
        rest = product // r.p
        weight = rest * pow(rest, -1, r.p)
        total = [t + c * weight for t, c in zip(total, r.coefficients, strict=True)]
    total = [t % product for t in total]
    return [t - product if 2 * t > product else t for t in total]


# --- its largest roots


class Roots:
    """Roots of a real-rooted polynomial of whole coefficients, in units of 2**-places."""

    def __init__(self, coefficients: list[int], places: int):
        d = len(coefficients) - 1
        self.scaled = [c << (places * (d - k)) for k, c in enumerate(coefficients)]
        self.counts: dict[int, int] = {}

    def above(self, a: int) -> int:
        """How many roots, with multiplicity, are above a: the sign changes of the polynomial shifted to it."""
        if a not in self.counts:
            shifted = self.scaled[:]
            for i in range(len(shifted) - 1):
                for j in range(len(shifted) - 2, i - 1, -1):
                    shifted[j] += a * shifted[j + 1]
            signs = [c > 0 for c in shifted if c]
            self.counts[a] = sum(x != y for x, y in zip(signs, signs[1:], strict=False))
        return self.counts[a]

    def sign(self, a: int) -> int:
        value = 0
        for c in reversed(self.scaled):
            value = value * a + c
        return (value > 0) - (value < 0)

    def kth(self, k: int, low: int, high: int) -> int:
        """The k-th largest root, rounded up; it is above `low`, and not above `high`."""
        for a, many in self.counts.items():  # what earlier roots have told
            low, high = (max(low, a), high) if many >= k else (low, min(high, a))
        while high - low > 1 and self.above(low) - self.above(high) > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.above(middle) >= k else (low, middle)
        if high - low > 1:  # alone in (low, high]
            at_high = self.sign(high)
            while at_high and high - low > 1:
                middle = (low + high) // 2
                low, high = (low, middle) if self.sign(middle) in (at_high, 0) else (middle, high)
        return high


def largest_roots(coefficients: list[int], count: int) -> tuple[list[int], int]:
    """The largest positive roots, with multiplicity, in falling order, in units of 2**-places, and places."""
    d = len(coefficients) - 1
    zeros = next(k for k, c in enumerate(coefficients) if c)
    wanted, places = min(count, d - zeros), PLACES
    trace = -coefficients[d - 1]
    while True:
        roots = Roots(coefficients, places)
        found = [roots.kth(k, 0, (trace << places) + 1) for k in range(1, wanted + 1)]
        if not found or found[-1].bit_length() >= SIGNIFICANT:
            return found, places
        places *= 2


# --- null spaces


def _solved(rows: list[np.ndarray], swaps: list[int], factors: list[np.ndarray], b: np.ndarray) -> np.ndarray:
    b = b.copy()
    d = len(b)
    for k in range(d - 1):
        b[k], b[swaps[k]] = b[swaps[k]], b[k]
        b[k + 1 :] = b[k + 1 :] - factors[k] * b[k]
    for k in range(d - 1, -1, -1):
        b[k] = (b[k] - (rows[k][k + 1 :] * b[k + 1 :]).sum()) / rows[k][k]
    return b


def null_space(matrix: np.ndarray, root: Decimal, count: int, digits: int) -> list[np.ndarray]:
    """`count` orthonormal vectors (of Decimal) that matrix - root takes nearest to zero, by inverse iteration."""
    with localcontext() as context:
        context.prec = digits
        d = len(matrix)
        rows = [np.array([Decimal(int(x)) - (root if i == j else 0) for j, x in enumerate(row)], object) for i, row in enumerate(matrix)]
        largest = max(abs(x) for row in rows for x in row) or Decimal(1)
        least = largest * Decimal(10) ** (8 - digits)  # stands for a pivot that vanishes
        swaps, factors = [], []
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(rows[i][k]))
            rows[k], rows[best] = rows[best], rows[k]
            swaps.append(best)
            if abs(rows[k][k]) < least:
                rows[k] = rows[k].copy()
                rows[k][k] = least
            own = np.array([rows[i][k] / rows[k][k] for i in range(k + 1, d)], object)
            for i, f in enumerate(own, k + 1):
                rows[i] = np.concatenate([rows[i][: k + 1], rows[i][k + 1 :] - f * rows[k][k + 1 :]])
            factors.append(own)
        draw = np.random.default_rng(7)
        vectors = [np.array([Decimal(int(x)) for x in draw.integers(1, 1000, d)], object) for _ in range(count)]
        for _ in range(4):
            done: list[np.ndarray] = []
            for v in vectors:
                v = _solved(rows, swaps, factors, v)
                v = v / max(abs(x) for x in v)
                for _ in range(2):
                    for w in done:
                        v = v - w * (v * w).sum()
                done.append(v / (v * v).sum().sqrt())
            vectors = done
        return vectors


def components(matrix: np.ndarray, roots: list[int], places: int) -> list[tuple[Decimal, np.ndarray]]:
    """Per root its value and its unit vector. Roots that differ by a unit or less in their last place share a space."""
    digits = 40 + 2 * len(str(max(abs(int(x)) for x in matrix.ravel()))) + int(places * 0.31)
    out = []
    at = 0
    while at < len(roots):
        to = at + 1
        while to < len(roots) and roots[to - 1] - roots[to] <= 1:
            to += 1
        with localcontext() as context:
            context.prec = digits
            value = Decimal(roots[at]) / (1 << places)
            for v in null_space(matrix, value, to - at, digits):
                big = max(range(len(v)), key=lambda i: (round(abs(v[i]), 20), -i))
                out.append((value, v if v[big] > 0 else -v))
        at = to
    return out


# --- whitened rows

WHITENED = "vec_id long, deviation decimal(38,0), parts array<double>"


def _whiten(n: int, sums: list[int], weights: np.ndarray):
    """`weights`: components over the square root of the scatter's eigenvalue, one in a column."""
    dim = len(sums)
    most = max(map(abs, sums))
    floating = np.array([float(s) for s in sums])

    def run(batches):
        for batch in batches:
            for rows, vectors in matrices(batch.column(1)):
                if vectors.shape[1] != dim:
                    continue
                y, good = scaled(vectors)
                ids = batch.column(0).take(pa.array(rows[good]))
                limit = n * float(np.abs(y).max(initial=0)) + most
                if limit * limit * dim < 2.0**62:
                    away = n * y.astype(np.int64) - np.array(sums, np.int64)
                    deviation = [int(x) for x in (away * away).sum(axis=1)]
                    away = away.astype(np.float64)
                else:
                    exact = [[n * int(v) - s for v, s in zip(row, sums, strict=True)] for row in y.tolist()]
                    deviation = [sum(x * x for x in row) for row in exact]
                    away = np.array([[float(x) for x in row] for row in exact]) if exact else n * y - floating
                parts = np.einsum("ij,jk->ik", away, weights)  # each row by itself, whatever the batch
                held = pa.array([Decimal(x) if x < 10**38 else None for x in deviation], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([ids, held, pa.array(list(parts), pa.list_(pa.float64()))], names=["vec_id", "deviation", "parts"])

    return run


def identity_error(parts: DataFrame, count: int) -> float:
    """The largest absolute entry of the covariance of `parts` (an array column) minus the identity."""
    means = parts.agg(*(F.avg(F.col("parts")[k]).alias(f"m{k}") for k in range(count))).first()

    def centred(k: int) -> Column:
        return F.col("parts")[k] - F.lit(means[k])

    pairs = [(i, j) for i in range(count) for j in range(i + 1)]
    found = parts.agg(*(F.avg(centred(i) * centred(j)).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(found[at] - (i == j)) for at, (i, j) in enumerate(pairs))


def whitened(embeddings: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Per vector and component: vec_id, component (from 1), n, deviation (sum over dimensions of (n * x - S) ** 2, NULL from
    10**38 on), whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("own_vector"))
    n, sums, matrix = scatter(own.select("own_vector"))
    trace = int(sum(matrix.diagonal())) if n else 0
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not trace:
        return spark.createDataFrame([], schema)
    roots, places = largest_roots(characteristic_polynomial(spark, matrix), count)
    found = components(matrix, roots, places)
    weights = np.array([[float(x / value.sqrt()) for x in v] for value, v in found]).T
    explained = [float(value / trace) for value, _ in found]
    rows = settle(own.mapInArrow(_whiten(n, [int(s) for s in sums], weights), WHITENED))
    error = identity_error(rows, len(found))
    each = rows.select("vec_id", "deviation", F.posexplode("parts").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
