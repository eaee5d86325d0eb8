"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become whole numbers, so the scatter n * sum(x x') - S S' (n squared times
the covariance) is a matrix of whole numbers, summed exactly over all vectors. Its
characteristic polynomial is found modulo many primes, by Hessenberg reduction in
Spark tasks, and put together by Chinese remaindering. All its roots are real, so
by Descartes' rule the sign changes of the polynomial shifted to a point count the
roots above that point exactly: bisection isolates the roots and tightens them to
`BITS` binary digits. The null space of the scatter less a root, by inverse
iteration in whole-number arithmetic of that precision, gives the components, again
one task per root.

What reaches the driver follows the dimension, not the rows: the upper triangle of
the scatter and the coefficients.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.llm.common import quoted

#: Binary digits to which a root is known, relative to itself.
BITS = 128

#: A product of two entries below 2**20, summed over this many rows, is exact in double precision.
EXACT_ROWS, EXACT_ENTRY = 1 << 13, 1 << 20


def finite_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`vec_id` and `vector` (array of double) without NULL vectors and without those holding NULL or non-finite entries.

    Vectors of another length than most have (ties: the longer) have no place in the same scatter and go too.
    """
    inf = F.lit(float("inf"))
    rows = vectors.select(quoted(id_col).alias("vec_id"), quoted(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where("vector IS NOT NULL").where(
        F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf)))
    usual = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("vector") == (usual["d"] if usual else 0))


def whole_entries(column: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * c) of every entry, one row per vector."""
    flat = np.floor(np.asarray(column.flatten(), np.float64) * scale)
    if flat.size and np.abs(flat).max() >= 2.0 ** 62:
        raise OverflowError("an entry is too large for a whole number of 64 bits")
    return flat.astype(np.int64).reshape(len(column), -1)


def cross_products(x: np.ndarray) -> np.ndarray:
    """Exact x' x of whole numbers, as Python numbers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    if x.size and max(int(x.max()), -int(x.min())) >= EXACT_ENTRY:
        x = x.astype(object)
        return total + x.T @ x
    for at in range(0, len(x), EXACT_ROWS):
        part = x[at:at + EXACT_ROWS].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


class Scatter:
    """Rows, sums per dimension and n * sum(x x') - S S' in exact numbers."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray):
        self.n, self.sums = n, sums
        own = np.array(sums, object)
        self.matrix = n * products - np.outer(own, own) if sums else products

    @property
    def trace(self) -> int:
        return sum(int(self.matrix[i, i]) for i in range(len(self.sums)))


def scatter(rows: DataFrame, scale: float = 64.0) -> Scatter:
    """Summed exactly: a task gives its count, sums and cross-products once, Spark adds them by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, 0, 0
        for b in batches:
            x = whole_entries(b.column("vector"), scale)
            if len(x):
                n, sums, products = n + len(x), sums + x.sum(axis=0).astype(object), products + cross_products(x)
        if n:
            cells = [n, *sums, *products[np.triu_indices(len(sums))]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cells)), pa.int64()), pa.array([Decimal(int(c)) for c in cells], pa.decimal128(38, 0))],
                ["cell", "value"])

    cells = rows.select("vector").mapInArrow(run, "cell long, value decimal(38,0)").groupBy("cell").agg(F.sum("value").alias("value"))
    found = {r["cell"]: int(r["value"]) for r in cells.collect()}
    if not found:
        return Scatter(0, [], np.zeros((0, 0), object))
    # 1 + d + d (d + 1) / 2 cells for d dimensions.
    d = (math.isqrt(1 + 8 * len(found)) - 3) // 2
    products = np.zeros((d, d), object)
    for cell, i, j in zip(range(1 + d, len(found)), *np.triu_indices(d)):
        products[i, j] = products[j, i] = found[cell]
    return Scatter(found[0], [found[1 + i] for i in range(d)], products)


def primes_below(top: int, product: int) -> list[int]:
    """Primes from `top` downwards until their product exceeds `product`."""
    out, held, p = [], 1, top - 1 + top % 2
    while held <= product:
        # These bases decide for all numbers below 3.2e9.
        if all(pow(a, p - 1, p) == 1 and _strong(a, p) for a in (2, 3, 5, 7)):
            out.append(p)
            held *= p
        p -= 2
    return out


def _strong(a: int, p: int) -> bool:
    odd = p - 1
    while odd % 2 == 0:
        odd //= 2
    x = pow(a, odd, p)
    while odd < p - 1:
        if x == p - 1 or (x == 1 and odd % 2):
            return True
        x, odd = x * x % p, odd * 2
    return False


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients (constant first) of the characteristic polynomial modulo a prime below 2**31.

    Similarity steps bring the matrix to Hessenberg form; the polynomials of its leading blocks follow one another.
    """
    h = matrix.copy()
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not below.size:
            continue
        at = k + 1 + below[0]
        h[[k + 1, at]] = h[[at, k + 1]]
        h[:, [k + 1, at]] = h[:, [at, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factor % p).sum(axis=1)) % p
    block = np.zeros((d + 1, d + 1), np.int64)
    block[0, 0] = 1
    for k in range(1, d + 1):
        new = -(h[k - 1, k - 1] * block[k - 1] % p)
        new[1:] += block[k - 1, :-1]
        # The entry above the diagonal times the subdiagonal entries that lead down to it, per earlier block.
        path, paths = 1, []
        for i in range(k - 1, 0, -1):
            path = path * int(h[i, i - 1]) % p
            paths.append(path * int(h[i - 1, k - 1]) % p)
        if paths:
            new -= (np.array(paths)[:, None] * block[k - 2::-1] % p).sum(axis=0)
        block[k] = new % p
    return block[d].tolist()


def characteristic_polynomial(rows: DataFrame, own: Scatter) -> list[int]:
    """Exact coefficients, constant first. Tasks take primes; `rows` only names the session."""
    d, matrix = len(own.sums), own.matrix.tolist()
    # The k-th coefficient from the top is a symmetric sum of roots that are not negative.
    bound = max(math.comb(d, k) * (own.trace // d + 1) ** k for k in range(d + 1))
    primes = primes_below((1 << 31) - 1, 2 * bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(matrix, object)
        for b in batches:
            found = [polynomial_modulo((exact % p).astype(np.int64), p) for p in b.column("p").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("p"), pa.array(found, pa.list_(pa.int64()))], ["p", "rest"])

    spark = rows.sparkSession
    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    given = spark.range(0, len(primes), 1, tasks).select(
        F.element_at(F.lit(primes).cast("array<bigint>"), (F.col("id") + 1).cast("int")).alias("p"))
    product = math.prod(primes)
    total = [0] * (d + 1)
    for r in given.mapInArrow(run, "p long, rest array<long>").collect():
        rest = product // r["p"]
        unit = rest * pow(rest, -1, r["p"])
        total = [t + unit * c for t, c in zip(total, r["rest"])]
    return [c if 2 * c < product else c - product for c in (t % product for t in total)]


class Roots:
    """Positive roots of a polynomial of whole coefficients whose roots are all real and not negative."""

    def __init__(self, coefficients: list[int]):
        zero = next(i for i, c in enumerate(coefficients) if c)
        self.coefficients = coefficients[zero:]
        self.degree = len(self.coefficients) - 1

    def scaled(self, s: int) -> list[int]:
        """Coefficients of a multiple of the polynomial in y = x * 2**s."""
        d = self.degree
        return [c << (s * (d - i)) for i, c in enumerate(self.coefficients)] if s >= 0 else \
            [c << (-s * i) for i, c in enumerate(self.coefficients)]

    def above(self, k: int, s: int) -> int:
        """How many roots exceed k / 2**s: sign changes of the coefficients after a shift to that point."""
        c = self.scaled(s)
        for i in range(self.degree):
            for j in range(self.degree - 1, i - 1, -1):
                c[j] += k * c[j + 1]
        signs = [x > 0 for x in c if x]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    def sign(self, k: int, s: int) -> int:
        value = 0
        for c in reversed(self.scaled(s)):
            value = value * k + c
        return (value > 0) - (value < 0)

    def largest(self, count: int, bits: int = BITS) -> list[tuple[Fraction, int]]:
        """The distinct roots that make up the `count` largest, from the top, each with its multiplicity.

        Roots that agree in `bits` binary digits count as one.
        """
        out: list[tuple[Fraction, int]] = []
        taken = 0
        top = max(1, -self.coefficients[-2] // self.coefficients[-1] if self.degree else 1).bit_length()
        # Intervals (k / 2**s, (k + 1) / 2**s] with the number of roots above each end, highest last.
        waiting = [(0, -top, 0, self.degree)]
        while waiting and taken < count:
            k, s, over, lower = waiting.pop()
            held = lower - over
            if not held:
                continue
            if held == 1 or k.bit_length() > bits:
                out.append((self.tightened(k, s, over, bits) if held == 1 else Fraction(2 * k + 1) / Fraction(2) ** (s + 1), held))
                taken += held
                continue
            middle = self.above(2 * k + 1, s + 1)
            waiting += [(2 * k, s + 1, middle, lower), (2 * k + 1, s + 1, over, middle)]
        return out

    def tightened(self, k: int, s: int, over: int, bits: int) -> Fraction:
        """Bisect an interval of one root by the sign in the middle."""
        while k.bit_length() <= bits:
            sign = self.sign(2 * k + 1, s + 1)
            if not sign:
                return Fraction(2 * k + 1) / Fraction(2) ** (s + 1)
            # The sign of the leading term times -1 per root above.
            k, s = 2 * k + (sign != (-1) ** over), s + 1
        return Fraction(2 * k + 1) / Fraction(2) ** (s + 1)


def null_space(matrix: list[list[int]], root: Fraction, held: int, bits: int = 2 * BITS) -> np.ndarray:
    """`held` orthonormal vectors that the matrix less `root` sends to about zero: two steps of inverse iteration.

    Elimination with row exchange on whole numbers that carry `bits` binary digits after the point.
    """
    d = len(matrix)
    m = np.array(matrix, object) << bits
    shift = (root.numerator << bits) // root.denominator
    for i in range(d):
        m[i, i] -= shift
    order = np.arange(d)
    for k in range(d):
        at = k + int(np.argmax(np.abs(m[k:, k])))
        m[[k, at]], order[[k, at]] = m[[at, k]], order[[at, k]]
        if not m[k, k]:
            m[k, k] = 1
        if k + 1 < d:
            factor = (m[k + 1:, k] << bits) // m[k, k]
            m[k + 1:, k + 1:] -= (factor[:, None] * m[k, k + 1:]) >> bits
            m[k + 1:, k] = factor
    start = np.random.default_rng(d).integers(-(1 << 30), 1 << 30, (d, held))
    y = np.array([[int(v) << bits for v in r] for r in start.tolist()], object)
    for _ in range(2):
        y = y[order]
        for k in range(d):
            y[k + 1:] -= (m[k + 1:, k, None] * y[k]) >> bits
        for k in reversed(range(d)):
            y[k] = (y[k] << bits) // m[k, k]
            y[:k] -= (m[:k, k, None] * y[k]) >> bits
        # Each column is brought back to full scale.
        most = np.abs(y).max(axis=0)
        y = (y << bits) // np.where(most == 0, 1, most)
    vectors, _ = np.linalg.qr((y >> (bits - 60)).astype(np.float64))
    return vectors


class Whitening:
    """Components of a scatter: column i of `vectors` belongs to `roots[i]`; largest root first."""

    def __init__(self, own: Scatter, roots: list[Fraction], vectors: np.ndarray):
        self.scatter, self.vectors = own, vectors
        self.explained = [float(r / own.trace) for r in roots]
        # (n x - S) . v / sqrt(root): the factors n of x - S / n and of the deviation cancel.
        self.projection = vectors / np.sqrt(np.array([float(r) for r in roots]))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        most = self.scatter.n * max(int(x.max()), -int(x.min()), 1) + max(map(abs, self.scatter.sums))
        wide = x if most < 1 << 62 else x.astype(object)
        return self.scatter.n * wide - np.array(self.scatter.sums, wide.dtype)


def fit(rows: DataFrame, components: int = 32, scale: float = 64.0) -> Whitening:
    """Fit on all rows of `finite_vectors`. Components with a zero eigenvalue do not exist: there are at most rank many."""
    own = scatter(rows, scale)
    if not own.n or not own.trace:
        return Whitening(own, [], np.zeros((len(own.sums), 0)))
    roots = Roots(characteristic_polynomial(rows, own)).largest(components)
    matrix, given = own.matrix.tolist(), [(str(r.numerator), str(r.denominator), m) for r, m in roots]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places = b.column("id").to_pylist()
            found = [null_space(matrix, Fraction(int(given[i][0]), int(given[i][1])), given[i][2]) for i in places]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([v.T.reshape(-1).tolist() for v in found], pa.list_(pa.float64()))], ["id", "vectors"])

    spark = rows.sparkSession
    tasks = spark.range(0, len(roots), 1, min(len(roots), spark.sparkContext.defaultParallelism))
    found = sorted(tasks.mapInArrow(run, "id long, vectors array<double>").collect(), key=lambda r: r["id"])
    vectors = np.concatenate([np.array(r["vectors"]).reshape(-1, len(own.sums)) for r in found])
    return Whitening(own, [r for r, m in roots for _ in range(m)][:components], vectors[:components].T)


def identity_error(rows: DataFrame, own: Whitening, scale: float = 64.0) -> float:
    """Largest absolute entry of the covariance of all whitened rows minus the identity, measured on the rows."""
    k, n = own.vectors.shape[1], own.scatter.n
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            x = whole_entries(b.column("vector"), scale)
            if len(x):
                z = own.deviations(x).astype(np.float64) @ own.projection
                total += np.concatenate([z.T @ z, z.sum(axis=0)[None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int64()), pa.array(total.reshape(-1))], ["cell", "value"])

    cells = rows.select("vector").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.zeros(k * (k + 1))
    for r in cells.collect():
        total[r["cell"]] = r["value"]
    total = total.reshape(k + 1, k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 32, scale: float = 64.0, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: `vec_id`, `component` (from 1), `n`, `deviation` (decimal, exact),
    `whitened`, `explained`, `identity_error`.

    Vectors that `finite_vectors` drops have no rows. Repeated rows and NULL ids count and come out like any other;
    equal eigenvalues share an arbitrary basis of their space; without two different vectors there is no component
    and so no row; an empty table gives an empty result. No other column is read, so none can clash.
    """
    rows = finite_vectors(vectors, id_col, vector_col)
    own = fit(rows, components, scale)
    error, k = identity_error(rows, own, scale), own.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows if k else 0, 1024):
                b = whole.slice(at, 1024)
                y = own.deviations(whole_entries(b.column("vector"), scale))
                z = y.astype(np.float64) @ own.projection
                small = y.dtype != object and int(np.abs(y).max()) ** 2 * max(1, y.shape[1]) < 1 << 63
                far = (y * y if small else y.astype(object) ** 2).sum(axis=1).tolist()
                each = np.repeat(np.arange(len(z)), k)
                far = pa.array([Decimal(int(f)) for f in far], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))),
                     pa.array(np.full(len(each), own.scatter.n, np.int64)), far.take(pa.array(each)), pa.array(z.reshape(-1)),
                     pa.array(np.tile(own.explained, len(z))), pa.array(np.full(len(each), error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, "
                                "deviation decimal(38,0), whitened double, explained double, identity_error double")
