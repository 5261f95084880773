"""Whitening of integer vectors with exact spectra.

The scatter matrix of the fit list is an integer matrix. Its characteristic polynomial is computed
exactly: modulo many primes by Hessenberg reduction (a Spark task takes some primes), then by Chinese
remaindering. Its leading real roots are isolated with exact sign counts and narrowed to hundreds of
bits, and the components are the null spaces at the roots, found by inverse iteration in long decimals."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import comb, gcd, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, stage
from .lattice import lattice, unpack

ROOT_BITS = 256   # roots are known to this many bits below the matrix's trace
DIGITS = 140      # decimal digits of the null-space iteration: more than the roots' bits need
ITERATIONS = 4
PRIMES_A_TASK = 8
LIMB = 60         # bits; sums travel as high and low parts, so that decimals of 38 digits hold them
SEED = 11


# ---- scatter --------------------------------------------------------------------------------

def scatter_of(x: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and products of the rows of ``x`` as Python integers."""
    rows = (1 << 53) // max(1, bound * bound)  # products of so many rows are exact in doubles
    if rows < 1:
        o = x.astype(object)
        return o.sum(axis=0), o.T @ o
    total, products = np.zeros(x.shape[1], object), np.zeros((x.shape[1],) * 2, object)
    for i in range(0, len(x), rows):
        part = x[i:i + rows].astype(np.float64)
        total = total + part.sum(axis=0).astype(np.int64)
        products = products + (part.T @ part).astype(np.int64)
    return total, products


def scatter(fit: DataFrame, dim: int, bound: int) -> tuple[int, list[int], list[list[int]]]:
    """Number, sums and products of the fit list; tasks add up their rows before the shuffle. The driver
    gets a row per pair of dimensions, whatever the number of vectors."""
    def run(batches):
        n, total, products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for b in batches:
            x = unpack(b.column(0), dim)
            s, p = scatter_of(x, bound)
            n, total, products = n + len(x), total + s, products + p
        if n:
            i, j = np.triu_indices(dim)
            values = [n, *total.tolist(), *products[i, j].tolist()]
            kind = pa.decimal128(38)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1] * (dim + 1) + i.tolist(), pa.int32()), pa.array([-1, *range(dim), *j.tolist()], pa.int32()),
                 pa.array([Decimal(int(v) >> LIMB) for v in values], kind), pa.array([Decimal(int(v) % (1 << LIMB)) for v in values], kind)],
                ["i", "j", "high", "low"])

    parts = map_arrow(fit, run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    value = {(r.i, r.j): (int(r.high) << LIMB) + int(r.low) for r in rows}
    if not value:
        return 0, [0] * dim, [[0] * dim for _ in range(dim)]
    return (value[-1, -1], [value[-1, j] for j in range(dim)],
            [[value[min(i, j), max(i, j)] for j in range(dim)] for i in range(dim)])


# ---- characteristic polynomial --------------------------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin; the four bases decide every number below 2^31."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for base in (2, 3, 5, 7):
        y = pow(base, d, n)
        if y in (1, n - 1):
            continue
        for _ in range(r - 1):
            y = y * y % n
            if y == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(limit: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds ``limit``."""
    found, total, p = [], 1, (1 << 31) - 1
    while total <= limit:
        if is_prime(p):
            found.append(p)
            total *= p
        p -= 2
    return found


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix modulo ``p`` with zeros below the first subdiagonal (entries below 2^31)."""
    a = a % p
    for k in range(len(a) - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not len(below):
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            a[[k + 1, at]] = a[[at, k + 1]]
            a[:, [k + 1, at]] = a[:, [at, k + 1]]
        f = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - f[:, None] * a[k + 1]) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * f % p).sum(axis=1)) % p
    return a


def polynomial_mod(a: np.ndarray, p: int) -> list[int]:
    """det(xI - a) modulo ``p``, the constant first."""
    h, d = hessenberg(a, p), len(a)
    polys = np.zeros((d + 1, d + 1), np.int64)  # of the leading square blocks
    polys[0, 0] = 1
    for m in range(1, d + 1):
        new = np.roll(polys[m - 1], 1) - h[m - 1, m - 1] * polys[m - 1] % p
        weights, t = np.zeros(m - 1, np.int64), 1
        for i in range(m - 2, -1, -1):
            t = t * int(h[i + 1, i]) % p
            weights[i] = int(h[i, m - 1]) * t % p
        polys[m] = (new - (weights[:, None] * polys[:m - 1] % p).sum(axis=0)) % p
    return polys[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """det(xI - matrix) of a positive semidefinite integer matrix, exact, the constant first.

    The coefficient of a power k is at most C(d, k) (trace / d)^k by Maclaurin's inequality, which says
    how many primes are needed. Spark tasks take some primes each."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    limit = 2 * max(comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_beyond(limit)
    sent = spark.sparkContext.broadcast(matrix)  # dimensions squared

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for k in b.column(0).to_pylist():
                p = primes[k]
                a = np.array([[v % p for v in row] for row in sent.value], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([polynomial_mod(a, p)], pa.list_(pa.int64()))], ["k", "c"])

    numbers = spark.range(0, len(primes), 1, max(1, len(primes) // PRIMES_A_TASK))
    residues = {r.k: r.c for r in map_arrow(numbers, run, "k bigint, c array<bigint>").collect()}
    total = prod(primes)
    units = [total // p * pow(total // p, -1, p) for p in primes]  # one modulo p, zero modulo the others
    out = []
    for i in range(d + 1):
        c = sum(u * residues[k][i] for k, u in enumerate(units)) % total
        out.append(c - total if c > total // 2 else c)
    return out


# ---- roots ----------------------------------------------------------------------------------

def roots_above(poly: list[int], at: int) -> int:
    """Number of roots beyond ``at``, repeats counted. A polynomial with real roots only has as many
    positive roots as its coefficients change sign, so the count is exact."""
    c = poly[:]
    if at:
        for i in range(len(c) - 1):
            for j in range(len(c) - 2, i - 1, -1):
                c[j] += at * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value(poly: list[int], at: int) -> int:
    y = 0
    for c in reversed(poly):
        y = y * at + c
    return y


def leading_roots(poly: list[int], trace: int, count: int) -> tuple[list[int], int]:
    """The ``count`` largest positive roots, repeats counted, in units of 2^-s, and s.

    Intervals are halved until each holds one root or is one unit wide (then its roots are taken as
    equal). ``poly`` has real roots from 0 to ``trace`` only."""
    s = max(0, ROOT_BITS - trace.bit_length())
    d = len(poly) - 1
    scaled = [c << s * (d - i) for i, c in enumerate(poly)]
    found: list[int] = []
    stack = [(0, roots_above(scaled, 0), trace << s, 0)]  # low end, roots beyond it, high end, roots beyond it
    while stack and len(found) < count:
        low, above, high, beyond = stack.pop()
        if above == beyond:
            continue
        if high - low == 1:
            found += [high] * (above - beyond)
        elif above - beyond == 1:
            found.append(narrow(scaled, low, high))
        else:
            mid = (low + high) // 2
            n = roots_above(scaled, mid)
            stack += [(low, above, mid, n), (mid, n, high, beyond)]
    return found[:count], s


def narrow(poly: list[int], low: int, high: int) -> int:
    """The upper end of the unit interval that holds the only root beyond ``low`` up to ``high``."""
    sign = value(poly, high)
    if sign == 0:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        y = value(poly, mid)
        if y == 0:
            return mid
        low, high = (low, mid) if (y > 0) == (sign > 0) else (mid, high)
    return high


# ---- components -----------------------------------------------------------------------------

def factors(a: np.ndarray, tiny: Decimal) -> tuple[np.ndarray, list[int]]:
    """Lower and upper factors of a matrix of decimals, with row exchanges; zero pivots become ``tiny``."""
    a, order = a.copy(), list(range(len(a)))
    for k in range(len(a)):
        at = k + max(range(len(a) - k), key=lambda i: abs(a[k + i, k]))
        if at != k:
            a[[k, at]] = a[[at, k]]
            order[k], order[at] = order[at], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1:, k] = a[k + 1:, k] / a[k, k]
        a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - a[k + 1:, k][:, None] * a[k, k + 1:]
    return a, order


def solve(lu: np.ndarray, order: list[int], b: np.ndarray) -> np.ndarray:
    y = b[order]
    for k in range(1, len(y)):
        y[k] = y[k] - (lu[k, :k] * y[:k]).sum()
    for k in range(len(y) - 1, -1, -1):
        rest = (lu[k, k + 1:] * y[k + 1:]).sum() if k + 1 < len(y) else Decimal(0)
        y[k] = (y[k] - rest) / lu[k, k]
    return y


def components_at(matrix: list[list[int]], roots: list[int], s: int) -> list[np.ndarray]:
    """Unit vectors of the null spaces at the roots (in units of 2^-s), as doubles, orthogonal to each other."""
    d, found, rng = len(matrix), [], random.Random(SEED)
    with localcontext() as context:
        context.prec = DIGITS
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        tiny = Decimal(sum(matrix[i][i] for i in range(d))).scaleb(10 - DIGITS)
        held: dict[int, tuple[np.ndarray, list[int]]] = {}
        for r in roots:
            if r not in held:
                shifted = a.copy()
                shifted[np.arange(d), np.arange(d)] = shifted[np.arange(d), np.arange(d)] - Decimal(r) / Decimal(1 << s)
                held[r] = factors(shifted, tiny)
            v = np.array([Decimal(rng.randint(1, 1000)) for _ in range(d)], object)
            for _ in range(ITERATIONS):
                v = solve(*held[r], v)
                for w in found:
                    v = v - w * (v * w).sum()
                v = v / (v * v).sum().sqrt()
            top = max(range(d), key=lambda i: (abs(v[i]), -i))
            found.append(v if v[top] > 0 else -v)
        return [np.array([float(y) for y in v]) for v in found]


@dataclass
class Whitening:
    """A fitted whitening: ``n`` vectors with sums ``total``; unit components, their deviations and shares."""

    n: int
    total: list[int]
    components: np.ndarray  # (components, dimensions)
    roots: np.ndarray       # square roots of the eigenvalues of the covariance
    explained: np.ndarray

    def centred(self, x: np.ndarray, bound: int) -> np.ndarray:
        """n * x - S of the rows of ``x``, exact: 64-bit integers if they hold it, else Python's."""
        if 2 * self.n * bound < 1 << 63:
            return x * self.n - np.array(self.total, np.int64)
        return x.astype(object) * self.n - np.array(self.total, object)

    @staticmethod
    def deviations(centred: np.ndarray) -> list[int | None]:
        """The sum of squares of each row, exact; null if no long holds it."""
        top = int(np.abs(centred).max(initial=0))
        exact = centred if centred.shape[1] * top * top < 1 << 63 else centred.astype(object)
        return [v if v < 1 << 63 else None for v in (exact * exact).sum(axis=1).tolist()]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.components.T / self.roots


def fit_whitening(fit: DataFrame, dim: int, bound: int, count: int) -> Whitening:
    """Up to ``count`` components of the vectors of ``fit`` (x binary)."""
    spark = fit.sparkSession
    n, total, products = scatter(fit, dim, bound)
    full = [[n * products[i][j] - total[i] * total[j] for j in range(dim)] for i in range(dim)]
    common = gcd(*[v for row in full for v in row]) if dim else 0
    none = Whitening(n, total, np.zeros((0, dim)), np.zeros(0), np.zeros(0))
    if not common:  # no vector, or all are equal
        return none
    matrix = [[v // common for v in row] for row in full]
    trace = sum(matrix[i][i] for i in range(dim))
    roots, s = leading_roots(characteristic_polynomial(spark, matrix), trace, count)
    vectors = components_at(matrix, roots, s)
    with localcontext() as context:
        context.prec = DIGITS
        values = [Decimal(r) / Decimal(1 << s) for r in roots]  # n² / common times those of the covariance
        return Whitening(n, total, np.array(vectors), np.array([float((v * common).sqrt() / n) for v in values]),
                         np.array([float(v / trace) for v in values]))


def identity_error(fit: DataFrame, dim: int, bound: int, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = len(model.roots)
    names = [f"w{i}" for i in range(k)]

    def run(batches):
        for b in batches:
            w = model.whitened(model.centred(unpack(b.column(0), dim), bound))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in range(k)], names)

    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = (map_arrow(fit, run, ", ".join(f"{c} double" for c in names))
           .agg(*[F.covar_pop(names[i], names[j]).alias(f"v{i}_{j}") for i, j in pairs]).first())
    return max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs))


def whiten(df: DataFrame, vec_col: str = "embedding", components: int = 4, carried: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """A row per kept vector and component: ``(carried, component int, n long, deviation long, whitened
    double, explained double, identity_error double)``.

    Entries c become x = floor(256 * c). The components are fitted on every distinct x once: ``n`` of
    them. ``deviation`` is the sum of (n * x - S)² over the dimensions, null if no long holds it.
    Components of eigenvalue zero are not returned, so equal vectors or a single one give no rows.
    Dropped are vectors that are null, hold an entry that is null, not finite or, scaled, beyond a long,
    or whose length is not that of most vectors (ties: the longer). Repeated rows and null ids are
    returned as they come; an empty table gives no rows; only the named columns are read; a carried
    column named like a returned one is refused (ValueError). Equal eigenvalues have any orthonormal components."""
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    if clash := set(names) & set(carried):
        raise ValueError(f"columns cannot be carried: {sorted(clash)}")
    rows, dim, bound = lattice(df, vec_col, carried)
    fit = stage(rows.select("x").distinct(), "fit")
    model = fit_whitening(fit, dim, bound, components)
    k = len(model.roots)
    error = identity_error(fit, dim, bound, model) if k else 0.0

    def run(batches):
        for b in batches:
            if not k:
                continue
            centred = model.centred(unpack(b.column(b.num_columns - 1), dim), bound)
            at = np.repeat(np.arange(b.num_rows), k)
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(at)) for c in b.columns[:-1]], pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                 pa.array(np.full(len(at), model.n)), pa.array(model.deviations(centred), pa.int64()).take(pa.array(at)),
                 pa.array(model.whitened(centred).ravel()), pa.array(np.tile(model.explained, b.num_rows)), pa.array(np.full(len(at), error))],
                [*b.schema.names[:-1], *names])

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    done = map_arrow(rows, run, kinds + "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    return done.toDF(*carried, *names)
