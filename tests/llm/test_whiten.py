"""Exact steps against definitions, whole results against numpy, edge cases."""

import random
from decimal import Decimal
from fractions import Fraction

from llm_fixtures import SF_SMALL
import numpy as np
import pytest

from critloom.llm import lattice, whiten
from critloom.llm.queries import op11_embedding_whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def psd(rng, d, size, rank=None):
    a = [[rng.randint(-size, size) for _ in range(rank or d)] for _ in range(d)]
    return [[sum(x * y for x, y in zip(r, s)) for s in a] for r in a]


def by_definition(matrix):
    """det(xI - M) by Faddeev and LeVerrier's recursion, the constant first."""
    d = len(matrix)
    m, c = [[0] * d for _ in range(d)], [0] * d + [1]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][l] * m[l][j] for l in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        am = sum(sum(matrix[i][l] * m[l][i] for l in range(d)) for i in range(d))
        c[d - k] = int(Fraction(-am, k))
    return c


def test_polynomials_equal_the_definition(spark):
    rng = random.Random(1)
    for d, size, rank in ((1, 5, None), (3, 10, None), (6, 10**9, None), (8, 50, 3), (5, 0, None)):
        m = psd(rng, d, size, rank)
        assert whiten.characteristic_polynomial(spark, m) == by_definition(m)
    m = psd(rng, 12, 10**6)
    p = whiten.primes_beyond(1)[0]
    assert whiten.polynomial_mod((np.array(m, object) % p).astype(np.int64), p) == [c % p for c in by_definition(m)]


def test_primes():
    sieve = [n for n in range(2, 2000) if all(n % k for k in range(2, int(n ** 0.5) + 1))]
    assert [n for n in range(2000) if whiten.is_prime(n)] == sieve
    assert whiten.is_prime((1 << 31) - 1) and not whiten.is_prime(46337 * 46339)


def test_roots_are_counted_and_narrowed():
    poly = [1]
    for r in (7, 7, 3, 0, 12):  # (x - r) multiplied out
        poly = [(poly[i - 1] if i else 0) - r * (poly[i] if i < len(poly) else 0) for i in range(len(poly) + 1)]
    assert [whiten.roots_above(poly, at) for at in (0, 2, 3, 6, 7, 11, 12)] == [4, 4, 3, 3, 1, 1, 0]
    roots, s = whiten.leading_roots(poly, 29, 5)
    assert [round(Fraction(r, 1 << s)) for r in roots] == [12, 7, 7, 3]
    assert whiten.leading_roots(poly, 29, 2)[0] == roots[:2]
    m = psd(random.Random(2), 9, 1000)
    roots, s = whiten.leading_roots(by_definition(m), sum(m[i][i] for i in range(9)), 9)
    assert np.allclose([r / (1 << s) for r in roots], np.linalg.eigvalsh(np.array(m, float))[::-1], rtol=1e-9)


def test_close_and_equal_eigenvalues_give_orthogonal_components():
    """Eigenvalues that differ by a 10^-30th part, and a pair of equal ones."""
    big = 10 ** 30
    m = [[big + 1, 0, 0, 0], [0, big, 0, 0], [0, 0, 5, 0], [0, 0, 0, 5]]
    roots, s = whiten.leading_roots(by_definition(m), 2 * big + 11, 4)
    v = whiten.components_at(m, roots, s)
    assert np.allclose(np.abs(v[0]), [1, 0, 0, 0], atol=1e-15) and np.allclose(np.abs(v[1]), [0, 1, 0, 0], atol=1e-15)
    assert np.allclose(np.array(v) @ np.array(v).T, np.eye(4), atol=1e-15)


def test_scatter_is_exact_for_all_sizes():
    for bound in (200, 1 << 20, 1 << 30, 1 << 60):
        x = np.random.default_rng(1).integers(-bound, bound, (50, 3))
        total, products = whiten.scatter_of(x, bound)
        o = x.astype(object)
        assert total.tolist() == o.sum(axis=0).tolist() and products.tolist() == (o.T @ o).tolist()


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA)


def reference(rows, components):
    """From the definitions, in numpy: {(id, component): (n, deviation, |whitened|, explained)}, rows repeated once."""
    x = {i: np.array([np.floor(256 * c) + 0 for c in v]).astype(np.int64) for i, v in rows}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (fit - s / n).T @ (fit - s / n) / n
    e, v = np.linalg.eigh(c)
    e, v = e[::-1], v[:, ::-1]
    return {(i, k + 1): (n, int(((n * y - s) ** 2).sum()), abs((y - s / n) @ v[:, k] / np.sqrt(e[k])), e[k] / e.sum())
            for i, y in x.items() for k in range(components)}


def close(got, want):
    assert len(got) == len(want)
    for r in got:
        w = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == w[:2] and r.identity_error <= 1e-9
        assert abs(abs(r.whitened) - w[2]) < 1e-6 * max(1, w[2]) and abs(r.explained - w[3]) < 1e-9


def test_query_equals_numpy_on_a_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = op11_embedding_whitening(spark, SF_SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    close(got.collect(), reference(rows, 4))


def test_edges(spark):
    rng, nan, inf = random.Random(4), float("nan"), float("inf")
    good = [(i, [rng.uniform(-1, 1) * (j + 1) for j in range(5)]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [nan] * 5), (103, [inf, 0.0, 0.0, 0.0, 0.0]), (104, []),
           (105, [1.0]), (106, [1e300, 0.0, 0.0, 0.0, 0.0])]
    copies = [good[3]] * 30  # copies do not weigh in the fit
    d = table(spark, good + bad + copies).withColumnRenamed("label", "n")
    got = whiten.whiten(d, components=3).collect()
    assert len(got) == 3 * 70
    close(list({(r.vec_id, r.component): r for r in got}.values()), reference(good, 3))
    assert len({(r.whitened, r.deviation) for r in got if r.vec_id == 3}) == 3
    assert whiten.whiten(table(spark, [])).count() == 0
    assert whiten.whiten(table(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).count() == 0  # no variance
    assert whiten.whiten(table(spark, [(1, None)])).count() == 0
    assert whiten.whiten(table(spark, [(1, []), (2, [])])).count() == 0
    line = whiten.whiten(table(spark, [(1, [0.0, 0.0]), (None, [1.0, 1.0])])).collect()  # one component only
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation, round(abs(r.whitened), 9), r.explained) for r in line) == [
        (0, 1, 2, 2 * 256 * 256, 1.0, 1.0), (1, 1, 2, 2 * 256 * 256, 1.0, 1.0)]
    with pytest.raises(ValueError):
        whiten.whiten(d, carried=("vec_id", "n"))


def test_huge_entries_stay_exact(spark):
    base = 2.0 ** 40
    rows = [(i, [base + v, -base + v * v, v]) for i, v in enumerate((0.0, 1.0, 2.0, 5.0))]
    got = whiten.whiten(table(spark, rows), components=2).collect()
    x = [[int(256 * c) for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((4 * a - b) ** 2 for a, b in zip(v, s)) for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in got} == want and max(r.identity_error for r in got) < 1e-9
    far = whiten.whiten(table(spark, [(1, [2.0 ** 50, 0.0]), (2, [-2.0 ** 50, 1.0])]), components=1).collect()
    assert [r.deviation for r in far] == [None, None] and all(abs(abs(r.whitened) - 1) < 1e-9 for r in far)


def test_lattice_packs_and_unpacks(spark):
    v = [[0.0, -128.0, 127.99], [1e6, -0.001, 0.0], [-2.0 ** 55, 2.0 ** 54, 1.0]]
    rows, dim, bound = lattice.lattice(table(spark, list(enumerate(v))), "embedding", ("vec_id",))
    got = {r.c0: bytes(r.x) for r in rows.collect()}
    assert dim == 3 and bound >= 2 ** 62 and [len(got[i]) for i in range(3)] == [6, 12, 24]
    import pyarrow as pa
    assert lattice.unpack(pa.array([got[i] for i in range(3)], pa.binary()), 3).tolist() == [
        [int(Decimal(c) * 256 // 1) if c >= 0 else -int(-(Decimal(c) * 256) // 1) - (Decimal(c) * 256 % 1 != 0) for c in x] for x in v]
