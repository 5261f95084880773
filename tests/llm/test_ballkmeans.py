"""Codes, codebooks and errors against exhaustive k-means, the balls against all distances, edge cases."""

import random

from llm_fixtures import SF_SMALL
import numpy as np
import pytest

from critloom.llm import ballkmeans as B
from critloom.llm.queries import op12_vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def exhaustive(rows, parts=16, entries=64, rounds=2):
    """(codes, errors, codebooks) of (id, vector) rows by comparing everything, in Python integers."""
    x = [[int(np.floor(256 * c)) for c in v] for _, v in rows]
    cuts = B.bounds(len(x[0]), parts)
    first = sorted(range(len(x)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))[:entries]
    books = [[x[i][a:b] for i in first] for a, b in zip(cuts, cuts[1:])]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    def assigned():
        return [[nearest(p, v[cuts[p]:cuts[p + 1]]) for p in range(parts)] for v in x]

    for _ in range(rounds):
        now = assigned()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[cuts[p]:cuts[p + 1]] for v, a in zip(x, now) if a[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    last = assigned()
    return [bytes(k for _, k in a) for a in last], [sum(d for d, _ in a) for a in last], books


def test_query_equals_exhaustive_search_on_a_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    codes, errors, books = exhaustive([(r.vec_id, r.embedding) for r in rows])
    of_label = {}
    for r, e in zip(rows, errors):
        of_label[r.label] = of_label.get(r.label, 0) + e
    got = {r.vec_id: r for r in op12_vector_codes(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for r, c, e in zip(rows, codes, errors):
        g = got[r.vec_id]
        assert (g.code, g.error, g.label_error, g.codebooks_sha256) == (c.hex(), e, of_label[r.label], B.digest(books))


@pytest.mark.parametrize("kind", [np.int64, object])
def test_balls_find_the_nearest_and_skip_most(kind):
    rng = np.random.default_rng(3)
    middles = rng.integers(-5000, 5000, (30, 4))
    x = (middles[rng.integers(0, 30, 2000)] + rng.integers(-300, 300, (2000, 4))).astype(kind)
    x = np.concatenate([x, middles.astype(kind), ((middles[:-1] + middles[1:]) // 2).astype(kind)])  # ties
    entries = np.concatenate([middles, middles[:3]]).astype(kind)  # equal entries
    codes, best = B.Balls(entries, None).nearest(x)
    d = B.distances(x, entries)
    assert codes.tolist() == [min(range(33), key=lambda j: (row[j], j)) for row in d.tolist()] and best.tolist() == d.min(axis=1).tolist()
    moved = entries + rng.integers(-40, 40, entries.shape).astype(kind)
    d = B.distances(x, moved)
    radii = [int(max([d[r, i] for r in np.flatnonzero(codes == i)], default=0)) for i in range(33)]
    for known in (radii, None, [None] * 33):
        new, dist, compared = B.Balls(moved, known).move(x, codes)
        assert new.tolist() == [min(range(33), key=lambda j: (row[j], j)) for row in d.tolist()]
        assert dist.tolist() == d.min(axis=1).tolist()
        assert compared < len(x) * 33 / 4


def rows_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_edges(spark):
    rng, nan = random.Random(1), float("nan")
    good = [(i, [float(rng.randint(-2, 2)) / 256 for _ in range(18)], i % 3 or None) for i in range(300)]  # many ties, parts of one and two
    good += [(500, good[7][1], 1)] * 200 + [(None, good[8][1], None)]
    bad = [(-5, None, 1), (-4, [nan] * 18, 1), (-3, [None] * 18, 1), (-2, [1.0], 1), (-1, [float("inf")] + [0.0] * 17, 1)]
    d = rows_of(spark, good + bad)
    coded, books = B.quantise(d, carried=("label",))
    codes, errors, want = exhaustive([(i, v) for i, v, _ in good])
    assert books == want and coded.columns == ["vec_id", "label", "codes", "error"]
    got = sorted((r.vec_id is None, r.vec_id or 0, bytes(r.codes), r.error) for r in coded.collect())
    assert got == sorted((i is None, i or 0, c, e) for (i, _, _), c, e in zip(good, codes, errors))
    sums = {}
    for (_, _, l), e in zip(good, errors):
        sums[l] = sums.get(l, 0) + e
    assert {r.label: r.label_error for r in B.label_errors(coded, "label").collect()} == sums
    assert B.label_errors(coded, "label").count() == len(good)
    with pytest.raises(ValueError):
        B.quantise(d.withColumnRenamed("label", "error"), carried=("error",))
    extra = d.selectExpr("*", "1 AS x", "2 AS codes", "3 AS c0")
    assert B.quantise(extra)[0].columns == ["vec_id", "codes", "error"]


def test_empty_small_and_huge(spark):
    empty, books = B.quantise(rows_of(spark, []))
    assert empty.count() == 0 and B.digest(books) == B.digest([[]])
    assert B.label_errors(empty.selectExpr("*", "1 AS label"), "label").count() == 0
    one, books = B.quantise(rows_of(spark, [(1, [0.5] * 32, 1)] * 3))
    assert [(bytes(r.codes), r.error) for r in one.collect()] == [(bytes(16), 0)] * 3 and len(books[0]) == 3
    none, _ = B.quantise(rows_of(spark, [(1, [], 1)]))
    assert [(bytes(r.codes), r.error) for r in none.collect()] == [(bytes(16), 0)]
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** 45 for _ in range(16)], 1) for i in range(80)]  # squares beyond a long
    coded, books = B.quantise(rows_of(spark, rows))
    codes, errors, want = exhaustive([(i, v) for i, v, _ in rows])
    assert books == want
    assert {r.vec_id: (bytes(r.codes), r.error) for r in coded.collect()} == {
        i: (c, e if e < 1 << 63 else None) for (i, _, _), c, e in zip(rows, codes, errors)}


def test_many_labels_are_joined(spark, monkeypatch):
    monkeypatch.setattr(B, "LABELS_SENT", 0)
    coded = spark.createDataFrame([(1, 5, None), (1, 7, 3), (2, 1, 3), (3, None, 4)], "vec_id long, error long, label int")
    assert sorted((r.vec_id, r.label_error or -1) for r in B.label_errors(coded, "label").collect()) == [(1, 5), (1, 8), (2, 8), (3, -1)]
