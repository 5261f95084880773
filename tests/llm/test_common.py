"""Dense row numbers and connected components against plain Python."""

import random

from pyspark.sql import functions as F

from critloom.llm.common import chunks, components, row_numbers


def brute_components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_of_paths_stars_and_random_edges(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(-5, -9), (-9, 200)]
    edges += [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)] + [(7, 7), (1, 0), (0, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = brute_components([e for e in edges if e[0] != e[1]])
    assert got == want


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_row_numbers_are_dense_and_ordered(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "b", "c"]), i) for i in range(500)]
    df = row_numbers(spark.createDataFrame(rows, "k string, i long"), [F.col("k").isNull(), F.col("k"), F.col("i")], "n")
    got = [(r.k, r.i) for r in sorted(df.collect(), key=lambda r: r.n)]
    assert got == sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    assert sorted(r.n for r in df.collect()) == list(range(500))
    assert row_numbers(df.limit(0).drop("n"), [F.col("k")], "n").count() == 0


def test_chunks_hold_every_row_once():
    raw = [b"x" * n for n in (0, 5, 3, 100, 1, 1, 0)]
    got = list(chunks(raw, 6))
    assert [i for a, b in got for i in range(a, b)] == list(range(len(raw)))
    assert all(b - a == 1 or sum(map(len, raw[a:b])) <= 6 for a, b in got)
    assert list(chunks([], 6)) == []
