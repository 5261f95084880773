"""Water-filling against a plain loop, sampled words near their targets, edge cases."""

import re

from llm_fixtures import SF_SMALL, docs  # noqa: F401
import pytest
from pyspark.sql import functions as F

from critloom.llm import mixing


def pour(sizes, weights, cap):
    total, target, open_ = sum(sizes), {}, set(range(len(sizes)))
    left = total
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if level * weights[i] > cap * sizes[i]]
        if not full:
            target.update({i: level * weights[i] for i in open_})
            break
        for i in full:
            target[i] = cap * sizes[i]
            left -= target[i]
            open_.remove(i)
    return [float(target[i]) for i in range(len(sizes))]


@pytest.mark.parametrize("sizes", [[10, 1000, 1000], [1, 2, 3, 4, 500, 6], [0, 7, 0, 1], [5], [1, 1, 1000, 1, 1, 1, 1, 1]])
def test_targets(spark, sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    df = spark.createDataFrame([(i, s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "i int, size bigint, weight bigint")
    got = [r.target for r in sorted(mixing.water_fill(df).collect(), key=lambda r: r.i)]
    assert got == pytest.approx(pour(sizes, weights, 3))
    assert sum(got) == pytest.approx(sum(sizes))


def test_a_table_is_mixed_near_its_targets_and_again_alike(spark):
    d = spark.read.parquet(f"{SF_SMALL}/../sf0.01/documents.parquet")
    rows = mixing.mix(d, carried=("doc_id", "source", "text")).collect()
    assert len(rows) == d.count()
    by = {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) and r.taken == r["size"] * r.copies and 0 <= r.copies <= 3
        by.setdefault(r.source, []).append(r)
    names = sorted(by)
    want = pour([sum(r["size"] for r in by[s]) for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))], 3)
    for s, t in zip(names, want):
        rs = by[s]
        assert rs[0].target == pytest.approx(t) and rs[0].source_size == sum(r["size"] for r in rs)
        assert abs(sum(r.taken for r in rs) - t) <= max(r["size"] for r in rs) / 2 + 1
        assert max(r.copies for r in rs) - min(r.copies for r in rs) <= 1
    again = {r.doc_id: r.taken for r in mixing.mix(d.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_edges(spark, docs):
    assert mixing.mix(docs([])).count() == 0
    rows = [(1, "a b c", "en", "x"), (2, None, "en", None), (3, "", "en", "empty"), (None, "d e", "en", None), (1, "a b c", "en", "x"),
            (5, "w " * 300_000, "en", "é"), (6, "z", "en", "null"), (7, "z", "en", "")]
    got = mixing.mix(docs(rows).withColumn("size", F.lit("clash")).withColumn("key", F.lit(0)).withColumn("copies", F.lit(9))).collect()
    assert len(got) == len(rows)
    assert all(r.taken <= 3 * r["size"] for r in got)
    null_source = [r for r in got if r.doc_id in (2, None)]
    assert {r.source_size for r in null_source} == {2}
    assert len({r.taken for r in got if r.doc_id == 1}) == 1  # equal rows share their fate
    nothing = mixing.mix(docs([(1, "", "en", "a"), (2, None, "en", "b")])).collect()
    assert [r.taken for r in nothing] == [0, 0]
