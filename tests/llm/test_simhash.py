"""Fingerprints, links and components against brute force; what is kept; edge cases."""

import random

from llm_fixtures import SF_SMALL, docs  # noqa: F401
import xxhash
from pyspark.sql import functions as F
from test_common import brute_components

from critloom.llm import simhash
from critloom.llm.queries import op10_simhash_near_dedup


def brute_print(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints, bits=3):
    fps = sorted(set(prints.values()))
    edges = [(a, b) for i, a in enumerate(fps) for b in fps[i:] if bin(a ^ b).count("1") <= bits]
    root = brute_components(edges)
    first = {}
    for i, f in prints.items():
        first[root[f]] = min(first.get(root[f], i), i)
    return {i: first[root[f]] for i, f in prints.items()}


def test_links_of_random_fingerprints(spark):
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    for f in list(fps):  # neighbours at 1 to 5 bits, also across the halves and at the sign bit
        for n in (1, 2, 3, 4, 5):
            g = f
            for b in rnd.sample(range(64), n):
                g ^= 1 << b
            fps.add(g)
        fps |= {f ^ (1 << 63), f ^ (1 << 31) ^ (1 << 32) ^ (1 << 63)}
    fps |= {0, 1, 3, 7, 15, (1 << 64) - 1}
    signed = [(f - (1 << 64) if f >> 63 else f) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "_fp bigint")
    for bits in (0, 1, 2, 3):
        got = {frozenset((r.u, r.v)) for r in simhash.links(df, bits).collect()}
        want = {frozenset((a, b)) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= bits}
        assert got == want
        assert {frozenset((r.u, r.v)) for r in simhash.links(df, bits, hot=2).collect()} == want  # crowded buckets


def test_hash_equals_the_engine_and_query_equals_brute_force(spark):
    assert spark.sql("SELECT xxhash64('a b c') AS h").first().h % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    want = brute_groups(prints)
    rows = op10_simhash_near_dedup(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    assert len(rows) == len(texts) and len(set(want.values())) < len(want)


def test_one_row_of_each_component_is_kept(spark, docs):
    base = "the quick brown fox jumps over the lazy dog and runs far away from the old grey wolf tonight " * 6
    rows = [(9, base), (4, base), (4, base), (7, base.upper()), (5, "other words altogether in this one"), (None, base), (None, ""), (3, None), (8, " \n")]
    d = docs(rows).withColumn("_h", F.lit(1)).withColumn("component_id", F.lit("clash"))
    kept = simhash.keep_one(d).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, None), (4, base), (5, "other words altogether in this one")]
    assert kept[0].asDict().keys() == d.first().asDict().keys()
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(d).collect()}
    assert (3, "0" * 16, 3) in got and (None, "0" * 16, 3) in got and {c for i, _, c in got if i in (9, 7)} == {4}


def test_edges(spark, docs):
    assert simhash.near_duplicates(docs([])).count() == 0 and simhash.keep_one(docs([])).count() == 0
    lone = simhash.near_duplicates(docs([(None, "a")])).first()
    assert lone.component_id is None and lone.fingerprint == f"{brute_print('a'):016x}"
    long = "w1 w2 w3 w4 " * 100_000
    r = simhash.near_duplicates(docs([(1, long), (2, "A\tB"), (3, "a b"), (4, "x\x85y z\xa0")])).collect()
    assert {x.doc_id: x.fingerprint for x in r} == {i: f"{brute_print(t):016x}" for i, t in ((1, long), (2, "A\tB"), (3, "a b"), (4, "x\x85y z\xa0"))}
    assert {x.doc_id: x.component_id for x in r}[3] == 2
