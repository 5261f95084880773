"""C9–C11 against brute force on small inputs."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from critloom.operators.model import StubScorer, StubVerdict
from critloom.operators.preference import gold_pairs, group_advantage, pair_rewards, principle_preference


def _pairs(items):
    return gold_pairs(items.select("doc_id", "lang", "quality"), items.select("doc_id", "text"))


def _items(spark):
    rows = [(i, f"text {i}", "en" if i % 3 else "fr", 1 if i % 2 else 0) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")


def test_gold_pairs_brute_force(spark):
    got = {(r["lang"], r["rank"]): (r["chosen_id"], r["rejected_id"]) for r in _pairs(_items(spark)).collect()}
    import hashlib
    pdf = _items(spark).toPandas()
    want = {}

    def order(ids):
        return sorted(ids, key=lambda i: (hashlib.md5(f"11:{i}".encode()).hexdigest(), i))

    for lang, g in pdf.groupby("lang"):
        good = order(g[g.quality == 1].doc_id)
        bad = order(g[g.quality == 0].doc_id)
        for k, (a, b) in enumerate(zip(good, bad), start=1):
            want[(lang, k)] = (a, b)
    assert got == want


def test_pair_rewards(spark):
    p = _pairs(_items(spark)).withColumn("prompt", F.lit("p"))
    rows = pair_rewards(p, StubScorer()).collect()
    sc = StubScorer()
    for r in rows:
        rc, rr = sc.score_batch(["p", "p"], [r["chosen"], r["rejected"]])
        assert r["reward_chosen"] == pytest.approx(rc) and r["margin"] == pytest.approx(rc - rr)
        assert r["correct"] == (rc > rr)


def test_group_advantage_brute_force(spark):
    rows = [(i, "hot" if i < 30 else f"g{i % 3}", float((i * 37) % 11)) for i in range(45)] + [(99, "single", 3.0)]
    df = spark.createDataFrame(rows, "id long, g string, reward double")
    got = {r["id"]: r["advantage"] for r in group_advantage(df, ["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "g", "reward"])
    for gname, g in pdf.groupby("g"):
        std = g.reward.std(ddof=1) if len(g) > 1 else 0.0
        for _, r in g.iterrows():
            assert got[r.id] == pytest.approx((r.reward - g.reward.mean()) / (std + 1e-4))
    assert got[99] == 0.0


def test_principle_preference_maps_back(spark):
    p = _pairs(_items(spark)).withColumn("prompt", F.lit("p"))
    rows = principle_preference(p, StubVerdict(), seed=3).collect()
    assert rows and all(r["preferred"] in ("chosen", "rejected") for r in rows)
    for r in rows:
        said = r["verdict"].rsplit("Answer: ", 1)[1]
        first = "rejected" if r["swapped"] else "chosen"
        second = "chosen" if r["swapped"] else "rejected"
        assert r["preferred"] == (first if said == "A" else second)


def test_unparseable_verdict_is_null(spark):
    import sys

    from pyspark import cloudpickle

    from critloom.operators.model import FunctionBackend
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    undecided = FunctionBackend(lambda batch: ["I cannot decide." for _ in batch], batch_size=8)
    p = _pairs(_items(spark)).withColumn("prompt", F.lit("p"))
    rows = principle_preference(p, undecided).collect()
    assert rows and all(r["preferred"] is None for r in rows)


def test_pairing_carries_ids_only_and_reads_labels_once(spark):
    from conftest import SF_SMALL
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lab = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "quality")
    pairs = gold_pairs(d.select("doc_id", "lang").join(lab, "doc_id"), d.select("doc_id", "text"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "labels.parquet" not in plan and "Window" not in plan   # ranked and paired before, on ids
    assert plan.count("documents.parquet") == 2                     # the two text lookups


def test_group_advantage_beyond_the_broadcast_bound(spark):
    rows = [(i, "hot" if i < 300 else f"g{i % 7}", float((i * 37) % 11)) for i in range(450)]
    df = spark.createDataFrame(rows, "id long, g string, reward double")
    small = {r["id"]: r["advantage"] for r in group_advantage(df, ["g"]).collect()}
    salted = group_advantage(df, ["g"], max_broadcast=0, salts=8)
    assert salted.columns == group_advantage(df, ["g"]).columns
    assert {r["id"]: r["advantage"] for r in salted.collect()} == pytest.approx(small)
