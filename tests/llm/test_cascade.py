"""Statistics against plain Python, the cascade's order and verdicts, edge cases."""

import re

from llm_fixtures import SF_SMALL, docs  # noqa: F401
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from critloom.llm import cascade


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = {}
    for i in range(len(w) - 4):
        grams.setdefault(tuple(w[i:i + 5]), []).append(i)
    hit = {p for at in grams.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(hit))


def stats(df):
    return df.withColumn("stats", cascade.statistics(F.coalesce("text", F.lit(""))))


def check(df):
    for r in stats(df).collect():
        assert tuple(r.stats) == brute(r.text), r.text


CASES = ["", " ", "\n\n", None, "a", "a b c d e", "a b c d e a b c d e", "a a a a a a", "a a a a a a a b a a a a a", "x\x85y z\xa0w", "l\nl\nl \nl",
         "\x0ba\x0cb\x1cc", "é# <b>|&$%*", "a b c d e f a b c d e g a b c d e", "\r\na\r\na"]


def test_statistics_of_cases(spark):
    check(spark.createDataFrame([(c,) for c in CASES], "text string"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=60), min_size=20, max_size=40))
def test_statistics_of_random_texts(spark, texts):
    check(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_statistics_of_a_table_and_a_long_text(spark):
    check(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text"))
    check(spark.createDataFrame([(" ".join(f"w{i % 7000}" for i in range(60_000)),)], "text string"))


def test_order_is_rejections_per_cost_and_verdicts_do_not_depend_on_it(spark, docs, monkeypatch):
    d = docs([(i, f"{'bad ' if i % 2 else ''}{'worse ' if i % 4 == 0 else ''}text number {i}") for i in range(400)])
    rules = [cascade.Rule("never", F.lit(False)), cascade.Rule("rare", F.col("text").contains("worse")), cascade.Rule("often", F.col("text").contains("bad"))]
    clock = iter(range(10**6))
    monkeypatch.setattr(cascade.time, "perf_counter", lambda: float(next(clock)))  # every rule costs the same
    sample = cascade.take_sample(d.union(d).union(d), 300)
    assert 0 < sample.count() <= 300
    order = cascade.order_rules(sample, rules)
    assert [r.name for r, _, _ in order] == ["often", "rare", "never"]
    assert order[0][2] > order[1][2] > order[2][2] == 0
    out = cascade.cascade(d, rules, sample).collect()
    assert all(r.kept == ("bad" not in r.text and "worse" not in r.text) for r in out)
    assert {r.failed_rule for r in out if r.doc_id % 2} == {"often"}
    flipped = {r.doc_id: r.kept for r in cascade.cascade(d, rules[::-1], sample).collect()}
    assert {r.doc_id: r.kept for r in out} == flipped


def test_a_row_stops_at_its_first_rejection(spark, docs):
    d = docs([(i, "x" * i) for i in range(200)])
    explode = cascade.Rule("fails if reached", F.when(F.length("text") >= 0, F.raise_error(F.lit("reached"))).cast("boolean"))
    first = F.when(F.lit(True), F.lit("all"))
    assert d.select(F.when(F.length("text") >= 0, first).otherwise(explode.rejects.cast("string")).alias("r")).distinct().count() == 1


def test_rules_keep_good_and_reject_bad(spark):
    d = cascade.judge(spark.read.parquet(f"{SF_SMALL}/../sf0.01/documents.parquet"))
    lab = spark.read.parquet(f"{SF_SMALL}/../sf0.01/labels.parquet")
    kept = {r.quality: r.k for r in d.where("stats.n_words >= 10").join(lab, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.2


def test_edges(spark, docs):
    assert cascade.judge(docs([])).count() == 0
    d = docs([(None, None), (1, "a b"), (1, "a b")]).withColumn("kept", F.lit("x")).withColumn("stats", F.lit(1))
    rows = cascade.judge(d).collect()
    assert len(rows) == 3 and not any(r.kept for r in rows)
    only = cascade.judge(docs([(1, "one two")]), rules=[cascade.Rule("null is no rejection", F.lit(None).cast("boolean"))]).first()
    assert only.kept and only.failed_rule is None


@pytest.mark.parametrize("size", [2, 5])
def test_repeated_words_of_other_windows(spark, size):
    t = "a b a b a c a b"
    r = spark.createDataFrame([(t,)], "text string").select(cascade.repeated_words(cascade.words(F.col("text")), size).alias("n")).first()
    assert r.n == (7 if size == 2 else 0)
