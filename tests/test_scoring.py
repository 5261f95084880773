"""Score extraction, clamp and score source."""

import pytest
from pyspark.sql import functions as F

from critloom.functions.scoring import clamp, extract_score, score_source

CASES = [
    ("SCORE: 8", 8.0), ("score: 3 ... SCORE: 7", 7.0), ("SCORE: 8.5", 8.5), ("SCORE: 15", 10.0),
    ("SCORE: 0", 1.0), ("SCORE: 8/10", 5.0), ("SCORE: 10/10", 1.0), ("SCORE: 8.5/10", 8.0),
    ("SCORE: -3", 3.0), ("SCORE: 5.", 5.0), ("SCORE: 8 / 10", 10.0), ("SCORE: **8**", 8.0),
    ("**SCORE:** 7", 7.0), ("I rate 8.5", 5.0), ("I rate 7 of 10", 10.0), ("7/10", 5.0), ("rate 11", 5.0),
    ("SCORE:\n9", 9.0), ("3 and 4 / 5", 5.0), ("", 5.0), ("none", 5.0), (None, 5.0),
    ("SCORE: 6", 6.0),  # a no-break space after the tag counts as space
    ("SCORE: ٨", 5.0),  # a non-ASCII digit is not a score digit and must not fail the cast
]


def test_score_table(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r["i"]: r["s"] for r in df.select("i", extract_score("t").alias("s")).collect()}
    for i, (text, want) in enumerate(CASES):
        assert got[i] == pytest.approx(want), (text, got[i], want)


def test_strict_and_source(spark):
    df = spark.createDataFrame([("SCORE: 4",), ("about 6 points",), ("nothing",)], "t string")
    rows = df.select(extract_score("t", strict=True).alias("s"), score_source("t").alias("src")).collect()
    assert [(r["s"], r["src"]) for r in rows] == [(4.0, "tag"), (6.0, "fallback"), (None, "default")]


def test_clamp_range(spark):
    df = spark.range(-5, 20).select(clamp(F.col("id").cast("double")).alias("c"))
    vals = [r["c"] for r in df.collect()]
    assert min(vals) == 1.0 and max(vals) == 10.0


def test_with_score_equals_separate_columns(spark):
    from critloom.functions.scoring import with_score
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    a = with_score(df, "t").select("i", "score", "score_source").collect()
    b = df.select("i", extract_score("t").alias("score"), score_source("t").alias("score_source")).collect()
    assert sorted(a) == sorted(b)
