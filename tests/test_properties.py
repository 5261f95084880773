"""Score parsing on composed texts, split against brute force."""

import hashlib
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from critloom.functions.scoring import extract_score
from critloom.operators.ranking import exact_split

# Texts whose score follows from how they are put together: (text, score).
TAGGED = [(f"{pre}{tag}{gap}{n}{post}", float(min(10, max(1, n)))) for n in (0, 1, 5, 9, 10, 11, 100)
          for pre in ("", "well done. ", "3 of 4 points, ", "SCORE: 2 at first, then ")
          for tag in ("SCORE:", "score:", "Score:") for gap in ("", " ", "\n") for post in ("", " ", "!", " points")]
PLAIN = [(f"{pre}{n}{post}", float(n)) for n in (1, 4, 7, 10) for pre in ("", "I give it ", "first 3, now ", "-") for post in ("", " overall", ".")]
NEITHER = [(t, 5.0) for t in ("", "no number", "11", "0", "100 and 250", "x7", "7x", "_7_", "7/10", "SCORE: none")]
OUT_OF = [("SCORE: 6 and SCORE: 8/10", 6.0), ("SCORE: 3 / 10. I say 7", 7.0), ("SCORE: 8.5", 8.5), ("SCORE: 9.25 ok", 9.25)]


def test_scores_of_composed_texts(spark):
    cases = TAGGED + PLAIN + NEITHER + OUT_OF
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["s"] for r in df.select("i", extract_score("t").alias("s")).collect()}
    bad = [(t, got[i], want) for i, (t, want) in enumerate(cases) if got[i] != want]
    assert not bad, bad[:5]


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(n=st.integers(min_value=0, max_value=400), frac=st.sampled_from([0.01, 0.1, 0.25, 0.5, 0.999]),
       seed=st.integers(min_value=0, max_value=10_000))
def test_split_matches_brute_force(spark, n, frac, seed):
    df = spark.range(n).select((F.col("id") * 7 + 3).alias("k"))
    got = {r["k"] for r in exact_split(df, ["k"], frac, seed).filter("split = 'test'").collect()}
    keys = [i * 7 + 3 for i in range(n)]
    ranked = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), str(k)))
    assert got == set(ranked[:math.ceil(frac * n)])
