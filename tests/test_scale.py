"""Plan and distribution properties that matter at scale."""

from collections import Counter

from pyspark.sql import functions as F

from critloom.operators.history import (first_by_role, last_by_role, last_message, last_reply_pair, reply_pairs,
                                         unanswered)
from critloom.operators.ranking import HASH_BUCKET_CHARS, split_hash
from critloom.operators.sampling import pick_index


def _hot_conversations(spark):
    # one conversation holds a third of all messages
    return spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id") % 200 + 1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("text"))


def test_lookups_aggregate_partially_before_the_shuffle(spark):
    conv = _hot_conversations(spark)
    for df in (last_by_role(conv), last_message(conv), first_by_role(conv)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # map-side combine before the exchange (sort-based: the buffers hold strings)
        partial = plan.find("partial_max_by") if "partial_max_by" in plan else plan.find("partial_min_by")
        assert partial > plan.find("Exchange hashpartitioning") > 0
    r = {x["conv_id"]: x for x in last_by_role(conv).collect()}
    assert r[0]["last_user"] == "m998" and r[0]["last_assistant"] == "m999" and r[0]["n_messages"] == 1000


def test_split_count_table_is_bounded(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k")
    n = df.select(F.substring(split_hash(42, ["k"]), 1, HASH_BUCKET_CHARS).alias("b")).distinct().count()
    assert n <= 16 ** HASH_BUCKET_CHARS


def test_principle_picks_are_uniform(spark):
    df = spark.range(50_000).select(pick_index(5, 7, "id", F.lit(0), F.lit(0)).alias("p"))
    counts = Counter(r["p"] for r in df.collect())
    assert set(counts) == {0, 1, 2, 3, 4}
    assert all(abs(c - 10_000) < 500 for c in counts.values())  # ~5 standard deviations


def test_reply_pairs_join_not_window(spark):
    conv = _hot_conversations(spark)
    pairs = reply_pairs(conv)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if " Window " in x or "+- Window" in x]
    assert all("_part" in x and "conv" not in x for x in windows)   # only over the partitions' row counts
    got = {(r["conv_id"], r["turn"]): (r["prompt"], r["response"]) for r in pairs.collect()}
    rows = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in conv.collect())
    want = {}
    for (c1, t1, r1, x1), (c2, t2, r2, x2) in zip(rows, rows[1:]):
        if c1 == c2 and t2 == t1 + 1 and r1 == "user" and r2 == "assistant":
            want[(c2, t2)] = (x1, x2)
    assert got == want


def test_gaps_in_turns_lose_no_reply(spark):
    rows = [(1, 0, "user", "a"), (1, 10, "assistant", "b"), (1, 20, "user", "c"), (1, 30, "assistant", "d"), (1, 40, "user", "e"),
            (2, 0, "assistant", "x"), (2, 5, "user", "y"), (3, 0, "user", "q"), (3, 1, "assistant", "r"), (3, 2, "assistant", "s"),
            (4, 0, "system", "z"), (None, 0, "user", "n"), (None, 1, "assistant", "m")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["prompt"], r["response"]) for r in reply_pairs(conv).collect()}
    assert got == {(1, 10): ("a", "b"), (1, 30): ("c", "d"), (3, 1): ("q", "r"), (None, 1): ("n", "m")}
    last = {r["conv_id"]: (r["prompt"], r["response"]) for r in last_reply_pair(conv).collect()}
    assert last == {1: ("c", "d"), 3: ("q", "r"), None: ("n", "m")}
    left = {r["conv_id"]: (r["n_messages"], r["n_user"], r["n_assistant"]) for r in unanswered(conv).collect()}
    assert left == {2: (2, 1, 1), 4: (1, 0, 0)}
