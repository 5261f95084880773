"""L1/S2 (T8): exact split sizes, determinism, disjointness; slices, job ranges, skew-safe ranks."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from critloom.operators import ranking
from critloom.operators.ranking import assign_jobs, exact_split, group_rank, slice_rows, value_at


@pytest.mark.parametrize("n,expected", [(0, 0), (1, 1), (10, 1), (1000, 100)])
def test_sizes(spark, n, expected):
    df = spark.range(n).withColumnRenamed("id", "k")
    out = exact_split(df, ["k"], 0.1, 42)
    assert out.filter(F.col("split") == "test").count() == expected
    assert out.count() == n


def test_seed_and_order(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"] for r in exact_split(df, ["k"], 0.1, 42).filter("split = 'test'").collect()}
    b = {r["k"] for r in exact_split(df.orderBy(F.desc("k")).repartition(5), ["k"], 0.1, 42)
         .filter("split = 'test'").collect()}
    c = {r["k"] for r in exact_split(df, ["k"], 0.1, 7).filter("split = 'test'").collect()}
    assert a == b and a != c and len(a) == 100


def test_matches_global_rank(spark):
    df = spark.range(777).withColumnRenamed("id", "k")
    h = F.md5(F.concat(F.lit("42:"), F.col("k").cast("string")))
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(h, F.col("k").cast("string"))))
    want = {r["k"] for r in ref.filter(F.col("rn") <= math.ceil(0.1 * 777)).collect()}
    got = {r["k"] for r in exact_split(df, ["k"], 0.1, 42).filter("split = 'test'").collect()}
    assert got == want


def test_group_rank_hashed_hot_group(spark):
    import hashlib
    df = spark.range(3000).select(F.when(F.col("id") < 2500, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
                                  F.col("id").alias("o"))
    got = {r["o"]: r["rank"] for r in group_rank(df, ["g"], "o", seed=5).collect()}
    for g, ids in (("hot", range(2500)), ("cold", range(2500, 3000))):
        ranked = sorted(ids, key=lambda i: (hashlib.md5(f"5:{i}".encode()).hexdigest(), i))
        assert all(got[i] == k for k, i in enumerate(ranked, start=1))


def test_slice_lookup_is_pushed_to_scan(spark, tmp_dir):
    import os
    path = os.path.join(tmp_dir, "t")
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(path)
    out = slice_rows(spark.read.parquet(path), "k", 10, 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,10), LessThanOrEqual(k,14)]" in plan
    assert [r["k"] for r in out.orderBy("k").collect()] == [10, 11, 12, 13, 14]


def test_split_plan_has_no_exchange(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    plan = exact_split(df, ["k"], 0.1, 42)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_slice_rows(spark):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "k").repartition(4)
    got = [r["k"] for r in slice_rows(df, "k", 100, 25).orderBy("k").collect()]
    assert got == list(range(300, 375, 3))
    assert slice_rows(df, "k", 990, 50).count() == 10   # past the end: fewer rows
    assert slice_rows(df, "k", 5000, 5).count() == 0


def test_assign_jobs(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    jobs = {r["k"]: r["job_id"] for r in assign_jobs(df, "k", 4).collect()}
    assert jobs == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 1, 8: 2, 9: 2}
    jobs = {r["k"]: r["job_id"] for r in assign_jobs(df, "k", 3, offset=5).collect()}
    assert jobs == {5: 0, 6: 0, 7: 0, 8: 1, 9: 1}


def test_group_rank_hot_group(spark):
    # one group holds most rows: ranks must equal a plain window
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(
        (F.col("id") % 10).cast("string")).alias("g"), (F.col("id") * 7 % 5003).alias("o"))
    got = {(r["g"], r["o"]): r["rank"] for r in group_rank(df, ["g"], "o").collect()}
    ref = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    want = {(r["g"], r["o"]): r["rank"] for r in ref.collect()}
    assert got == want


def test_null_keys_have_no_position(spark):
    df = spark.createDataFrame([(None,), (None,)] + [(i,) for i in range(10)], "k long")
    assert [r["k"] for r in slice_rows(df, "k", 0, 3).orderBy("k").collect()] == [0, 1, 2]
    jobs = assign_jobs(df, "k", 5)
    assert jobs.count() == 10 and jobs.filter("k IS NULL").count() == 0


def test_ten_thousand_jobs_in_one_small_plan(spark):
    df = spark.range(10_000).select((F.col("id") * 3).alias("k"))
    few, many = assign_jobs(df, "k", 1000), assign_jobs(df, "k", 1)
    size = [len(x._jdf.queryExecution().analyzed().toString()) for x in (few, many)]
    assert size[1] < 1.2 * size[0]                      # nothing in the plan grows with the jobs
    got = {r["k"]: r["job_id"] for r in many.collect()}
    assert got == {3 * i: i for i in range(10_000)}


def test_an_outlier_key_does_not_crowd_the_rest(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 7, F.lit(4 * 10**18)).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    try:
        parts = ranking._sorted_parts(df, [F.col("k")]).groupBy(F.shiftright("_mid", 33)).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 4 and max(r["count"] for r in parts) < 6000
    jobs = {r["job_id"]: r["count"] for r in assign_jobs(df, "k", 100).groupBy("job_id").count().collect()}
    assert jobs == {j: 100 for j in range(200)}
    assert value_at(df, "k", 20_000) == 4 * 10**18 and value_at(df, "k", 19_999) == 19_999 and value_at(df, "k", 8) == 8
    assert slice_rows(df, "k", 19_998, 5).count() == 2


@pytest.mark.parametrize("keys", [[5], [3, 3, 3], [-4, -4, 0, 9, 9, 2**62, -2**62], list(range(-50, 50, 7))])
def test_value_at_every_position(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long")
    assert [value_at(df, "k", p) for p in range(0, len(keys) + 2)] == [None, *sorted(keys), None]


def test_split_is_exact_under_repeated_keys(spark):
    df = spark.range(99).select((F.col("id") % 33).alias("k"), F.col("id").alias("job"))
    for size, want in ((0.1, 10), (0.5, 50), (7, 7)):
        out = exact_split(df, ["k"], size, 42)
        assert out.filter("split = 'test'").count() == want and out.count() == 99
    hot = spark.range(300).select(F.when(F.col("id") < 200, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("job"))
    assert exact_split(hot, ["k"], 0.25, 42).filter("split = 'test'").count() == 75


def test_identical_rows_at_the_boundary_are_refused(spark):
    df = spark.range(99).select((F.col("id") % 33).alias("k"))
    with pytest.raises(ValueError):
        exact_split(df, ["k"], 0.1, 42)
    assert exact_split(df, ["k"], 9, 42).filter("split = 'test'").count() == 9  # whole keys fit


def test_jobs_of_a_hot_key_are_cut_without_one_task(spark):
    """A third of all rows share a key: its rows are numbered in several partitions and share one job."""
    from critloom.operators.ranking import assign_jobs
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 500 ELSE id END AS k", "id AS row").repartition(6)
    got = assign_jobs(df, "k", 250).groupBy("k").agg(F.count_distinct("job_id").alias("jobs"), F.min("job_id").alias("j"), F.count("*").alias("n"))
    rows = {r.k: (r.jobs, r.j, r.n) for r in got.collect()}
    keys = sorted(r.k for r in df.select("k").collect())
    first = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    assert rows == {k: (1, i // 250, keys.count(k)) for k, i in first.items()}
