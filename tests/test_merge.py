"""C4/X1 (T7): job directories, unreadable input, reruns, missing columns, streaming merge."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from critloom.plans.merge import merge_jobs
from critloom.schemas import PREFERENCES
from critloom.sources.jobs import write_job
from critloom.sources.published import publish_rows, published_jobs, read_published
from critloom.streaming.merge import incremental_merge, read_merged


def _rows(spark, ids, drop=None):
    df = spark.createDataFrame([(i, 0, f"q{i}", f"c{i}", f"r{i}") for i in ids],
                               "question_id long, turn int, question string, chosen string, rejected string")
    for f in PREFERENCES.fields:
        if f.name not in df.columns and f.name != "job_id":
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.drop(drop) if drop else df


def _files(target):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(target) for f in fs if f.endswith(".parquet"))


def test_merge_runs(spark, tmp_dir):
    jobs, target = os.path.join(tmp_dir, "jobs"), os.path.join(tmp_dir, "pub")
    assert merge_jobs(spark, jobs, target, PREFERENCES)["jobs_found"] == 0      # none: nothing written
    assert read_published(spark, target, PREFERENCES) is None
    write_job(_rows(spark, [1, 2]), jobs, 0)
    write_job(_rows(spark, [3, 4]), jobs, 1)
    write_job(_rows(spark, [5], drop="chosen"), jobs, 2)                           # a job missing a column
    bad = os.path.join(jobs, "job=3")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "wb") as fh:                   # unreadable: skipped
        fh.write(b"not parquet")
    s = merge_jobs(spark, jobs, target, PREFERENCES)
    assert s["written"] == 5 and s["jobs_found"] == 4 and [os.path.basename(d) for d in s["unreadable"]] == ["job=3"]
    assert {r["job_id"]: (r["loaded"], r["written"]) for r in s["per_job"].collect()} == {0: (2, 2), 1: (2, 2), 2: (1, 1)}
    t = read_published(spark, target, PREFERENCES)
    assert t.count() == 5 and t.filter("question_id = 5").first()["chosen"] is None
    files = _files(target)
    for _ in range(2):                                                             # idempotent reruns write nothing
        s = merge_jobs(spark, jobs, target, PREFERENCES)
        assert s["written"] == 0 and read_published(spark, target, PREFERENCES).count() == 5
        assert {r["written"] for r in s["per_job"].collect()} == {0}
    assert published_jobs(spark, target) == ["0", "1", "2"] and _files(target) == files
    merge_jobs(spark, jobs, target, PREFERENCES, idempotent=False)                 # appending rule doubles
    assert read_published(spark, target, PREFERENCES).count() == 10


def test_a_job_with_one_broken_part_file_is_left_out_whole(spark, tmp_dir):
    jobs, target = os.path.join(tmp_dir, "jobs"), os.path.join(tmp_dir, "pub")
    for j in range(5):
        write_job(_rows(spark, range(10 * j, 10 * j + 8)).repartition(4), jobs, j)
    part = sorted(f for f in os.listdir(os.path.join(jobs, "job=3")) if f.startswith("part-"))[1]
    whole = open(os.path.join(jobs, "job=3", part), "rb").read()
    for f in (part, f".{part}.crc"):
        if os.path.exists(os.path.join(jobs, "job=3", f)):
            os.remove(os.path.join(jobs, "job=3", f))
    with open(os.path.join(jobs, "job=3", part), "wb") as fh:
        fh.write(whole[: len(whole) // 2])
    s = merge_jobs(spark, jobs, target, PREFERENCES)
    assert s["written"] == 32 and [os.path.basename(d) for d in s["unreadable"]] == ["job=3"]
    assert read_published(spark, target, PREFERENCES).filter("job_id = 3").count() == 0
    with open(os.path.join(jobs, "job=3", part), "wb") as fh:                     # repaired: the next run takes it up
        fh.write(whole)
    s = merge_jobs(spark, jobs, target, PREFERENCES)
    assert s["written"] == 8 and s["unreadable"] == []


def test_racing_writers_keep_all_rows(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    target = os.path.join(tmp_dir, "pub")
    rows = [_rows(spark, range(10 * j, 10 * j + 3)).withColumn("job_id", F.lit(j)) for j in range(6)]
    with ThreadPoolExecutor(6) as pool:
        added = list(pool.map(lambda df: publish_rows(df, target, PREFERENCES), rows))
    assert added == [{str(j): 3} for j in range(6)] and read_published(spark, target, PREFERENCES).count() == 18


def test_racing_merges_publish_each_key_once(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    jobs, target = os.path.join(tmp_dir, "jobs"), os.path.join(tmp_dir, "pub")
    for j in range(3):
        write_job(_rows(spark, range(400 * j, 400 * j + 400)), jobs, j)
    for more in (0, 2000):                                                        # a new table, then one with rows
        write_job(_rows(spark, [*range(800, 1200), *range(3000, 3000 + more // 10)]), jobs, 2)
        with ThreadPoolExecutor(3) as pool:
            found = list(pool.map(lambda _: merge_jobs(spark, jobs, target, PREFERENCES)["written"], range(3)))
        t = read_published(spark, target, PREFERENCES)
        assert sum(found) == (1200 if not more else 200)
        assert t.count() == t.select("question_id").distinct().count() == 1200 + more // 10
    assert not os.listdir(os.path.join(target, "_claims"))


def test_racing_merges_on_a_key_without_the_job(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor
    target, key = os.path.join(tmp_dir, "pub"), ("question_id",)
    rows = [_rows(spark, range(50)).withColumn("job_id", F.lit(j)) for j in range(3)]  # the same questions thrice
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda df: publish_rows(df, target, PREFERENCES, key_cols=key), rows))
    assert read_published(spark, target, PREFERENCES).count() == 50
    assert publish_rows(rows[0].unionByName(_rows(spark, [99]).withColumn("job_id", F.lit(0))), target, PREFERENCES, key_cols=key) == {"0": 1}
    assert read_published(spark, target, PREFERENCES).count() == 51


def test_claims_are_exclusive_and_taken_up_by_their_owner(spark, tmp_dir):
    from critloom.sources.published import JobClaimed, claimed, release_claims
    target = os.path.join(tmp_dir, "pub")
    one = _rows(spark, [1]).withColumn("job_id", F.lit(1))
    with claimed(spark, target, ["1"], owner="killed"):
        with pytest.raises(JobClaimed):
            publish_rows(one, target, PREFERENCES, wait=0.3)
        assert read_published(spark, target, PREFERENCES) is None
        publish_rows(_rows(spark, [2]).withColumn("job_id", F.lit(2)), target, PREFERENCES, wait=0.3)  # another job is free
        assert publish_rows(one, target, PREFERENCES, wait=0.3, owner="killed") == {"1": 1}
    with pytest.raises(ZeroDivisionError):
        with claimed(spark, target, ["1", "7"]):
            1 / 0                                                                  # released on failure
    open(os.path.join(target, "_claims", "7"), "w").close()                       # left by a writer that died
    with pytest.raises(JobClaimed):
        publish_rows(_rows(spark, [3]).withColumn("job_id", F.lit(7)), target, PREFERENCES, wait=0.1)
    assert release_claims(spark, target, ["7"]) == ["7"]
    assert publish_rows(_rows(spark, [3]).withColumn("job_id", F.lit(7)), target, PREFERENCES) == {"7": 1}
    assert read_published(spark, target, PREFERENCES).count() == 3


def test_the_plan_of_the_table_does_not_grow_and_a_job_shuffles_once(spark, tmp_dir):
    from critloom.sources.jobs import cluster_by_job
    from critloom.sources.published import _once
    target = os.path.join(tmp_dir, "pub")
    for k in range(4):
        publish_rows(_rows(spark, [k]).withColumn("job_id", F.lit(0)), target, PREFERENCES)
        plan = read_published(spark, target, PREFERENCES)._jdf.queryExecution().executedPlan().toString()
        assert "(1 paths)" in plan and len(_files(target)) == 1                   # one path and one file, whatever the merges
    key = ["question_id", "turn", "job_id"]
    publish_rows(_rows(spark, [9]).withColumn("job_id", F.lit(1)), target, PREFERENCES)
    t = read_published(spark, target, PREFERENCES)
    for rows_per_file in (1, 100):                                                 # salted or not
        plan = _once(cluster_by_job(t, key, rows_per_file=rows_per_file), [*key, "_salt"])._jdf.queryExecution().executedPlan().toString()
        shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert shuffles and not any("question_id" in x for x in shuffles)          # rows are not moved again by key


def test_repeated_keys_in_one_batch_are_published_once(spark, tmp_dir):
    jobs, target = os.path.join(tmp_dir, "jobs"), os.path.join(tmp_dir, "pub")
    write_job(_rows(spark, [1, 1, 2, None, None]), jobs, 0)
    assert merge_jobs(spark, jobs, target, PREFERENCES)["written"] == 3
    assert merge_jobs(spark, jobs, target, PREFERENCES)["written"] == 0           # null keys too


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    from critloom.sources.published import compact
    target = os.path.join(tmp_dir, "pub")
    rows = _rows(spark, range(1000)).withColumn("job_id", (F.col("question_id") % 4).cast("int"))
    publish_rows(rows, target, PREFERENCES, rows_per_file=25)
    assert publish_rows(rows.limit(0), target, PREFERENCES) == {}
    assert 20 <= len(_files(target)) <= 40
    with ThreadPoolExecutor(2) as pool:                                            # two at once: one finds nothing to do
        assert sorted(pool.map(lambda _: compact(spark, target, PREFERENCES), range(2))) == [0, 4]
    assert len(_files(target)) == 4 and read_published(spark, target, PREFERENCES).count() == 1000
    assert compact(spark, target, PREFERENCES) == 0


def test_views_over_the_published_table_split_exactly(spark, tmp_dir):
    from critloom.plans.views import preference_view
    from critloom.sources.tables import read_split
    jobs, target = os.path.join(tmp_dir, "jobs"), os.path.join(tmp_dir, "pub")
    write_job(_rows(spark, range(40)), jobs, 0)
    write_job(_rows(spark, range(40)), jobs, 1)                                    # the same questions in another job
    merge_jobs(spark, jobs, target, PREFERENCES)
    v = preference_view(read_split(spark, target), 0.1, 42)
    assert v.count() == 80 and v.filter("split = 'test'").count() == 8
    v = preference_view(read_split(spark, target), 0.1, 42, key_cols=("question_id",))
    assert v.filter("split = 'test'").count() == 8                                 # repeated keys


def test_incremental_merge(spark, tmp_dir):
    jobs, target, ck = (os.path.join(tmp_dir, d) for d in ("jobs", "out", "ck"))
    write_job(_rows(spark, [1, 2, 3]), jobs, 0)
    write_job(_rows(spark, [4, 5, 6]), jobs, 1)
    incremental_merge(spark, jobs, target, ck, PREFERENCES)
    assert read_merged(spark, target, PREFERENCES).count() == 6
    incremental_merge(spark, jobs, target, ck, PREFERENCES)
    assert read_merged(spark, target, PREFERENCES).count() == 6
    write_job(_rows(spark, [7, 8, 9]), jobs, 2)
    incremental_merge(spark, jobs, target, ck, PREFERENCES)
    out = read_merged(spark, target, PREFERENCES)
    assert out.count() == 9 and sorted(r["job_id"] for r in out.select("job_id").distinct().collect()) == [0, 1, 2]


def test_streaming_eval_history(spark, tmp_dir):
    from critloom.operators.model import StubJudge
    from critloom.plans.evaluate import eval_history
    from critloom.streaming.evaluate import ANSWERS, eval_history_stream

    root, det, met, ck = (os.path.join(tmp_dir, d) for d in ("answers", "details", "metrics", "ck"))
    rows = [(s, i, f"q{i}", ["a", "b", None][i % 3], f"answer {s} {i}", None) for s in (200, 400) for i in range(6)]
    answers = spark.createDataFrame(rows, ANSWERS)
    answers.filter("step = 200 AND ord < 3").write.parquet(os.path.join(root, "commit-1"))
    eval_history_stream(spark, root, StubJudge(), det, met, ck)
    answers.filter("step = 200 AND ord >= 3").write.parquet(os.path.join(root, "commit-2"))  # same step, later
    eval_history_stream(spark, root, StubJudge(), det, met, ck)
    answers.filter("step = 400").write.parquet(os.path.join(root, "commit-3"))
    eval_history_stream(spark, root, StubJudge(), det, met, ck)
    eval_history_stream(spark, root, StubJudge(), det, met, ck)          # nothing new
    got = sorted((r["step"], r["category"] or "", r["metric"], round(r["value"], 9))
                 for r in spark.read.parquet(met).collect())
    want_m, _ = eval_history(answers, StubJudge())
    want = sorted((r["step"], r["category"] or "", r["metric"], round(r["value"], 9)) for r in want_m.collect())
    assert got == want
    assert spark.read.parquet(det).count() == 12


def test_incremental_merge_by_key_survives_regenerated_jobs(spark, tmp_dir):
    from critloom.streaming.merge import incremental_merge_by_key
    jobs, target, ck = (os.path.join(tmp_dir, d) for d in ("jobs", "pub", "ck"))
    write_job(_rows(spark, [1, 2, 3]), jobs, 0)
    incremental_merge_by_key(spark, jobs, target, ck, PREFERENCES)
    write_job(_rows(spark, [1, 2, 3]), jobs, 0)          # job 0 generated again: new files, same keys
    write_job(_rows(spark, [4, 5]), jobs, 1)
    incremental_merge_by_key(spark, jobs, target, ck, PREFERENCES)
    incremental_merge_by_key(spark, jobs, target, ck, PREFERENCES)
    out = read_published(spark, target, PREFERENCES)
    assert out.count() == 5 and out.select("question_id").distinct().count() == 5


def test_interrupted_publish_is_invisible_and_dirs_sort_lexicographically(spark, tmp_dir):
    from critloom.sources.jobs import list_dirs
    target = os.path.join(tmp_dir, "pub")
    publish_rows(_rows(spark, [1, 2]).withColumn("job_id", F.lit(0)), target, PREFERENCES)
    _rows(spark, [9]).withColumn("job_id", F.lit(0)).write.parquet(os.path.join(target, "_tmp-crashed"))
    assert read_published(spark, target, PREFERENCES).count() == 2
    jobs = os.path.join(tmp_dir, "jobs")
    for j in (2, 10, 1):
        write_job(_rows(spark, [j]), jobs, j)
    assert [d.rsplit("/", 1)[1] for d in list_dirs(spark, jobs + "/job=*")] == ["job=1", "job=10", "job=2"]


def test_streams_stop_at_unreadable_files_and_take_them_up_when_repaired(spark, tmp_dir):
    from critloom.streaming.merge import incremental_merge_by_key
    jobs = os.path.join(tmp_dir, "jobs")
    write_job(_rows(spark, [1, 2]), jobs, 0)
    bad = os.path.join(jobs, "job=1")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "wb") as fh:
        fh.write(b"not parquet")
    spare = os.path.join(tmp_dir, "spare")
    write_job(_rows(spark, [3]).coalesce(1), spare, 1)
    good = [f for f in os.listdir(os.path.join(spare, "job=1")) if f.startswith("part-")][0]
    out1, ck1 = os.path.join(tmp_dir, "o1"), os.path.join(tmp_dir, "c1")
    out2, ck2 = os.path.join(tmp_dir, "o2"), os.path.join(tmp_dir, "c2")
    with pytest.raises(StreamingQueryException):
        incremental_merge(spark, jobs, out1, ck1, PREFERENCES)
    with pytest.raises(StreamingQueryException):
        incremental_merge_by_key(spark, jobs, out2, ck2, PREFERENCES)
    with open(os.path.join(spare, "job=1", good), "rb") as src, open(os.path.join(bad, "part-0.parquet"), "wb") as fh:
        fh.write(src.read())
    assert incremental_merge(spark, jobs, out1, ck1, PREFERENCES) >= 1
    assert read_merged(spark, out1, PREFERENCES).count() == 3
    assert incremental_merge_by_key(spark, jobs, out2, ck2, PREFERENCES) >= 1
    assert read_published(spark, out2, PREFERENCES).count() == 3
    assert incremental_merge_by_key(spark, jobs, out2, ck2, PREFERENCES) == 0


def test_published_lookup_prunes_job_partitions(spark, tmp_dir):
    target = os.path.join(tmp_dir, "pub")
    publish_rows(_rows(spark, [1, 2]).withColumn("job_id", F.lit(0)), target, PREFERENCES)
    publish_rows(_rows(spark, [3]).withColumn("job_id", F.lit(1)), target, PREFERENCES)
    t = read_published(spark, target, PREFERENCES)
    assert dict(t.groupBy("job_id").count().collect()) == {0: 2, 1: 1}
    q = t.filter(F.col("job_id").isin([1]))
    assert "PartitionFilters: [isnotnull(job_id" in q._jdf.queryExecution().executedPlan().toString()
    assert [r["question_id"] for r in q.collect()] == [3]


def test_many_broken_jobs_take_one_pass(spark, tmp_dir, monkeypatch):
    from critloom.sources import jobs as J
    root = os.path.join(tmp_dir, "jobs")
    rows = _rows(spark, range(600)).withColumn("job_id", (F.col("question_id") % 60).cast("int"))
    J.write_jobs(rows, root)
    dirs = J.job_dirs(spark, root)
    broken = []
    for k, d in enumerate(dirs):
        part = next(f for f in os.listdir(d.replace("file:", "")) if f.endswith(".parquet"))
        path = os.path.join(d.replace("file:", ""), part)
        whole = open(path, "rb").read()
        if k % 5 == 0:                                                             # cut off, other bytes, a wrong footer
            if os.path.exists(os.path.join(os.path.dirname(path), f".{part}.crc")):
                os.remove(os.path.join(os.path.dirname(path), f".{part}.crc"))
            bad = [whole[: len(whole) // 2], b"not parquet", whole[:-8] + b"\xff\xff\xff\x7fPAR1"][k // 5 % 3]
            with open(path, "wb") as fh:
                fh.write(bad)
            broken.append(d)
    passes = []
    real = J.check_files
    monkeypatch.setattr(J, "check_files", lambda *a: passes.append(1) or real(*a))
    good, bad = J.readable_jobs(spark, dirs, PREFERENCES)
    assert sorted(bad) == sorted(broken) and len(good) == 48 and passes == [1]
    assert J.read_jobs(spark, good, PREFERENCES).count() == 480
    other = os.path.join(tmp_dir, "jobs", "job=900")                               # another type of a declared column
    spark.createDataFrame([("x", 1)], "question_id string, turn int").write.parquet(other)
    wide = os.path.join(tmp_dir, "jobs", "job=901")                                # a narrower number is fine
    spark.createDataFrame([(1, 1)], "question_id int, turn int").write.parquet(wide)
    assert J.readable_jobs(spark, [other, wide], PREFERENCES) == ([wide], [other])
    assert J.read_jobs(spark, [wide], PREFERENCES).first().question_id == 1
    monkeypatch.setattr(J, "MAX_CHECKED_BYTES", 10)                               # large files are tried by a scan
    assert sorted(J.readable_jobs(spark, dirs, PREFERENCES)[1]) == sorted(broken)


def test_files_follow_rows_not_tasks(spark, tmp_dir):
    from critloom.sources.jobs import write_jobs
    root = os.path.join(tmp_dir, "jobs")
    n = 6000                                                                       # a third of all rows in job 0
    rows = _rows(spark, range(n)).repartition(40).withColumn("job_id", F.when(F.col("question_id") % 3 == 0, 0).otherwise(
        1 + F.col("question_id") % 300).cast("int"))
    write_jobs(rows, root, rows_per_file=100)
    per_job = dict(rows.groupBy("job_id").count().collect())
    files = {j: len([f for f in os.listdir(os.path.join(root, f"job={j}")) if f.endswith(".parquet")]) for j in per_job}
    assert 12 <= files[0] <= 20 and all(v == 1 for j, v in files.items() if j)     # not 40 of each of 201 jobs
    assert spark.read.parquet(root).count() == n and dict(spark.read.parquet(root).groupBy("job_id").count().collect()) == per_job
    largest = max(r["count"] for r in spark.read.parquet(root).groupBy(F.input_file_name()).count().collect())
    assert largest < 400                                                           # hashing puts a few salts together


def test_few_new_keys_skip_most_row_groups(spark, tmp_dir):
    import pyarrow.parquet as pq

    from critloom.sources.published import among
    target = os.path.join(tmp_dir, "pub")
    n = 60_000
    rows = spark.range(n).selectExpr("id * 7 AS question_id", "0 AS turn", "repeat(md5(cast(id AS string)), 20) AS question")
    for f in PREFERENCES.fields:
        if f.name not in rows.columns and f.name != "job_id":
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(1 << 20))                                  # small row groups, as if files were large
    try:
        publish_rows(rows.withColumn("job_id", F.lit(0)), target, PREFERENCES)
    finally:
        conf.unset("parquet.block.size")
    groups = sum(pq.ParquetFile(f).num_row_groups for f in _files(target))
    assert groups >= 8

    def rows_scanned(df):
        df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()

    table = read_published(spark, target, PREFERENCES).select("question_id", "turn", "job_id")
    new = spark.createDataFrame([(7 * 30_000,), (7 * 30_000 + 1,)], "question_id long")
    found = among(table, new, "question_id")
    assert "PushedFilters: [In(question_id" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 1 and rows_scanned(among(table, new, "question_id")) <= 2 * n / groups + 1
    inside = spark.createDataFrame([(7 * k + 3,) for k in range(0, n, 6000)], "question_id long")  # in range, but never there
    assert rows_scanned(among(table, inside, "question_id")) < n / 2               # Bloom filters
    assert among(table, new, "question_id", most=1).count() == n                  # too many to list: the join decides
    more = rows.limit(2).withColumn("question_id", F.col("question_id") + 1).withColumn("job_id", F.lit(0))
    assert publish_rows(more, target, PREFERENCES) == {"0": 2} and publish_rows(more, target, PREFERENCES) == {}
    nulls = rows.limit(1).withColumn("question_id", F.lit(None).cast("long")).withColumn("job_id", F.lit(0))
    assert publish_rows(nulls, target, PREFERENCES) == {"0": 1} and publish_rows(nulls, target, PREFERENCES) == {}


def test_jobs_of_long_texts_are_spread_by_bytes(spark, tmp_dir, monkeypatch):
    from critloom.sources import jobs
    from critloom.sources.published import compact
    monkeypatch.setattr(jobs, "BYTES_PER_FILE", 1 << 20)
    long = _rows(spark, list(range(40))).withColumn("job_id", (F.col("question_id") * 0).cast("int")) \
        .withColumn("chosen", F.repeat(F.lit("x"), 1 << 18))  # 10 MB
    target = os.path.join(tmp_dir, "pub")
    assert publish_rows(long, target, PREFERENCES) == {"0": 40}
    assert 4 <= len(_files(target)) <= 11 and compact(spark, target, PREFERENCES) == 0
    jobs.write_jobs(long, os.path.join(tmp_dir, "jobs"))
    assert 4 <= len(_files(os.path.join(tmp_dir, "jobs"))) <= 11
    assert publish_rows(long, target, PREFERENCES) == {} and read_published(spark, target, PREFERENCES).count() == 40
