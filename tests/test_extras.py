"""Remote backend, detail records, literal tables, first-n examples, job summary."""

import tempfile
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from critloom.functions.texts import DEFAULT_KIT
from critloom.operators.model import StubEchoModel, StubJudge, StubModel
from critloom.operators.sampling import principles, principles_table
from critloom.plans.evaluate import details_record, judged_eval
from critloom.plans.generate import GenerationConfig, generation_job
from critloom.sources.jobs import list_dirs
from critloom.sources.tables import default_eval_examples

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_details_record_and_first_n(spark):
    ex = default_eval_examples(spark)
    metrics, details = judged_eval(ex, StubEchoModel(), StubJudge(), num_examples=3, step=200)
    rec = details_record(details).first()
    assert rec["step"] == 200 and len(rec["prompts"]) == 3
    assert rec["prompts"] == [p for p, _ in DEFAULT_KIT.examples[:3]]
    names = {r["metric"] for r in metrics.collect()}
    assert {"teaching_quality_score", *(f"teaching_quality_{c}" for _, c in DEFAULT_KIT.examples[:3])} <= names
    _, all_details = judged_eval(ex, StubEchoModel(), StubJudge(), num_examples=0)
    assert all_details.count() == len(DEFAULT_KIT.examples)  # 0 means all


def test_literal_tables(spark):
    t = principles_table(spark)
    assert t.filter("stage = 'sl'").count() == len(DEFAULT_KIT.principles) == len(principles("other"))
    assert t.filter("stage = 'rl'").count() == len(DEFAULT_KIT.preferences)
    assert principles("rl")[0][0] == principles("rl")[0][1]


def test_generation_job_summary_and_dirs(spark, tmp_dir):
    q = spark.createDataFrame([(i, f"q{i}", "c", i % 2) for i in range(6)],
                              "question_id long, text string, category string, job_id int")
    out = os.path.join(tmp_dir, "gen")
    s = generation_job(q, out, StubModel(), GenerationConfig(num_turns=2))
    assert s["datapoints"] == 12 and s["conversations"] == 6 and s["rounds_per_conversation"] == 2
    dirs = list_dirs(spark, out + "/job=*")
    assert [d.rsplit("/", 1)[1] for d in dirs] == ["job=0", "job=1"]
    assert spark.read.parquet(dirs[0]).select("job_id").distinct().first()[0] == 0
    # re-running job 1 alone replaces its directory and leaves job 0 untouched
    generation_job(q.filter("job_id = 1 AND question_id = 1"), out, StubModel(), GenerationConfig())
    assert spark.read.parquet(dirs[0]).count() == 6 and spark.read.parquet(dirs[1]).count() == 1


def test_step_tables_are_idempotent(spark, tmp_dir):
    from critloom.sources.jobs import append_metrics
    path = os.path.join(tmp_dir, "m")
    a = spark.createDataFrame([(200, None, "x", 1.0), (400, None, "x", 2.0)], "step long, category string, metric string, value double")
    append_metrics(a, path)
    append_metrics(a.filter("step = 400"), path)            # re-run of step 400 replaces it
    append_metrics(a.filter("step = 200").selectExpr("600 AS step", "category", "metric", "value"), path)
    got = sorted((r["step"], r["value"]) for r in spark.read.parquet(path).collect())
    assert got == [(200, 1.0), (400, 2.0), (600, 1.0)]


def test_recommended_conf():
    from critloom.session import recommended_conf
    c = recommended_conf(100 << 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) >= 400_000 and int(c["spark.sql.files.maxPartitionBytes"]) == 256 << 20


def _judge_or_fail(batch):
    out = []
    for msgs in batch:
        if "explode" in msgs[-1]["content"]:
            raise RuntimeError("judge down")
        out.append("fine. SCORE: 8")
    return out


def test_failed_judge_calls_do_not_count(spark):
    from critloom.operators.model import FunctionBackend
    from critloom.plans.evaluate import eval_history
    rows = [(200, 1, "p1", "math", "ok"), (200, 2, "p2", "math", "explode"), (400, 1, "p1", "math", "ok")]
    answers = spark.createDataFrame(rows, "step long, ord long, prompt string, category string, response string")
    metrics, details = eval_history(answers, FunctionBackend(_judge_or_fail, batch_size=4))
    d = {(r["step"], r["ord"]): (r["score"], r["judge_error"]) for r in details.collect()}
    assert d[(200, 1)] == (8.0, None) and d[(200, 2)][0] is None and d[(200, 2)][1].startswith("RuntimeError")
    m = {(r["step"], r["metric"]): r["value"] for r in metrics.collect()}
    assert m[(200, "teaching_quality_score")] == 8.0 and m[(200, "teaching_quality_math")] == 8.0


def test_reward_accuracy(spark):
    from critloom.operators.preference import reward_accuracy
    df = spark.createDataFrame([("en", 0.5, True), ("en", -0.1, False), ("fr", 0.2, True)],
                               "lang string, margin double, correct boolean")
    r = {x["lang"]: x for x in reward_accuracy(df, ["lang"]).collect()}
    assert r["en"]["accuracy"] == 0.5 and r["en"]["n_pairs"] == 2 and r["fr"]["mean_margin"] == 0.2


def test_token_count(spark):
    from critloom.operators.model import CallableCounter, token_count
    df = spark.createDataFrame([(" a b  c ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(token_count(F.col("t"))).collect()] == [3, 0, 0]
    chars = CallableCounter(lambda s: list(s))
    assert [r[0] for r in df.select(token_count(F.col("t"), chars)).collect()] == [8, 0, 0]


def test_checkpoint_dir_only_set_when_unset():
    from critloom.session import checkpoint_dir

    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

    class SC:
        def __init__(self, current, conf, master="local[4]"):
            self.current, self.conf, self.set_to, self.master = current, Conf(conf), None, master

        def getCheckpointDir(self):
            return self.current

        def getConf(self):
            return self.conf

        def setCheckpointDir(self, d):
            self.set_to = self.current = d

    class S:
        def __init__(self, sc):
            self.sparkContext = sc

    sc = SC("hdfs://shared/ckpt/abc", {})
    assert checkpoint_dir(S(sc)) == "hdfs://shared/ckpt/abc" and sc.set_to is None   # cluster: only read
    sc = SC(None, {"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert checkpoint_dir(S(sc)) == "hdfs://shared/ckpt"                             # named, not yet applied
    sc = SC(None, {})
    assert checkpoint_dir(S(sc)).startswith(tempfile.gettempdir())                  # unset: local mode only
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"):
        sc = SC(None, {}, master)
        with pytest.raises(ValueError):                                             # a cluster must name a shared folder
            checkpoint_dir(S(sc))
        assert sc.set_to is None


def test_read_split_prunes_partition(spark, tmp_dir):
    from critloom.sources.tables import read_split
    path = os.path.join(tmp_dir, "ds")
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "test"), (3, "c", "train")], "id long, text string, split string")
    df.write.partitionBy("split").parquet(path)
    tr = read_split(spark, path)
    assert sorted(r["id"] for r in tr.collect()) == [1, 3] and "split" not in tr.columns
    assert "PartitionFilters: [isnotnull(split" in tr._jdf.queryExecution().executedPlan().toString()
    single = os.path.join(tmp_dir, "single")
    df.drop("split").write.parquet(single)
    assert read_split(spark, single).count() == 3


def test_cli_generate_and_merge(spark, tmp_dir):
    from critloom.cli import main
    from critloom.sources.published import read_published
    src = os.path.join(tmp_dir, "q")
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr(
        "doc_id AS question_id", "text", "lang AS label_text").write.parquet(src)
    jobs, target = os.path.join(tmp_dir, "jobs"), os.path.join(tmp_dir, "table")
    s0 = main(["generate", "--questions", src, "--out", jobs, "--job-id", "0", "--rows-per-job", "50",
               "--offset", "100"], spark)
    s1 = main(["generate", "--questions", src, "--out", jobs, "--job-id", "1", "--rows-per-job", "50",
               "--offset", "100"], spark)
    assert s0["datapoints"] == 50 and s1["datapoints"] == 50 and s1["rows_from"] == 150
    ids = sorted(r[0] for r in spark.read.parquet(jobs).select("question_id").collect())
    want = sorted(r[0] for r in spark.read.parquet(src).orderBy("question_id").collect()[100:200])
    assert ids == want
    m = main(["merge", "--jobs", jobs, "--target", target], spark)
    from critloom.schemas import PREFERENCES
    assert m["written"] == 100 and read_published(spark, target, PREFERENCES).count() == 100


def test_empty_eval_set_has_no_metrics(spark):
    empty = default_eval_examples(spark).limit(0)
    metrics, details = judged_eval(empty, StubEchoModel(), StubJudge(), step=1)
    assert metrics.count() == 0 and details.count() == 0


def made_backend():
    return StubModel()


def test_cli_backend_specs():
    from critloom.cli import make_backend
    assert isinstance(make_backend("stub"), StubModel)
    assert isinstance(make_backend(f"{__name__}:made_backend"), StubModel)
    with pytest.raises(ValueError):
        make_backend("carrier-pigeon")


def test_backend_keys_are_kept_by_pickling_and_differ_by_object():
    from critloom.operators.model import FunctionBackend
    a, b = FunctionBackend(len, batch_size=1), FunctionBackend(len, batch_size=2)
    assert a.cache_key() == a.cache_key() != b.cache_key()
    assert cloudpickle.loads(cloudpickle.dumps(a)).cache_key() == a.cache_key()


def _sampled(batch):
    import random
    return [f"I say {random.randint(1, 10)}" for _ in batch]


def _sampled_judge(batch):
    import random
    return [f"SCORE: {random.randint(1, 10)}" for _ in batch]


def _down(batch):
    raise RuntimeError("model down")


def test_metrics_and_details_of_a_sampling_model_agree(spark):
    from critloom.operators.model import FunctionBackend
    from critloom.plans.evaluate import eval_history
    ex = spark.range(60).selectExpr("id AS ord", "concat('p', id) AS prompt", "CAST(null AS string) AS reference_answer", "'c' AS category")
    metrics, details = judged_eval(ex, FunctionBackend(_sampled), FunctionBackend(_sampled_judge), step=1)
    for _ in range(2):  # read again: still the same run
        mean = details.agg(F.avg("score")).first()[0]
        got = {r["metric"]: r["value"] for r in metrics.collect()}
        assert got["teaching_quality_score"] == mean == got["teaching_quality_c"]
    answers = details.select("step", "ord", "prompt", "category", "response")
    metrics, rows = eval_history(answers, FunctionBackend(_sampled_judge))
    assert metrics.filter("metric = 'teaching_quality_score'").first()["value"] == rows.agg(F.avg("score")).first()[0]


def test_failed_answers_are_marked_and_not_graded(spark):
    from critloom.operators.model import FunctionBackend
    ex = default_eval_examples(spark)
    metrics, details = judged_eval(ex, FunctionBackend(_down), StubJudge(), step=1)
    rows = details.collect()
    assert len(rows) == len(DEFAULT_KIT.examples)
    assert all(r["score"] is None and r["answer_error"].startswith("RuntimeError") and r["response"] == "" for r in rows)
    assert all(r["value"] is None for r in metrics.collect())


def test_later_examples_of_a_step_are_added(spark, tmp_dir):
    from critloom.plans.evaluate import eval_history
    det, met = os.path.join(tmp_dir, "d"), os.path.join(tmp_dir, "m")
    schema = "step long, ord long, prompt string, category string, response string"
    rows = [(s, i, f"p{i}", "c", f"r{s}{i}") for s in (200, 400) for i in range(1, 5)]
    first = spark.createDataFrame([r for r in rows if r[1] < 4], schema)
    eval_history(first, StubJudge(), det, met)
    stamp = {f: os.path.getmtime(os.path.join(det, "step=400", f)) for f in os.listdir(os.path.join(det, "step=400"))}
    m, d = eval_history(spark.createDataFrame([(200, 4, "p4", "c", "r2004")], schema), StubJudge(), det, met)
    assert sorted((r["step"], r["ord"]) for r in d.collect()) == [(200, i) for i in range(1, 5)]
    assert {r["step"] for r in m.collect()} == {200}                     # only the touched step
    stored = spark.read.parquet(det)
    assert sorted((r["step"], r["ord"]) for r in stored.collect()) == [(200, i) for i in range(1, 5)] + [(400, i) for i in range(1, 4)]
    assert stamp == {f: os.path.getmtime(os.path.join(det, "step=400", f)) for f in os.listdir(os.path.join(det, "step=400"))}
    eval_history(first.filter("step = 200 AND ord = 1"), StubJudge(), det, met)  # judged again: replaced
    assert spark.read.parquet(det).count() == 7


def test_reply_pairs_of_repeated_turns_and_null_keys(spark):
    from critloom.operators.history import last_reply_pair, reply_pairs, unanswered
    rows = [(1, 0, "user", "q"), (1, 3, "assistant", "a"), (1, 5, "user", "q2"), (1, 5, "user", "q2"), (1, 9, "assistant", "a2"),
            (None, 0, "user", None), (None, 1, "assistant", "n"), (2, 0, "assistant", "alone"), (3, 0, "user", "q"), (4, 0, "user", "u"),
            (4, 1, "assistant", "x"), (4, 1, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = sorted(tuple(r) for r in reply_pairs(df).fillna(-1, ["conv_id"]).collect())
    assert got == [(-1, 1, "", "n"), (1, 3, "q", "a"), (1, 9, "q2", "a2"), (4, 1, "u", "x")]
    last = sorted(tuple(r) for r in last_reply_pair(df).fillna(-1, ["conv_id"]).collect())
    assert last == [(-1, 1, "", "n"), (1, 9, "q2", "a2"), (4, 1, "u", "x")]
    assert sorted(r.conv_id for r in unanswered(df).collect()) == [2, 3]
