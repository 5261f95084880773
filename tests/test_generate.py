"""C1/C2 (T6): revision rounds, turns, array lengths, history size, chained rounds."""

import pytest
from pyspark.sql import functions as F

from critloom.operators.model import StubModel
from critloom.plans.generate import GenerationConfig, generate_preferences


def _questions(spark):
    return spark.createDataFrame([(1, "What is a prime?", "math"), (2, "Why is the sky blue?", None)],
                                 "question_id long, text string, category string")


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_rounds(spark, rounds):
    out = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_revisions=rounds)).collect()
    assert len(out) == 2
    for r in out:
        for c in ("critique_requests", "critiques", "revision_requests", "revisions"):
            assert len(r[c]) == rounds
        if rounds == 0:
            assert r["chosen"] is None
        else:
            assert r["chosen"] == r["revisions"][-1]
        assert r["rejected"] == r["initial_response"]
        assert r["errors"] == []
    cats = {r["question_id"]: r["category"] for r in out}
    assert cats == {1: "math", 2: None}


@pytest.mark.parametrize("turns", [1, 3])
def test_turns_and_history(spark, turns):
    out = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=turns, num_revisions=1))
    rows = out.collect()
    assert len(rows) == 2 * turns
    for r in rows:
        assert len(r["messages"]) == 2 * (r["turn"] + 1)
        assert r["messages"][-1]["content"] == r["chosen"]
        assert r["messages"][-2]["content"] == r["question"]
    first = [r for r in rows if r["turn"] == 0]
    assert sorted(r["question"] for r in first) == ["What is a prime?", "Why is the sky blue?"]


def test_second_round_starts_from_initial_answer(spark):
    """Q1: without ``chain`` both rounds critique the first answer; with it, the rewrite."""
    base = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_revisions=2)).collect()
    chained = generate_preferences(_questions(spark), StubModel(),
                                   GenerationConfig(num_revisions=2, chain=True)).collect()
    b = {r["question_id"]: r for r in base}
    c = {r["question_id"]: r for r in chained}
    for k in b:
        assert b[k]["critiques"][0] == c[k]["critiques"][0]
        assert b[k]["critiques"][1] != c[k]["critiques"][1]


def test_checkpointed_stages_equal_lazy(spark):
    lazy = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=2))
    ck = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=2, checkpoint_stages=True))
    plan = ck._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 0  # every model stage already materialized
    cols = ["question_id", "turn", "chosen", "rejected"]
    assert sorted(lazy.select(cols).collect()) == sorted(ck.select(cols).collect())


def test_model_stage_count(spark):
    out = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=3, num_revisions=2))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # per turn: teacher + 2 × (critique + rewrite); student questions from turn 1 on
    assert plan.count("ArrowEvalPython") == 3 * 5 + 2


def test_filter_before_model_is_pushed(spark):
    q = _questions(spark).filter(F.col("question_id") == 1)
    assert generate_preferences(q, StubModel()).count() == 1


class _SampledStub(StubModel):
    deterministic = False  # planned like a real model: spread rows, materialize every stage

    def cache_key(self):
        return "sampled-stub"


def test_real_model_path_equals_fused_path(spark):
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cfg = GenerationConfig(num_turns=2, num_revisions=1)
    cols = ["question_id", "turn", "chosen", "rejected", "question"]
    real = generate_preferences(_questions(spark), _SampledStub(), cfg)
    assert real._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 0
    fused = generate_preferences(_questions(spark), StubModel(), cfg)
    assert sorted(real.select(cols).collect()) == sorted(fused.select(cols).collect())


def test_map_stages_equal_column_stages(spark):
    cfg_map = GenerationConfig(num_turns=2, num_revisions=2, map_stages=True)
    cols = ["question_id", "turn", "chosen", "rejected", "question", "critiques"]
    mapped = generate_preferences(_questions(spark), StubModel(), cfg_map)
    plan = mapped._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    col = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=2, num_revisions=2))
    assert sorted(mapped.select(cols).collect()) == sorted(col.select(cols).collect())


def test_empty_student_reply_becomes_default_question(spark):
    import sys

    from pyspark import cloudpickle

    from critloom.functions.texts import DEFAULT_STUDENT_RESPONSE
    from critloom.operators.model import FunctionBackend
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    silent = FunctionBackend(lambda batch: ["" for _ in batch], batch_size=8, deterministic=True)
    out = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=2),
                               student_backend=silent).collect()
    later = [r for r in out if r["turn"] == 1]
    assert len(later) == 2 and all(r["question"] == DEFAULT_STUDENT_RESPONSE for r in later)
    assert all(r["messages"][2]["content"] == DEFAULT_STUDENT_RESPONSE for r in later)


class _CountingModel(StubModel):
    """Counts calls in a folder, as workers share no memory; fails while a file named ``down`` is there."""

    deterministic = False

    def __init__(self, folder, fail_after=None):
        self.folder, self.fail_after = folder, fail_after

    def cache_key(self):
        return "counting"

    def generate_batch(self, messages_list):
        import os
        import uuid
        if self.fail_after is not None and len(os.listdir(self.folder)) >= self.fail_after:
            os._exit(1)  # the worker dies, and with it the job
        for _ in messages_list:
            open(os.path.join(self.folder, uuid.uuid4().hex), "w").close()
        return super().generate_batch(messages_list)


def test_a_restarted_run_calls_no_finished_stage_again(spark, tmp_dir):
    import os
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    calls, stages = os.path.join(tmp_dir, "calls"), os.path.join(tmp_dir, "stages")
    os.makedirs(calls)
    cfg = GenerationConfig(num_turns=2, num_revisions=1, stage_dir=stages, rows_per_task=1)
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark reports for dead workers
        generate_preferences(_questions(spark), _CountingModel(calls, fail_after=5), cfg).collect()
    done = [d for d in os.listdir(stages) if os.path.exists(os.path.join(stages, d, "_SUCCESS"))]
    before = len(os.listdir(calls))
    assert 1 <= len(done) < 7
    rows = generate_preferences(_questions(spark), _CountingModel(calls), cfg).collect()
    assert len(rows) == 4
    assert len(os.listdir(calls)) == before + 2 * (7 - len(done))  # 7 stages, two questions each
    again = generate_preferences(_questions(spark), _CountingModel(calls), cfg).collect()
    assert len(os.listdir(calls)) == before + 2 * (7 - len(done)) and sorted(again) == sorted(rows)
    lazy = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=2, num_revisions=1)).collect()
    assert sorted((r["question_id"], r["turn"], r["chosen"]) for r in rows) == sorted((r["question_id"], r["turn"], r["chosen"]) for r in lazy)
    stored = spark.read.parquet(os.path.join(stages, "turn1-answer"))
    assert stored.columns == ["question_id", "_init"]  # a narrow table: key, text and error


def test_every_stored_stage_joins_at_most_two_tables(spark, tmp_dir, monkeypatch):
    import os
    import sys

    from pyspark import cloudpickle

    from critloom.plans import generate as G
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    joins, real = {}, G._write

    def write(df, path):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins[path] = (plan.count("Join"), plan.count("Relation "))
        real(df, path)

    monkeypatch.setattr(G, "_write", write)
    cfg = GenerationConfig(num_turns=3, num_revisions=2, stage_dir=os.path.join(tmp_dir, "stages"), rows_per_task=1)
    out = generate_preferences(_questions(spark), _SampledStub(), cfg)
    assert len(joins) == 3 * 5 + 2 + 3 * 3                                   # model stages and settled states
    assert max(j for j, _ in joins.values()) <= 2 and max(r for _, r in joins.values()) <= 3
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 2
    cols = ["question_id", "turn", "question", "chosen", "rejected"]
    lazy = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=3, num_revisions=2))
    assert sorted(out.select(cols).collect()) == sorted(lazy.select(cols).collect())


def test_a_job_clusters_its_files_and_leaves_no_stage_tables(spark, tmp_dir):
    import os
    import sys

    from pyspark import cloudpickle

    from critloom.plans.generate import generation_job
    from critloom.session import checkpoint_dir
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    qs = spark.range(60).selectExpr("id AS question_id", "concat('q', id) AS text", "'c' AS category",
                                    "cast(CASE WHEN id < 30 THEN 0 ELSE id % 5 + 1 END AS int) AS job_id").repartition(12)
    base = checkpoint_dir(spark).replace("file:", "")
    before = {d for d in os.listdir(base) if d.startswith("model-stages")}
    s = generation_job(qs, os.path.join(tmp_dir, "jobs"), _SampledStub(), GenerationConfig(num_turns=2, rows_per_task=8), rows_per_file=20)
    assert s["datapoints"] == 120 and s["errors"] == 0
    files = {j: [f for f in os.listdir(os.path.join(tmp_dir, "jobs", f"job={j}")) if f.endswith(".parquet")] for j in range(6)}
    assert 2 <= len(files[0]) <= 3 and all(len(files[j]) == 1 for j in range(1, 6))
    assert {d for d in os.listdir(base) if d.startswith("model-stages")} == before


def test_fused_stages_of_one_task_are_few(spark):
    out = generate_preferences(_questions(spark), StubModel(), GenerationConfig(num_turns=3, num_revisions=2))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert max(part.count("ArrowEvalPython") for part in plan.split("Exchange hashpartitioning(xxhash64(")) <= 2  # a worker each
    twins = _questions(spark).unionByName(_questions(spark)).unionByName(_questions(spark).withColumn("question_id", F.lit(None).cast("bigint")))
    got = generate_preferences(twins, StubModel(), GenerationConfig(num_turns=2)).groupBy("question_id", "turn").count().collect()
    assert sorted(r["count"] for r in got) == [2] * 6  # repeated and null ids stay rows of their own
