"""End to end on the driver tables: generate two job slices, merge them, cut the training
views, and judge the chosen answers. Run: ``python examples/walkthrough.py [sf_dir]``."""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from critloom.operators.aggregate import eval_metrics, metrics_record  # noqa: E402
from critloom.operators.model import StubJudge, StubModel  # noqa: E402
from critloom.operators.ranking import assign_jobs  # noqa: E402
from critloom.plans.evaluate import judge  # noqa: E402
from critloom.plans.generate import GenerationConfig, generation_job  # noqa: E402
from critloom.plans.merge import merge_jobs  # noqa: E402
from critloom.plans.views import preference_view, sft_view, train_test  # noqa: E402
from critloom.schemas import PREFERENCES  # noqa: E402
from critloom.session import local_session, scratch_path  # noqa: E402
from critloom.sources.published import read_published  # noqa: E402
from critloom.sources.tables import questions, questions_from_conversations, read_table  # noqa: E402


def run(spark: SparkSession, sf_dir: str) -> dict:
    qs = questions(questions_from_conversations(read_table(spark, sf_dir, "conversations")))
    n = qs.count()
    jobs_root, table = scratch_path(spark, "walk-jobs"), scratch_path(spark, "walk-table")
    gen = generation_job(assign_jobs(qs, "question_id", max(1, -(-n // 2))), jobs_root, StubModel(),
                         GenerationConfig(num_turns=2, num_revisions=1, seed=3))
    first = merge_jobs(spark, jobs_root, table, PREFERENCES)
    again = merge_jobs(spark, jobs_root, table, PREFERENCES)           # idempotent: nothing new
    prefs = read_published(spark, table, PREFERENCES)
    train, test = train_test(preference_view(prefs, test_size=0.1, seed=42))
    sft = sft_view(prefs)
    # Judge the chosen answers of the test part by turn: the turn plays the role of the step.
    answers = test.select(F.col("turn").cast("bigint").alias("step"), F.col("question_id").alias("ord"),
                          "prompt", "category", F.col("chosen").alias("response"))
    record = metrics_record(eval_metrics(judge(answers, StubJudge()))).collect()
    return {"generated": gen["datapoints"], "published": first["written"], "republished": again["written"],
            "train": train.count(), "test": test.count(), "sft_rows": sft.count(),
            "mean_score_by_turn": {int(r["step"]): round(r["metrics"]["teaching_quality_score"], 3) for r in record}}


if __name__ == "__main__":
    session = local_session()
    print(json.dumps(run(session, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")))
