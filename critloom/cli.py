"""Command line for the two batch jobs: generate one job slice, merge job outputs.

    spark-submit run_job.py generate --questions DATA --out JOBS --job-id 0 \\
        --rows-per-job 2500 --offset 5000 --backend stub
    spark-submit run_job.py merge --jobs JOBS --target TABLE

Both print a one-line JSON summary (A4 / A5). The session comes from ``spark-submit`` (or
a local one when run directly); the stage folder is read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.model import Backend, StubModel
from .operators.ranking import slice_rows
from .plans.generate import GenerationConfig, generation_job
from .plans.merge import merge_jobs
from .schemas import PREFERENCES
from .session import JOB_CONF
from .sources.tables import questions, read_split


def make_backend(spec: str) -> Backend:
    """``stub``, or ``<module>:<name>`` of a callable that makes a backend (given to the job with ``--py-files``)."""
    if spec == "stub":
        return StubModel()
    module, _, name = spec.partition(":")
    if not module or not name:
        raise ValueError(f"unknown backend {spec!r}")
    return getattr(importlib.import_module(module), name)()


def _generate(spark: SparkSession, a: argparse.Namespace) -> dict:
    src = questions(read_split(spark, a.questions, a.split), id_col=a.id_col, text_col=a.text_col,
                    label_col=a.label_col)
    start = a.offset + a.job_id * a.rows_per_job
    part = slice_rows(src, "question_id", start, a.rows_per_job).withColumn("job_id", F.lit(a.job_id).cast("int"))
    cfg = GenerationConfig(num_turns=a.turns, num_revisions=a.revisions, seed=a.seed,
                           model_partitions=a.model_partitions, stage_dir=a.stage_dir)
    summary = generation_job(part, a.out, make_backend(a.backend), cfg)
    return {"job_id": a.job_id, "rows_from": start, **summary}


def _merge(spark: SparkSession, a: argparse.Namespace) -> dict:
    s = merge_jobs(spark, a.jobs, a.target, PREFERENCES, idempotent=not a.append)
    s.pop("per_job")  # a table, not a figure
    return s


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="critloom")
    sub = p.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate", help="generate preference rows for one job slice")
    g.add_argument("--questions", required=True)
    g.add_argument("--split", default="train")
    g.add_argument("--id-col", default="question_id")
    g.add_argument("--text-col", default="text")
    g.add_argument("--label-col", default="label_text")
    g.add_argument("--out", required=True)
    g.add_argument("--job-id", type=int, default=0)
    g.add_argument("--rows-per-job", type=int, default=2500)
    g.add_argument("--offset", type=int, default=0)
    g.add_argument("--turns", type=int, default=1)
    g.add_argument("--revisions", type=int, default=1)
    g.add_argument("--seed", type=int, default=0)
    g.add_argument("--backend", default="stub")
    g.add_argument("--model-partitions", type=int, default=None)
    g.add_argument("--stage-dir", default=None, help="folder of stored model stages; a run started again resumes there")
    m = sub.add_parser("merge", help="publish all job outputs into the table")
    m.add_argument("--jobs", required=True)
    m.add_argument("--target", required=True)
    m.add_argument("--append", action="store_true", help="append everything (re-runs duplicate)")
    a = p.parse_args(argv)
    if spark is None:
        builder = SparkSession.builder.appName(f"critloom-{a.cmd}").config("spark.ui.enabled", "false")
        for k, v in JOB_CONF.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    out = _generate(spark, a) if a.cmd == "generate" else _merge(spark, a)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
