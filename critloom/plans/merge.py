"""Merge job outputs into the published table (C4 = S3 → E1 → S5 → E2 → K2, A5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from ..sources.jobs import READ_ERRORS, _fs, job_dirs, read_jobs, readable_jobs
from ..sources.published import DEFAULT_KEY, WAIT_SECONDS, publish_rows


def merge_jobs(spark: SparkSession, jobs_root: str, target: str, schema: T.StructType,
               key_cols: Sequence[str] = DEFAULT_KEY, idempotent: bool = True, owner: str | None = None,
               wait: float = WAIT_SECONDS) -> dict:
    """Add every readable job output under ``jobs_root`` to the table at ``target``.

    ``idempotent`` (default) adds only rows whose key is not published yet, and one row per
    key, so re-running the merge adds nothing; ``idempotent=False`` appends everything (a re-run
    doubles rows, as merging without keys does). A job with an unreadable file is left out whole and
    listed. Merges may run at the same time: each owns the jobs that it adds to while it does.

    Returns the merge summary (A5): ``jobs_found``, ``unreadable`` (directories), ``written``
    (rows) and ``per_job``, a DataFrame ``(job_id, loaded, written)``.
    """
    dirs = job_dirs(spark, jobs_root)
    unreadable: list[str] = []
    found = len(dirs)

    def publish() -> dict[str, int]:
        return publish_rows(read_jobs(spark, dirs, schema), target, schema, None, key_cols, idempotent, owner, wait) if dirs else {}

    try:
        added = publish()
    except READ_ERRORS:
        dirs, unreadable = readable_jobs(spark, dirs, schema)
        if not unreadable:
            raise
        added = publish()
    if not dirs:
        per_job = spark.createDataFrame([], "job_id int, loaded bigint, written bigint")
    else:
        loaded = read_jobs(spark, dirs, schema).groupBy("job_id").agg(F.count(F.lit(1)).alias("loaded"))
        gained = spark.createDataFrame(list(added.items()), "_name string, written bigint")
        per_job = (loaded.join(F.broadcast(gained), F.col("job_id").cast("string") == F.col("_name"), "left")
                   .select("job_id", "loaded", F.coalesce("written", F.lit(0)).cast("bigint").alias("written")))
        per_job = stage_table(per_job, "per_job")
    return {"jobs_found": found, "unreadable": unreadable, "written": sum(added.values()), "per_job": per_job}


def last_commit(spark: SparkSession, checkpoint: str) -> int:
    """The number of the last finished micro-batch of a stream (−1: none)."""
    fs, p = _fs(spark, f"{checkpoint.rstrip('/')}/commits/*")
    found = fs.globStatus(p) or []
    return max((int(s.getPath().getName()) for s in found if s.getPath().getName().isdigit()), default=-1)
