"""The published table (S5, K2): Parquet partitioned by job, each partition owned by one writer at a time.

``<target>/job_id=<j>/`` holds the rows of job j and nothing else does. A writer takes the claims of the
jobs that it adds rows to (one file each, created exclusively), then looks at what is published of them,
and then replaces those partitions as a whole. So two writers never work on the same job at once, the
second one sees what the first one wrote, and a reader needs no list of what is valid: the table is an
ordinary partitioned table, and its plan has one path however often it was merged into.

The file system must create files exclusively (HDFS and local disks do). Claims left behind by a writer
that was killed are taken up again by a writer with the same ``owner``, or cleared with ``release_claims``.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from .jobs import ROWS_PER_FILE, _fs, cluster_by_job, files_of, list_dirs, replace_partitions, row_bytes

DEFAULT_KEY = ("question_id", "turn", "job_id")
CLAIMS = "_claims"
WHOLE_TABLE = "table"    # the claim of a merge whose key does not hold the job
NO_JOB = "__HIVE_DEFAULT_PARTITION__"
WAIT_SECONDS = 600.0
POLL_SECONDS = 0.25
FEW_KEYS = 1000          # values that a scan is asked for one by one
MANY_JOBS = 1000         # more jobs are matched by a join instead of a list in the plan


class JobClaimed(RuntimeError):
    """A job's partition is owned by another writer and was not released in time."""


# ---- claims ------------------------------------------------------------------------------

def _create(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file that must not exist yet; False if it does."""
    fs, p = _fs(spark, path)
    if fs.getUri().getScheme() == "file":  # Hadoop's local file system tests and creates in two steps
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            f = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(f, "w") as out:
            out.write(content)
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    return True


def _owner_of(spark: SparkSession, path: str) -> str | None:
    """What a claim file holds; None if it is gone or not readable."""
    fs, p = _fs(spark, path)
    try:
        stream = fs.open(p)
    except Py4JJavaError:
        return None
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, False)


@contextmanager
def claimed(spark: SparkSession, target: str, names: Sequence[str], owner: str | None = None,
            wait: float = WAIT_SECONDS) -> Iterator[None]:
    """Own ``names`` (jobs) of the table for the length of a block.

    Claims are taken in one order everywhere, so writers that wait for each other cannot lock up;
    after ``wait`` seconds without getting one JobClaimed is raised and the others are released.
    """
    owner = owner or uuid.uuid4().hex
    held: list[str] = []
    try:
        for name in sorted(set(names)):
            path, until = f"{target.rstrip('/')}/{CLAIMS}/{name}", time.monotonic() + wait
            while not (_create(spark, path, owner) or _owner_of(spark, path) == owner):
                if time.monotonic() >= until:
                    raise JobClaimed(f"{path} is held by another writer")
                time.sleep(POLL_SECONDS)
            held.append(path)
        yield
    finally:
        for path in held:
            _remove(spark, path)


def release_claims(spark: SparkSession, target: str, names: Sequence[str] | None = None) -> list[str]:
    """Clear the claims of a writer that was killed (all, or those of ``names``); returns what was cleared.
    Only for claims whose writer is known to be gone."""
    fs, p = _fs(spark, f"{target.rstrip('/')}/{CLAIMS}/*")
    found = [s.getPath() for s in (fs.globStatus(p) or []) if names is None or s.getPath().getName() in names]
    for path in found:
        fs.delete(path, False)
    return sorted(path.getName() for path in found)


# ---- reading -----------------------------------------------------------------------------

def _name(job: int | None) -> str:
    return NO_JOB if job is None else str(job)


def published_jobs(spark: SparkSession, target: str) -> list[str]:
    """Names of the jobs that have a partition, in lexicographic order."""
    return [d.rsplit("job_id=", 1)[1] for d in list_dirs(spark, f"{target.rstrip('/')}/job_id=*")]


def read_published(spark: SparkSession, target: str, schema: T.StructType,
                   jobs: Sequence[str] | None = None) -> DataFrame | None:
    """The published table, or the partitions of some jobs; None if there are none (only a missing
    table starts a new one). A filter on ``job_id`` prunes directories."""
    root = target.rstrip("/")
    if jobs is None:
        paths = [root] if published_jobs(spark, target) else []
    else:
        paths = [f"{root}/job_id={j}" for j in jobs]
    if not paths:
        return None
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.fieldNames())


def _of_jobs(df: DataFrame, jobs: Sequence[str]) -> DataFrame:
    """The rows of some jobs (by partition name)."""
    name = F.coalesce(F.col("job_id").cast("string"), F.lit(NO_JOB))
    if len(jobs) <= MANY_JOBS:
        return df.filter(name.isin(list(jobs)))
    listed = df.sparkSession.createDataFrame([(j,) for j in jobs], "_name string")
    return df.join(F.broadcast(listed), name == F.col("_name"), "left_semi")  # a row per job of this merge


def _same(keys: Sequence[str]):
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_s{i}"))
    return cond


def among(published: DataFrame, rows: DataFrame, column: str, most: int = FEW_KEYS) -> DataFrame:
    """The published rows whose ``column`` has a value that ``rows`` has. Up to ``most`` values are put in the
    scan, which then skips the row groups whose Bloom filter or range has none; more are left to the join
    that follows."""
    values = [r[0] for r in rows.select(column).distinct().limit(most + 1).collect()]
    if len(values) > most:
        return published
    given = [v for v in values if v is not None]
    hit = F.col(column).isin(given) if given else F.lit(False)
    return published.filter(hit | F.col(column).isNull() if len(given) < len(values) else hit)


def _once(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    return rows.dropDuplicates(list(dict.fromkeys(cols)))


def _unpublished(rows: DataFrame, target: str, schema: T.StructType, key_cols: Sequence[str],
                 jobs: Sequence[str] | None = None) -> DataFrame:
    """The rows whose key is not published. Only keys are compared; whole rows are moved only if there are new ones."""
    seen = among(read_published(rows.sparkSession, target, schema, jobs), rows, key_cols[0])
    renamed = [F.col(k).alias(f"_s{i}") for i, k in enumerate(key_cols)]
    new = stage_table(rows.select(*key_cols).join(seen.select(*renamed), _same(key_cols), "left_anti").distinct(), "new_keys")
    if new.isEmpty():
        return rows.limit(0)
    return rows.join(new.select(*renamed), _same(key_cols), "left_semi")


def _sizes(df: DataFrame | None) -> dict[str, int]:
    """Rows per job; only row counts of the files are read."""
    if df is None:
        return {}
    rows = df.groupBy("job_id").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per job of this merge
    return {_name(r.job_id): r.n for r in rows}


# ---- writing -----------------------------------------------------------------------------

def publish_rows(rows: DataFrame, target: str, schema: T.StructType, jobs: Sequence[int | None] | None = None,
                 key_cols: Sequence[str] = DEFAULT_KEY, once: bool = True, owner: str | None = None,
                 wait: float = WAIT_SECONDS, rows_per_file: int = ROWS_PER_FILE) -> dict[str, int]:
    """Add rows to the published table; returns the number of rows added per job (jobs that got none
    are not in it).

    ``once``: one row per key, and none for a key that is published already; else every row is added.
    The rows of a job that is new to the table are written as they are; of other jobs only the keys are
    read, and only those that get a row are rewritten, from a stored copy, together with their earlier rows.
    ``jobs`` lists the jobs in ``rows`` (default: found by a pass). A key without ``job_id`` is unique
    in the whole table, so such a merge owns all of it; every merge into a table must use the same key.
    """
    spark, names = rows.sparkSession, [f.name for f in schema.fields]
    if "job_id" not in names:
        raise ValueError("a published table is partitioned by its column job_id")
    rows = rows.select(*names)
    if jobs is None:
        jobs = [r.job_id for r in rows.select("job_id").distinct().collect()]
    ours = sorted({_name(j) for j in jobs})
    if not ours:
        return {}
    by_job = "job_id" in key_cols
    with claimed(spark, target, ours if by_job else [WHOLE_TABLE], owner, wait):
        there = set(published_jobs(spark, target))
        known, fresh = [j for j in ours if j in there], [j for j in ours if j not in there]
        before = _sizes(read_published(spark, target, schema, known) if known else None)
        parts: list[DataFrame] = []
        if not by_job:
            new = _unpublished(rows, target, schema, key_cols) if once and there else rows
            rows = stage_table(_once(new, key_cols) if once else new, "unpublished")
            known = [j for j in known if j in _sizes(rows)]
        if fresh:
            new = cluster_by_job(_of_jobs(rows, fresh) if known else rows, key_cols, rows_per_file=rows_per_file)
            parts.append((_once(new, [*key_cols, "_salt"]) if once and by_job else new).drop("_salt"))
        if known:
            added = _of_jobs(rows, known)
            if once and by_job:
                added = _once(_unpublished(added, target, schema, key_cols, known), key_cols)
            added = stage_table(added, "added")
            changed = sorted(_sizes(added))
            if changed:
                whole = stage_table(read_published(spark, target, schema, changed).unionByName(added), "republished")
                parts.append(cluster_by_job(whole, key_cols, rows_per_file=rows_per_file).drop("_salt"))
        for part in parts:
            replace_partitions(part, target, "job_id", key_cols[0])
        now = [j for j in published_jobs(spark, target) if j in set(ours)]
        after = _sizes(read_published(spark, target, schema, now) if now else None)
    return {j: n - before.get(j, 0) for j, n in after.items() if n > before.get(j, 0)}


def compact(spark: SparkSession, target: str, schema: T.StructType, key_cols: Sequence[str] = DEFAULT_KEY,
            rows_per_file: int = ROWS_PER_FILE, wait: float = WAIT_SECONDS) -> int:
    """Rewrite the partitions that hold more files than their rows need; returns how many there were."""
    names = published_jobs(spark, target)
    if not names:
        return 0
    with claimed(spark, target, names if "job_id" in key_cols else [WHOLE_TABLE], None, wait):
        table = read_published(spark, target, schema, names)
        # Hashing leaves a file of a partition empty now and then, and never makes more than are asked for.
        held = (table.select("job_id", F.input_file_name().alias("_f")).groupBy("job_id")
                .agg(F.count_distinct("_f").alias("files"), F.count(F.lit(1)).alias("n")))
        held = held.filter(F.col("files") > F.ceil(F.col("n") / F.lit(rows_per_file))).collect()
        crowded = [_name(r.job_id) for r in held]
        if crowded:  # by rows; jobs of long texts may need that many
            files = {_name(r.job_id): r.files for r in held}
            table = read_published(spark, target, schema, crowded)
            needed = table.groupBy("job_id").agg(files_of(F.count(F.lit(1)), F.sum(row_bytes(table)), rows_per_file).alias("k")).collect()
            crowded = [_name(r.job_id) for r in needed if files[_name(r.job_id)] > r.k]
        if crowded:
            rows = stage_table(read_published(spark, target, schema, crowded), "compacted")
            replace_partitions(cluster_by_job(rows, key_cols, rows_per_file=rows_per_file).drop("_salt"), target, "job_id",
                               key_cols[0])
    return len(crowded)
