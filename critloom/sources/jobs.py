"""Job outputs (S3, K1) and metric tables (K3, K4).

Paths go through the Hadoop file system of the session, so the same code works on a
local folder, HDFS or an object store.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


READ_ERRORS = (PySparkException, Py4JJavaError)  # how a failed job shows, converted or not


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Directories matching a glob, in lexicographic order (as a shell glob lists them)."""
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    if st is None:
        return []
    return sorted(s.getPath().toString() for s in st if s.isDirectory())


ROWS_PER_FILE = 100_000
BYTES_PER_FILE = 64 << 20  # of a file's values before encoding: a task sorts its rows in several times that


def write_job(df: DataFrame, root: str, job_id: int) -> str:
    """K1: one job's rows to its own directory (overwritten on re-run)."""
    path = f"{root.rstrip('/')}/job={job_id}"
    df.withColumn("job_id", F.lit(job_id).cast("int")).write.mode("overwrite").parquet(path)
    return path


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    zero = F.lit(0).cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value).cast("bigint"), zero)
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.aggregate(value, zero, lambda held, x: held + _value_bytes(x, kind.elementType)), zero)
    if isinstance(kind, T.StructType):
        return sum((_value_bytes(value.getField(f.name), f.dataType) for f in kind), zero)
    return F.lit(8).cast("bigint")


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes the values of a row hold."""
    return sum((_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0).cast("bigint"))


def files_of(n: Column, size: Column, rows_per_file: int) -> Column:
    """How many files n rows of ``size`` bytes in all make: as many as keep each within both limits."""
    return F.greatest(F.ceil(n / F.lit(rows_per_file)), F.ceil(size / F.lit(BYTES_PER_FILE))).cast("bigint")


def cluster_by_job(df: DataFrame, key_cols: Sequence[str], job_col: str = "job_id", rows_per_file: int = ROWS_PER_FILE,
                   counts: DataFrame | None = None, salt: str = "_salt") -> DataFrame:
    """``df`` shuffled on (job, salt), with the salt as a column: a job of n rows has
    ``n / rows_per_file`` salts, or more if its rows hold more than ``BYTES_PER_FILE`` each, so a write
    partitioned by job makes about that many files of it (one at least, never more) however many tasks there
    are, and a hot job or one of long texts is spread over as many tasks.

    The salt is a hash of the key, so equal keys stay together. ``counts`` (job, n and, if known, bytes) says
    how many rows each job will have; by default ``df`` is counted, so a model-made ``df`` must be stored or
    its counts given. Only jobs with several salts are broadcast: one row per ``rows_per_file`` rows or
    ``BYTES_PER_FILE`` bytes at most.
    """
    if counts is None:
        counts = df.groupBy(job_col).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("bytes"))
    size = F.coalesce("bytes", F.lit(0)) if "bytes" in counts.columns else F.lit(0)
    salts = files_of(F.col("n"), size, rows_per_file)
    s = counts.agg(F.sum(salts).alias("groups"), F.sum("n").alias("rows"), F.sum(size).alias("size"), F.max(salts).alias("top")).first()
    if (s.top or 0) > 1:
        big = counts.filter(salts > 1).select(F.col(job_col).alias("_job"), salts.alias("_salts"))
        spread = F.pmod(F.xxhash64(*key_cols), F.coalesce(F.col("_salts"), F.lit(1).cast("bigint")))
        df = (df.join(F.broadcast(big), F.col(job_col).eqNullSafe(F.col("_job")), "left")
              .withColumn(salt, spread).drop("_job", "_salts"))
        by = [F.col(job_col), F.col(salt)]
    else:
        df, by = df.withColumn(salt, F.lit(0).cast("bigint")), [F.col(job_col)]
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * (s.rows or 0) // rows_per_file),
                -(-2 * (s.size or 0) // BYTES_PER_FILE))
    return df.repartition(max(1, min(s.groups or 1, tasks)), *by)


def replace_partitions(df: DataFrame, root: str, column: str | Sequence[str], lookup: str | None = None) -> None:
    """Write ``df`` partitioned by ``column`` (or several); only the partitions in ``df`` are replaced, each as a whole.
    (Every write stages in a folder of its own, so writers of other partitions do not disturb it.)

    With ``lookup`` the rows of each file are sorted by that column and its row groups get Bloom filters of
    it, so a scan for few of its values skips most row groups.
    """
    cols = [column] if isinstance(column, str) else list(column)
    w = df if lookup is None else df.sortWithinPartitions(*cols, lookup)
    w = w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
    if lookup is not None:
        w = w.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
    w.parquet(root)


def write_jobs(df: DataFrame, root: str, job_col: str = "job_id", key_cols: Sequence[str] = ("question_id", "turn"),
               rows_per_file: int = ROWS_PER_FILE, counts: DataFrame | None = None) -> None:
    """K1 for many jobs in one pass: each ``job=<j>`` directory (with ``job_id`` kept in the
    files) is replaced by its rows; directories of jobs not in ``df`` are left alone. The number of
    files follows from the rows and bytes of a job (see ``cluster_by_job``), not from the number of tasks."""
    rows = cluster_by_job(df, key_cols, job_col, rows_per_file, counts).drop("_salt")
    replace_partitions(rows.withColumn("job", F.col(job_col)), root, "job")


def job_dirs(spark: SparkSession, root: str) -> list[str]:
    return list_dirs(spark, f"{root.rstrip('/')}/job=*")


def read_jobs(spark: SparkSession, dirs: Sequence[str], schema: T.StructType) -> DataFrame:
    """S3: job directories read with one multi-path scan; a file that cannot be read is an error."""
    return spark.read.schema(schema).parquet(*dirs)


MAX_CHECKED_BYTES = 1 << 30  # larger files are not read as one value but tried by a scan of their own


def _fits(have: pa.DataType, want: pa.DataType) -> bool:
    """Whether a column of a file can be read as the declared type (the same, or a wider number)."""
    if pa.types.is_list(have) and pa.types.is_list(want):
        return _fits(have.value_type, want.value_type)
    if pa.types.is_struct(have) and pa.types.is_struct(want):
        named = {have.field(i).name: have.field(i).type for i in range(have.num_fields)}
        return all(f.name not in named or _fits(named[f.name], f.type) for f in want)
    if pa.types.is_signed_integer(have) and pa.types.is_signed_integer(want):
        return have.bit_width <= want.bit_width
    if pa.types.is_float32(have) and pa.types.is_float64(want):
        return True
    return have == want


def _is_readable(raw: bytes, want: dict[str, pa.DataType]) -> bool:
    """Whether a Parquet file can be read: every declared column of every row group is decoded."""
    try:
        f = pq.ParquetFile(io.BytesIO(raw))
        named = {x.name: x.type for x in f.schema_arrow}
        if not all(_fits(named[c], t) for c, t in want.items() if c in named):
            return False
        for i in range(f.num_row_groups):
            f.read_row_group(i, [c for c in want if c in named])
    except Exception:  # noqa: BLE001 - whatever a broken file raises
        return False
    return True


def check_files(spark: SparkSession, dirs: Sequence[str], schema: T.StructType) -> DataFrame:
    """S3: ``(path, ok)`` of every Parquet file in the job directories, in one pass: the files are
    listed once and each is decoded in a task. ``ok`` is null for files too large for one value."""
    from pyspark.sql.pandas.types import to_arrow_schema  # noqa: PLC0415

    want = {f.name: f.type for f in to_arrow_schema(schema)}
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(list(dirs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [_is_readable(x.as_py(), want) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ok, pa.bool_())], ["path", "ok"])

    size = F.col("length")
    small = files.filter(size <= F.lit(MAX_CHECKED_BYTES)).select("path", "content")
    large = files.filter(size > F.lit(MAX_CHECKED_BYTES)).select("path", F.lit(None).cast("boolean").alias("ok"))
    return small.mapInArrow(run, "path string, ok boolean").unionByName(large)


def readable_jobs(spark: SparkSession, dirs: Sequence[str], schema: T.StructType) -> tuple[list[str], list[str]]:
    """``(readable, unreadable)``: a job counts as a whole, so one broken part file rejects it.

    One pass over all files, however many are broken; only broken (or very large) files come to the driver.
    """
    if not dirs:
        return [], []
    suspect = check_files(spark, dirs, schema).filter("ok IS NOT TRUE").collect()

    def broken(path: str) -> bool:
        try:
            spark.read.schema(schema).parquet(path).write.format("noop").mode("overwrite").save()
            return False
        except READ_ERRORS:
            return True

    bad = [r.path for r in suspect if r.ok is False or broken(r.path)]
    unreadable = {d for d in dirs if any(_inside(p, d) for p in bad)} if bad else set()
    return [d for d in dirs if d not in unreadable], [d for d in dirs if d in unreadable]


def _inside(path: str, folder: str) -> bool:
    """Whether a file lies in a folder (the two may write their scheme differently)."""
    return _plain(path).startswith(_plain(folder).rstrip("/") + "/")


def _plain(path: str) -> str:
    return re.sub(r"^[a-z0-9]+:/*", "/", path)


# ---- metric and detail tables (K3, K4) ----------------------------------------------------

def read_steps(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A step table (``step`` is its partition column); None if there is none yet."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def write_blocks(rows: DataFrame, path: str) -> None:
    """K3: the complete rows of some blocks of some steps (see ``plans.evaluate.add_details``)."""
    replace_partitions(rows, path, ("step", "block"))


def append_metrics(metrics: DataFrame, path: str) -> None:
    """K4: long metrics rows, partitioned by step; a step written again is replaced."""
    replace_partitions(metrics, path, "step")
