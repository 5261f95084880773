"""Session helpers: a local session for tests and benches, and the shared stage folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job relies on: AQE for partition coalescing and skew splits, UTC for
# reproducible text, Arrow for the model column.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows per Arrow batch sent to a model column: whole documents can be ~100 KB each.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    # Materialized model stages are removed from the stage folder once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a cluster run: scan splits of about ``target_partition_bytes``
    (smaller if that would leave cores idle) and enough shuffle partitions for the input to
    spill-free fit, at least three per core. AQE coalesces the excess at run time."""
    split = max(16 << 20, min(target_partition_bytes, input_bytes // max(1, 2 * total_cores)))
    shuffle = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.shuffle.partitions": str(shuffle),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(target_partition_bytes, 128 << 20)),
            "spark.sql.execution.arrow.maxRecordsPerBatch": JOB_CONF["spark.sql.execution.arrow.maxRecordsPerBatch"],
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "critloom",
                  event_log_dir: str | None = None, driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; the UI stays off."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared stage folder: the context's checkpoint directory, else ``spark.checkpoint.dir``.

    On a cluster this names a shared file system and is only read here; without it a cluster
    job is refused, because a folder on the driver's disk cannot be read by executors. Only
    in local mode (tests, local benches) is a folder under the local temp directory created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not re.match(r"local($|\[)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    d = configured or tempfile.mkdtemp(prefix="critloom-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def materialize(df, eager: bool = True):
    """Write ``df`` to the shared stage folder and continue from there (a reliable checkpoint).

    Use after a model stage whose output is read more than once: later reads see the same
    values, and lineage (and the plan) is cut.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared stage folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def stage_table(df, name: str):
    """Write ``df`` as Parquet to a fresh folder under the stage folder and continue from the files.

    Like ``materialize``, but compressed and column-pruned; values that depend on the run (row
    numbers) stay as written when executors are lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


MODEL_BATCH_BYTES = 4 << 20  # of an Arrow batch that goes to a model, scorer or counter (a longer single row stands alone)


def bound_batches(spark: SparkSession | None = None) -> None:
    """Limit the session's Arrow batches by bytes too: a batch of whole texts is bounded however long they are."""
    spark = spark or SparkSession.getActiveSession() or getattr(SparkSession, "_instantiatedSession", None)
    if spark is not None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(MODEL_BATCH_BYTES))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make this package importable in the Python workers (once per application).

    Model and scorer columns pickle backend objects whose classes live here; executors
    need the code, so it is zipped and added with ``addPyFile``.
    """
    import zipfile  # noqa: PLC0415

    spark = spark or SparkSession.getActiveSession() or getattr(SparkSession, "_instantiatedSession", None)
    if spark is None:
        return
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="critloom-py-"), "critloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
