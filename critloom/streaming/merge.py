"""Incremental merge (X1): each finished job directory is appended exactly once.

A file-stream source over the job directories remembers which files it has read in its
checkpoint. Two sinks:

* ``incremental_merge``: the file sink, which commits each micro-batch atomically through
  its own log. Exactly once per *file*: a re-run adds nothing, a new job directory adds only
  its own rows.
* ``incremental_merge_by_key``: ``foreachBatch`` publishing only rows whose key is new
  (the batch merge's rule). Exactly once per *row key*: a job directory generated again, or
  a micro-batch replayed after a failure, adds nothing.

Neither stream skips what it cannot read: a broken file stops the run with an error before its
micro-batch is committed, so once it is repaired or removed the next run takes it up. (The
batch merge leaves such a job out and lists it.)

Run either with ``availableNow`` after every job, or continuously.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.merge import last_commit
from ..sources.published import DEFAULT_KEY, publish_rows


def _source(spark: SparkSession, jobs_root: str, schema: T.StructType) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000)
            .parquet(f"{jobs_root.rstrip('/')}/job=*"))


def incremental_merge(spark: SparkSession, jobs_root: str, target: str, checkpoint: str,
                      schema: T.StructType) -> int:
    """Process every job file not seen before and return the number of micro-batches committed."""
    before = last_commit(spark, checkpoint)
    q = (_source(spark, jobs_root, schema).writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy("job_id").outputMode("append").trigger(availableNow=True).start(target))
    q.awaitTermination()
    return last_commit(spark, checkpoint) - before


def read_merged(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The merged table as committed by the sink (files listed in its log only)."""
    return spark.read.schema(schema).parquet(target).select(*schema.fieldNames())


def incremental_merge_by_key(spark: SparkSession, jobs_root: str, target: str, checkpoint: str,
                             schema: T.StructType, key_cols: Sequence[str] = DEFAULT_KEY) -> int:
    """Publish new job files, keeping only rows whose key is not published; returns micro-batches committed.

    The table is that of the batch merge (read it with ``sources.published.read_published``), and both
    may run at once. A stream that was killed takes up its own claims when it is started again.
    """

    def per_batch(batch: DataFrame, _batch_id: int) -> None:
        if not batch.isEmpty():
            publish_rows(batch, target, schema, None, key_cols, owner=f"stream {checkpoint}")

    before = last_commit(spark, checkpoint)
    q = (_source(spark, jobs_root, schema).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return last_commit(spark, checkpoint) - before
