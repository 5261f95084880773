"""Evaluation history as a stream (C8): judge each step's answers as they land.

Training writes answers as commit directories under ``answers_root`` (a step may arrive in
several commits). The file stream picks up new files; each micro-batch is judged once and
stored, merged into the step table on ``(step, ord)`` (``plans.evaluate.add_details``), and the
metrics of the touched steps are added up from the histograms of their blocks. A micro-batch replayed
after a failure replaces the same rows and histograms instead of duplicating them. Commits that hold many
steps at once cost one pass; a late commit reads and rewrites only the blocks that its rows fall in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.model import Backend
from ..plans.evaluate import eval_history

ANSWERS = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("ord", T.LongType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("answer_error", T.StringType()),
])


def eval_history_stream(spark: SparkSession, answers_root: str, judge_backend: Backend, details_path: str,
                        metrics_path: str, checkpoint: str, available_now: bool = True, counts_path: str | None = None):
    """Start (and with ``available_now`` run to completion) the streaming evaluation. Histograms go to
    ``counts_path`` (default: beside the details)."""
    counts = counts_path or f"{details_path.rstrip('/')}-counts"

    def per_batch(batch: DataFrame, _batch_id: int) -> None:
        if not batch.isEmpty():
            eval_history(batch, judge_backend, details_path, metrics_path, counts_path=counts)

    # Each commit is a directory under the root (one level, any name).
    stream = spark.readStream.schema(ANSWERS).parquet(f"{answers_root.rstrip('/')}/*")
    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
