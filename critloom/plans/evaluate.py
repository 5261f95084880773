"""Judged evaluation (C7) and the evaluation history over training steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import judge_prompt_parts, message
from ..functions.scoring import with_score
from ..functions.text import strip_echo
from ..functions.texts import DEFAULT_KIT, PromptKit
from ..operators.aggregate import eval_metrics, metrics_of_counts, score_counts
from ..operators.model import Backend, generate
from ..operators.ranking import group_rank, slice_rows
from ..schemas import COUNTS
from ..session import stage_table
from ..sources.jobs import append_metrics, read_steps, write_blocks


def first_examples(examples: DataFrame, num_examples: int | None, order: str = "ord") -> DataFrame:
    """The first ``num_examples`` by ``order``; None or 0 means all (exact, no global sort)."""
    return slice_rows(examples, order, 0, num_examples) if num_examples else examples


def answer(prompt: Column, backend: Backend, context: Column | None = None) -> Column:
    """U7 + F12: ``struct<text, error>`` of a raw completion of the prompt (no chat template), echo stripped."""
    msgs = F.array(message("user", prompt)) if context is None else F.array(context, message("user", prompt))
    g = generate(msgs, backend)
    # A model column must not be referred to twice, so its text is stripped inside the struct.
    return F.transform(F.array(g), lambda r: F.struct(strip_echo(r.getField("text"), prompt).alias("text"),
                                                      r.getField("error").alias("error")))[0]


def with_answers(examples: DataFrame, backend: Backend, context: Column | None = None) -> DataFrame:
    """``examples`` with ``response`` and ``answer_error``; stored, so that every reader sees the same answers."""
    answered = examples.withColumn("_a", answer(F.col("prompt"), backend, context))
    return stage_table(answered.withColumns({"response": F.col("_a.text"), "answer_error": F.col("_a.error")}).drop("_a"), "answers")


def judge(details: DataFrame, judge_backend: Backend, prompt: str = "prompt", response: str = "response",
          kit: PromptKit = DEFAULT_KIT) -> DataFrame:
    """F13 + U6 + F14: judgment text, score, where the score came from, and ``judge_error``.

    A judge call that failed, or an answer that failed (``answer_error``, if the column is
    there), has a null score: it does not enter the means. A judgment without a score pattern
    still scores 5.
    """
    judged = (details.withColumn("_j", generate(judge_prompt_parts(prompt, response, kit), judge_backend))
              .withColumns({"judgment": F.col("_j.text"), "judge_error": F.col("_j.error")}).drop("_j"))
    if "answer_error" not in judged.columns:
        judged = judged.withColumn("answer_error", F.lit(None).cast("string"))
    scored = with_score(judged, "judgment")
    good = F.col("judge_error").isNull() & F.col("answer_error").isNull()
    return scored.withColumn("score", F.when(good, F.col("score")))


def judged_eval(examples: DataFrame, answer_backend: Backend, judge_backend: Backend, num_examples: int | None = None,
                step: int | None = None, kit: PromptKit = DEFAULT_KIT) -> tuple[DataFrame, DataFrame]:
    """Answer each example, judge the answer, return ``(metrics, details)``.

    Answers are stored before they are judged, and judgments before metrics are taken, so both
    results come from one run of each model.
    """
    ex = first_examples(examples, num_examples)
    answered = with_answers(ex.select(F.lit(step).cast("bigint").alias("step"), "ord", "prompt", "category"), answer_backend)
    details = stage_table(judge(answered, judge_backend, kit=kit), "judged")
    return eval_metrics(details), details


DETAIL_BLOCK = 10_000
LISTED_PARTITIONS = 100_000


def add_details(judged: DataFrame, path: str, counts_path: str | None = None, block_rows: int = DETAIL_BLOCK) -> DataFrame:
    """K3: add judged rows to the step table at ``path`` and return the complete rows of their steps.

    Rows are merged on ``(step, ord)``: a row judged again replaces the earlier one, all others
    of its step stay. The table is partitioned by step and by block of ``block_rows`` consecutive ``ord``;
    only the blocks that a new row falls in are read and rewritten, so a late row of a large step
    costs a block. Merged rows are stored first, so nothing is overwritten while being read. With
    ``counts_path`` the histogram of each rewritten block replaces the block's earlier one: the
    metrics of a step are those of its blocks' histograms (``operators.aggregate.metrics_of_counts``).
    Adding the same rows again changes nothing.
    """
    spark, cols = judged.sparkSession, judged.columns
    block = F.coalesce(F.floor(F.col("ord") / F.lit(block_rows)), F.lit(-1)).cast("bigint")
    placed = judged.withColumn("block", block)
    prior = read_steps(spark, path, placed.schema)
    merged = placed
    if prior is not None:
        touched = placed.select(F.col("step").alias("_t"), F.col("block").alias("_b")).distinct()
        keys = judged.select(F.col("step").alias("_s"), F.col("ord").alias("_o"))
        # The partitions to read are known at run time: one row per block of this batch.
        kept = (prior.join(_listed(touched), F.col("step").eqNullSafe(F.col("_t")) & (F.col("block") == F.col("_b")), "left_semi")
                .join(keys, F.col("step").eqNullSafe(F.col("_s")) & F.col("ord").eqNullSafe(F.col("_o")), "left_anti"))
        merged = stage_table(placed.unionByName(kept.select(*placed.columns)), "merged_details")
    write_blocks(merged, path)
    if counts_path is not None:
        write_blocks(score_counts(merged, "step", "block"), counts_path)
    return _steps_of(spark.read.schema(placed.schema).parquet(path), judged).select(*cols)


def _steps_of(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of a step table whose step is in ``rows`` (partitions are pruned at run time)."""
    steps = rows.select(F.col("step").alias("_t")).distinct()
    return table.join(_listed(steps), F.col("step").eqNullSafe(F.col("_t")), "left_semi")  # one row per step


def _listed(parts: DataFrame) -> DataFrame:
    """Partition values, broadcast if they are few (then the scan reads no other partition)."""
    return F.broadcast(parts) if parts.count() <= LISTED_PARTITIONS else parts


def eval_history(answers: DataFrame, judge_backend: Backend, details_path: str | None = None,
                 metrics_path: str | None = None, kit: PromptKit = DEFAULT_KIT,
                 counts_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Judge the answers of every step in one job, then add details (K3) and metrics (K4).

    ``answers``: ``(step, ord, prompt, category, response)``, optionally ``answer_error``. The
    judge runs once per row. Returns the metrics and detail rows of the steps in ``answers``
    (complete, with rows judged earlier); metrics of other steps are neither read nor written. With
    ``counts_path`` (and ``details_path``) metrics come from stored histograms, so rows judged earlier
    are read only where a new row is put among them.
    """
    judged = stage_table(judge(answers, judge_backend, kit=kit), "judged")
    details = judged
    if details_path is not None:
        details = add_details(judged, details_path, counts_path)
    if details_path is not None and counts_path is not None:
        counts = judged.sparkSession.read.schema(COUNTS).parquet(counts_path)
        metrics = metrics_of_counts(_steps_of(counts, judged))
    else:
        metrics = eval_metrics(details)
    if metrics_path is not None:
        metrics = stage_table(metrics, "metrics")
        append_metrics(metrics, metrics_path)
    return metrics, details


RECORD_ROWS = 1000


def _lists(details: DataFrame, by: tuple[str, ...], order: str) -> DataFrame:
    """Parallel lists (prompts, responses, judgments, scores) of each group, in order."""
    entry = F.struct(F.col(order).alias("o"), "prompt", "response", "judgment", "score")
    g = details.groupBy(*by).agg(F.sort_array(F.collect_list(entry)).alias("_d"))

    def field(name: str):
        return lambda e: e.getField(name)

    return g.select(*by, *[F.transform("_d", field(f)).alias(a) for f, a in
                           (("prompt", "prompts"), ("response", "responses"), ("judgment", "judgments"),
                            ("score", "scores"))])


def record_blocks(details: DataFrame, step: str = "step", order: str = "ord", block_rows: int = RECORD_ROWS) -> DataFrame:
    """The graded examples of each step as parallel lists in example order, one record per step and
    ``block`` of ``block_rows`` examples (0, 1, … in example order).

    Examples are numbered within their step without gathering it (``group_rank`` over the keys only, so texts
    are not sorted), and cut by number: no group and no row holds more than a block, however large a step is.
    A caller that wants one record puts the blocks of a step together.
    """
    rows = stage_table(details.withColumn("_row", F.monotonically_increasing_id()), "graded")  # fixes the row's number
    ranked = group_rank(rows.select(step, order, "_row"), [step], order, column="_rank").select("_row", "_rank")
    block = F.floor((F.col("_rank") - 1) / F.lit(block_rows)).cast("bigint")
    placed = rows.join(ranked, "_row").withColumn("block", block)
    # Rows that share an order keep the order of their numbers.
    return _lists(placed.withColumn("_at", F.col("_rank")), (step, "block"), "_at")


def details_record(details: DataFrame, by: tuple[str, ...] = ("step",), order: str = "ord") -> DataFrame:
    """The graded examples of each step as parallel lists (prompts, responses, judgments,
    scores) in example order, one record per step.

    A step's examples meet in one row, so use it for evaluation-sized sets only; ``record_blocks`` gives
    the same lists in rows of bounded size.
    """
    return _lists(details, by, order)
