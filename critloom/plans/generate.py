"""Critique–revise (C1), multi-turn generation (C2) and the generation job.

The whole conversation lives in one wide row: every turn adds columns (question, first
answer, critiques, rewrite) and appends a struct to an ``_turns`` array that is exploded
once at the end. Turns are never unioned: a union would re-run every earlier turn in each
branch and, with a sampling model, pair answers from different runs.

Two execution modes give the same rows. For a deterministic model the stages are fused: a task
computes a round, or a question and its answer, at once, and hands the rows on by a shuffle, as every
model stage of a task has a Python worker of its own for as long as the task runs. For a real
(sampling) model every stage is stored before the next reads it, as a narrow Parquet table
``(keys, text, error)``: replies are never computed twice, and a run that is started again
with the same ``stage_dir`` makes no second call for a finished stage. What is known of each
conversation is stored too, after every answer and round. Either way ``chosen``
and ``rejected`` always come from the same run, even when a task is retried.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import prompts as P
from ..functions.text import content_id, default_if_empty
from ..functions.texts import DEFAULT_KIT, PromptKit
from ..operators.model import Backend, generate, generate_map
from ..operators.sampling import sample_principle
from ..schemas import GENERATED, MESSAGES
from ..session import scratch_path
from ..sources.jobs import ROWS_PER_FILE, path_exists, remove_path, write_jobs

_STR_ARRAY = "array<string>"


@dataclass(frozen=True)
class GenerationConfig:
    num_turns: int = 1
    num_revisions: int = 1
    seed: int = 0
    stage: str = "sl"
    chain: bool = False            # later rounds critique the previous rewrite (default: the first answer)
    blank_batch: bool = False      # a failing chunk blanks every row of it
    # Store every model stage (default: when the model is not deterministic). Each job then
    # holds one Python stage per task, so one worker per core keeps the model loaded (chained
    # stages would each start their own worker and load their own copy).
    checkpoint_stages: bool | None = None
    # Where stage tables go; a finished one that is already there is read instead of computed.
    # One folder belongs to one run (same questions, config and model). None: a fresh folder
    # under the shared stage folder, so nothing is resumed.
    stage_dir: str | None = None
    # Rows per task of a model stage, which sets the number of tasks from the number of rows:
    # rows are small but each carries many model calls, so byte-based sizing (AQE) would
    # coalesce them into a few tasks. A deterministic stub keeps the natural partitioning.
    rows_per_task: int = 256
    # A fixed number of tasks instead (0: the natural partitioning).
    model_partitions: int | None = None
    # Run model stages as map stages (``mapInArrow``) instead of expression columns; with a
    # Spark ``ResourceProfile`` they are scheduled on accelerator executors only (stage-level
    # scheduling: YARN, Kubernetes, or Standalone with dynamic allocation; not local mode).
    map_stages: bool = False
    resource_profile: object | None = None
    kit: PromptKit = DEFAULT_KIT   # instructions, principles and worked examples


def _gen(messages, backend: Backend, cfg: GenerationConfig) -> Column:
    """One model stage as a ``struct<text, error>`` column."""
    return generate(messages, backend, cfg.blank_batch)


def _stores(backend: Backend, cfg: GenerationConfig) -> bool:
    return cfg.checkpoint_stages if cfg.checkpoint_stages is not None else not backend.deterministic


def _with_dir(df: DataFrame, backend: Backend, cfg: GenerationConfig) -> GenerationConfig:
    """The config with the folder that this run's stage tables share."""
    if cfg.stage_dir is not None or not _stores(backend, cfg):
        return cfg
    return replace(cfg, stage_dir=scratch_path(df.sparkSession, "model-stages"))


def _stage(df: DataFrame, name: str, messages, backend: Backend, cfg: GenerationConfig,
           key_cols: tuple[str, ...], label: str) -> DataFrame:
    """Add one model stage as column ``name``; stored as a table of its own if the config asks for it.

    A stored stage is read from ``<stage_dir>/<label>`` when it is complete there, else written;
    its keys, text and error are joined back, so no other column is ever written twice.
    """
    def called(rows: DataFrame, prompt) -> DataFrame:
        if cfg.map_stages or cfg.resource_profile is not None:
            return generate_map(rows, prompt, name, backend, cfg.blank_batch, cfg.resource_profile)
        return rows.withColumn(name, _gen(prompt, backend, cfg))

    if not _stores(backend, cfg):
        return called(df, messages)
    spark, path = df.sparkSession, f"{cfg.stage_dir.rstrip('/')}/{label}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        prompt = messages if isinstance(messages, P.Prompt) else P.Prompt((), messages)
        rows = df.select(*key_cols, prompt.suffix.alias("_suffix"))  # all that the call needs
        if cfg.model_partitions:
            rows = rows.repartition(cfg.model_partitions, *key_cols)
        _write(called(rows, replace(prompt, suffix=F.col("_suffix"))).select(*key_cols, name), path)
    keys = T.StructType([df.schema[k] for k in key_cols])
    done = spark.read.schema(keys.add(name, GENERATED)).parquet(path)
    renamed = done.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key_cols)], name)
    same = F.lit(True)
    for i, k in enumerate(key_cols):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(renamed, same).drop(*[f"_k{i}" for i in range(len(key_cols))])


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _handed_on(df: DataFrame, cfg: GenerationConfig, key_cols: tuple[str, ...], label: str) -> DataFrame:
    """``df`` shuffled by its keys, which no model makes, so that later model stages run in tasks of their own.
    The label is hashed too: Spark drops a shuffle by what the rows are shuffled by already."""
    by = F.xxhash64(*key_cols, F.lit(label))
    return df.repartition(cfg.model_partitions, by) if cfg.model_partitions else df.repartition(by)


def _settled(df: DataFrame, backend: Backend, cfg: GenerationConfig, label: str, key_cols: tuple[str, ...] = (),
             more: bool = False) -> DataFrame:
    """The conversations so far, stored under ``<stage_dir>/_state`` if the config stores stages.

    Settled after every answer and every round, so a stage joins the one or two stage tables since then
    and not all earlier ones: reading grows with the number of stages, not with its square. Fused stages
    are parted by a shuffle if ``more`` follow.
    """
    if not _stores(backend, cfg):
        return _handed_on(df, cfg, key_cols, label) if more else df
    path = f"{cfg.stage_dir.rstrip('/')}/_state/{label}"
    if not path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _errors(*gens: str) -> Column:
    return F.array_compact(F.array(*[F.col(f"{g}.error") for g in gens]))


def critique_revise(df: DataFrame, history_col: str, initial_col: str, backend: Backend,
                    cfg: GenerationConfig = GenerationConfig(), key_cols: tuple[str, ...] = ("question_id",),
                    turn: Column | int = 0, more: bool = False) -> DataFrame:
    """``num_revisions`` rounds of principle → critique → rewrite.

    Adds ``critique_requests``, ``critiques``, ``revision_requests``, ``revisions`` (one entry
    per round), ``revised_response`` (last rewrite; null after 0 rounds) and ``_errors``.
    Each round critiques the first answer unless ``cfg.chain``. Principles are picked from
    ``md5(seed:keys:turn:round)``, so a retried task picks the same one. ``key_cols`` must
    identify a row (stored stages are joined back on them). ``more`` says that model stages follow.
    """
    t = F.lit(turn) if isinstance(turn, int) else turn
    cfg = _with_dir(df, backend, cfg)
    at = turn if isinstance(turn, int) else "x"
    df = df.withColumns({
        "critique_requests": F.array().cast(_STR_ARRAY), "critiques": F.array().cast(_STR_ARRAY),
        "revision_requests": F.array().cast(_STR_ARRAY), "revisions": F.array().cast(_STR_ARRAY),
        "revised_response": F.lit(None).cast("string"), "_errors": F.array().cast(_STR_ARRAY),
    })
    for r in range(cfg.num_revisions):
        base = F.coalesce(F.col("revised_response"), F.col(initial_col)) if cfg.chain else F.col(initial_col)
        df = df.withColumns({"_p": sample_principle(cfg.seed, *key_cols, t, F.lit(r), stage=cfg.stage, kit=cfg.kit),
                             "_base": base})
        df = _stage(df, "_crit", P.critique_prompt_parts(history_col, F.col("_base"), F.col("_p.critique"), cfg.kit),
                    backend, cfg, key_cols, f"turn{at}-round{r}-critique")
        df = _stage(df, "_rev", P.revision_prompt_parts(history_col, F.col("_base"), F.col("_p.critique"),
                                                        F.col("_crit.text"), F.col("_p.revision"), cfg.kit), backend, cfg,
                    key_cols, f"turn{at}-round{r}-revision")
        df = df.withColumns({
            "critique_requests": F.array_append("critique_requests", F.col("_p.critique")),
            "critiques": F.array_append("critiques", F.col("_crit.text")),
            "revision_requests": F.array_append("revision_requests", F.col("_p.revision")),
            "revisions": F.array_append("revisions", F.col("_rev.text")),
            "revised_response": F.col("_rev.text"),
            "_errors": F.concat("_errors", _errors("_crit", "_rev")),
        }).drop("_p", "_base", "_crit", "_rev")
        df = _settled(df, backend, cfg, f"turn{at}-round{r}", key_cols, more or r + 1 < cfg.num_revisions)
    return df


def generate_preferences(questions: DataFrame, backend: Backend, cfg: GenerationConfig = GenerationConfig(),
                         student_backend: Backend | None = None) -> DataFrame:
    """Multi-turn conversations with critique and revision; one preference row per turn.

    ``questions``: ``question_id``, ``text``, ``category`` (plus any pass-through columns
    such as ``job_id``); ``question_id`` must be unique. Output follows ``schemas.PREFERENCES``: ``messages`` is the history up
    to and including this turn's rewrite, ``chosen`` the rewrite, ``rejected`` the first answer.
    """
    student = student_backend or backend
    keep = [c for c in questions.columns if c not in ("question_id", "text", "category")]
    df = questions.select(
        "question_id", *keep,
        content_id("text").alias("conversation_id"),
        F.col("category").cast("string").alias("category"),
        F.col("text").alias("_q0"),
        F.array().cast(MESSAGES).alias("_hist"),
        F.array().cast(f"array<struct<turn:int,question:string,"
                       f"initial_response:string,critique_requests:{_STR_ARRAY},critiques:{_STR_ARRAY},"
                       f"revision_requests:{_STR_ARRAY},revisions:{_STR_ARRAY},chosen:string,"
                       f"rejected:string,errors:{_STR_ARRAY}>>").alias("_turns"),
    )
    cfg = _with_dir(questions, backend, cfg)
    if cfg.model_partitions is None and not backend.deterministic:
        cfg = replace(cfg, model_partitions=max(1, -(-questions.count() // cfg.rows_per_task)))
    if cfg.model_partitions and not _stores(backend, cfg):
        # Hash of the unique question id: balanced, and the same assignment on a retry.
        df = df.repartition(cfg.model_partitions, "question_id")
    keys = ("question_id",)
    for t in range(cfg.num_turns):
        if t == 0:
            df = df.withColumns({"_q": F.col("_q0"), "_q_error": F.lit(None).cast("string")})
        else:
            df = _stage(df, "_sq", P.student_prompt_parts("_hist", cfg.kit), student, cfg, keys, f"turn{t}-question")
            df = df.withColumns({"_q": default_if_empty(F.col("_sq.text")), "_q_error": F.col("_sq.error")}) \
                   .drop("_sq")
        df = df.withColumn("_hist", F.concat("_hist", F.array(P.message("user", F.col("_q")))))
        df = _stage(df, "_init", P.teacher_prompt_parts("_hist", cfg.kit), backend, cfg, keys, f"turn{t}-answer")
        df = _settled(df, backend, cfg, f"turn{t}-answer", keys, cfg.num_revisions > 0 or t + 1 < cfg.num_turns)
        df = critique_revise(df, "_hist", "_init.text", backend, cfg, turn=t, more=t + 1 < cfg.num_turns)
        df = df.withColumn("_hist", F.concat("_hist", F.array(P.message("assistant", F.col("revised_response")))))
        row = F.struct(
            F.lit(t).alias("turn"), F.col("_q").alias("question"),
            F.col("_init.text").alias("initial_response"), F.col("critique_requests"), F.col("critiques"),
            F.col("revision_requests"), F.col("revisions"), F.col("revised_response").alias("chosen"),
            F.col("_init.text").alias("rejected"),
            F.array_compact(F.concat(F.array(F.col("_q_error"), F.col("_init.error")), F.col("_errors")))
            .alias("errors"),
        )
        df = df.withColumn("_turns", F.array_append("_turns", row)).drop(
            "_q", "_q_error", "_init", "critique_requests", "critiques", "revision_requests",
            "revisions", "revised_response", "_errors")
    # The history of turn t is the first 2·(t+1) messages of the final history, so the row
    # carries one history instead of one snapshot per turn.
    out = df.select("question_id", *keep, "conversation_id", "category", "_hist",
                    F.explode("_turns").alias("_t"))
    return out.select(
        "question_id", F.col("_t.turn").alias("turn"), "conversation_id",
        F.col("_t.question").alias("question"),
        F.slice("_hist", 1, (F.col("_t.turn") + 1) * 2).alias("messages"), "category",
        F.col("_t.initial_response").alias("initial_response"),
        F.col("_t.critique_requests").alias("critique_requests"), F.col("_t.critiques").alias("critiques"),
        F.col("_t.revision_requests").alias("revision_requests"), F.col("_t.revisions").alias("revisions"),
        F.col("_t.chosen").alias("chosen"), F.col("_t.rejected").alias("rejected"),
        *keep, F.col("_t.errors").alias("errors"),
    )


def generation_job(questions: DataFrame, out_dir: str, backend: Backend,
                   cfg: GenerationConfig = GenerationConfig(), rows_per_file: int = ROWS_PER_FILE) -> dict:
    """Generate for every job slice (``job_id`` column) and write each slice to its own
    directory ``<out_dir>/job=<j>`` (K1, dynamic overwrite: re-running a job replaces only its
    directory). How many rows a job will have is known before any model call, and so are the bytes of
    its questions: rows are clustered by job and the number of files follows from both. Stage tables in a folder of the run's own are
    removed at its end. Returns the job summary (A4): datapoints, rounds, seconds."""
    t0 = time.perf_counter()
    own = cfg.stage_dir is None and _stores(backend, cfg)
    cfg = _with_dir(questions, backend, cfg)
    # Of their bytes only the question's are known: every turn's history holds it, the first one's row twice.
    known = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))) * F.lit(cfg.num_turns + 1)
    counts = questions.groupBy("job_id").agg((F.count(F.lit(1)) * F.lit(cfg.num_turns)).alias("n"), known.alias("bytes"))
    prefs = generate_preferences(questions, backend, cfg)
    obs = Observation(f"generation_job-{uuid.uuid4().hex[:8]}")
    observed = prefs.observe(obs, F.count(F.lit(1)).alias("datapoints"),
                             F.count(F.when(F.col("turn") == 0, F.lit(1))).alias("conversations"),
                             F.sum(F.size("errors")).alias("errors"))
    write_jobs(observed, out_dir, rows_per_file=rows_per_file, counts=counts)
    m = obs.get
    if own:
        remove_path(questions.sparkSession, cfg.stage_dir)
    return {"datapoints": int(m.get("datapoints") or 0), "conversations": int(m.get("conversations") or 0),
            "errors": int(m.get("errors") or 0), "rounds_per_conversation": cfg.num_turns,
            "seconds": round(time.perf_counter() - t0, 3)}
