"""The registered queries: one per operator group, each over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame whose columns are scalar (arrays
and structs are emitted as text or md5) so that results compare across engines.
Model stages use the deterministic stubs through the real Arrow UDF path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import prompts as P
from .functions.scoring import with_score
from .functions.text import content_id, default_if_empty, length_flags, reply_text, strip_echo, truncate_pairs
from .functions.texts import DEFAULT_KIT
from .operators.aggregate import best_step as best_step_op
from .operators.aggregate import rounded
from .operators.history import assemble_history, first_by_role, history_snapshots, last_message, last_reply_pair, reply_pairs
from .operators.history import unanswered as unanswered_op
from .operators.model import (AsyncStubJudge, StubEchoModel, StubJudge, StubModel, StubScorer, StubVerdict, generate_text, score,
                              token_count)
from .operators.preference import gold_pairs, group_advantage as group_advantage_op
from .operators.preference import pair_rewards, principle_preference as principle_preference_op
from .operators.preference import reward_accuracy
from .operators.ranking import assign_jobs, exact_split, slice_rows
from .operators.sampling import pick_index, sample_principle as sample_principle_op
from .plans.evaluate import details_record, eval_history as eval_history_plan, judged_eval as judged_eval_plan
from .plans.evaluate import record_blocks, with_answers
from .plans.generate import GenerationConfig, critique_revise as critique_revise_op
from .plans.generate import generate_preferences, generation_job as generation_job_plan
from .plans.merge import merge_jobs as merge_jobs_plan
from .plans.views import preference_view as preference_view_op
from .plans.views import sft_view as sft_view_op
from .schemas import PREFERENCES
from .session import scratch_path, stage_table
from .sources.jobs import write_job, write_jobs
from .sources.published import read_published
from .sources.tables import (default_eval_examples, eval_examples_from_benchmark, questions, questions_from_conversations,
                             questions_from_documents, read_split, read_table)
from .streaming.evaluate import eval_history_stream
from .streaming.merge import incremental_merge as incremental_merge_stream
from .streaming.merge import incremental_merge_by_key, read_merged

MODEL = StubModel()
JUDGE = StubJudge()
SERVICE_JUDGE = AsyncStubJudge()
ECHO = StubEchoModel()
VERDICT = StubVerdict()
SCORER = StubScorer()

# ---------------------------------------------------------------------------------
# Query parameters shared with the SQL oracles.
# ---------------------------------------------------------------------------------
SLICE_START, SLICE_LENGTH = 100, 250
SPLIT_SEED, SPLIT_TEST_SIZE = 42, 0.1
GEN_SEED = 7
FLAGSHIP_ROUNDS = 2
MULTI_TURNS, MULTI_ROUNDS = 3, 2
CHAIN_ROUNDS = 3
JOBS = 3
EVAL_STEPS = [200, 400, 600]
RECORD_BLOCK = 16
FIRST_EXAMPLES = 25
PAIR_PROMPT = "Write a short passage in the language with code "
PAIR_SEED = 11
SAMPLE_ROUNDS = 3
# ---------------------------------------------------------------------------------

SEP = "\x1f"


def _digest(arr: Column) -> Column:
    """md5 of a string array joined by the unit separator."""
    return F.md5(F.array_join(F.transform(arr, lambda x: F.coalesce(x, F.lit(""))), SEP))


def _pref_out(df: DataFrame, *extra: Column) -> DataFrame:
    """Scalar projection of preference rows."""
    return df.select(
        "question_id", F.col("turn").cast("bigint").alias("turn"), "conversation_id", "category", "question",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.md5(P.chat_template("messages")).alias("messages_md5"),
        "initial_response",
        _digest(F.col("critique_requests")).alias("critique_requests_md5"),
        _digest(F.col("critiques")).alias("critiques_md5"),
        _digest(F.col("revision_requests")).alias("revision_requests_md5"),
        _digest(F.col("revisions")).alias("revisions_md5"),
        F.size("revisions").cast("bigint").alias("n_revisions"),
        "chosen", "rejected", *extra,
    )


# ---- sources, projections, ids -------------------------------------------------------------

def slice_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Rows [start, start+length) of the question table in id order."""
    qs = questions(questions_from_documents(read_table(spark, sf, "documents")))
    return slice_rows(qs, "question_id", SLICE_START, SLICE_LENGTH)


def question_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """A question table without a label column gets the default category."""
    return questions(questions_from_conversations(read_table(spark, sf, "conversations")))


def conversation_ids(spark: SparkSession, sf: str) -> DataFrame:
    """content ids of the question texts (equal texts share an id)."""
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", content_id("text").alias("conversation_id"))


# ---- histories -------------------------------------------------------------------------------

def assemble_history_q(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered history per conversation."""
    h = assemble_history(read_table(spark, sf, "conversations"))
    return h.select("conv_id", "n_messages",
                    F.element_at("messages", 1).getField("role").alias("first_role"),
                    F.element_at("messages", -1).getField("role").alias("last_role"),
                    F.md5(P.chat_template("messages")).alias("template_md5"))


def history_snapshots_q(spark: SparkSession, sf: str) -> DataFrame:
    """History up to and including each message."""
    s = history_snapshots(read_table(spark, sf, "conversations"))
    return s.select("conv_id", "position", F.size("messages").cast("bigint").alias("n_messages"),
                    F.md5(P.chat_template("messages")).alias("snapshot_md5"))


# ---- prompt rendering -----------------------------------------------------------------------

def teacher_prompt_q(spark: SparkSession, sf: str) -> DataFrame:
    """F1 (+F11): the teacher prompt over each history."""
    h = assemble_history(read_table(spark, sf, "conversations"))
    tp = P.teacher_prompt("messages")
    return h.select("conv_id", F.size(tp).cast("bigint").alias("n_messages"),
                    F.md5(P.chat_template(tp)).alias("prompt_md5"))


def _answered(spark: SparkSession, sf: str) -> DataFrame:
    """``(conv_id, turn, prompt, response)``: the latest reply of each conversation that answers a
    user message, with that message."""
    return last_reply_pair(read_table(spark, sf, "conversations"))


def critique_prompt_q(spark: SparkSession, sf: str) -> DataFrame:
    """Critique prompt from the latest answered message and its reply."""
    lt = _answered(spark, sf).withColumn("_p", sample_principle_op(GEN_SEED, "conv_id"))
    hist = F.array(P.message("user", F.col("prompt")))
    cp = P.critique_prompt(hist, F.col("response"), F.col("_p.critique"))
    return lt.select("conv_id", F.size(cp).cast("bigint").alias("n_messages"),
                     F.element_at(cp, -1).getField("content").alias("user_text"),
                     F.md5(P.chat_template(cp)).alias("prompt_md5"))


def revision_prompt_q(spark: SparkSession, sf: str) -> DataFrame:
    """revision prompt; the critique slot holds the first user message."""
    first = first_by_role(read_table(spark, sf, "conversations"), "user").select("conv_id", F.col("text").alias("first_user"))
    lt = _answered(spark, sf).join(first, "conv_id").withColumn("_p", sample_principle_op(GEN_SEED, "conv_id"))
    hist = F.array(P.message("user", F.col("prompt")))
    rp = P.revision_prompt(hist, F.col("response"), F.col("_p.critique"), F.col("first_user"), F.col("_p.revision"))
    return lt.select("conv_id", F.size(rp).cast("bigint").alias("n_messages"),
                     F.element_at(rp, -1).getField("content").alias("user_text"),
                     F.md5(P.chat_template(rp)).alias("prompt_md5"))


def unanswered_q(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations that the flagship leaves out: no reply in them answers a user message."""
    return unanswered_op(read_table(spark, sf, "conversations"))


def student_prompt_q(spark: SparkSession, sf: str) -> DataFrame:
    """Transcript and student prompt of each history."""
    h = assemble_history(read_table(spark, sf, "conversations"))
    sp = P.student_prompt("messages")
    return h.select("conv_id", P.transcript("messages").alias("transcript"),
                    F.size(sp).cast("bigint").alias("n_messages"), F.md5(P.chat_template(sp)).alias("prompt_md5"))


def reply_extract(spark: SparkSession, sf: str) -> DataFrame:
    """The assistant reply ending a history, else '' (and the student default).

    Only the last message is needed, so it is found with a partial ``max_by`` aggregation
    instead of assembling whole histories.
    """
    lm = last_message(read_table(spark, sf, "conversations"))
    r = reply_text(F.array(F.col("last_message")))
    return lm.select("conv_id", r.alias("reply"), default_if_empty(r).alias("reply_or_default"))


def sample_principle_q(spark: SparkSession, sf: str) -> DataFrame:
    """Seeded principle picks per conversation and round, both stages."""
    ids = read_table(spark, sf, "conversations").select("conv_id").distinct()
    df = ids.select("conv_id", F.explode(F.sequence(F.lit(0), F.lit(SAMPLE_ROUNDS - 1))).alias("round"))
    sl = sample_principle_op(GEN_SEED, "conv_id", "round")
    rl = sample_principle_op(GEN_SEED, "conv_id", "round", stage="rl")
    return df.select("conv_id", F.col("round").cast("bigint").alias("round"),
                     pick_index(len(DEFAULT_KIT.principles), GEN_SEED, "conv_id", "round").alias("sl_index"),
                     sl.getField("critique").alias("critique"), sl.getField("revision").alias("revision"),
                     rl.getField("critique").alias("rl_principle"))


# ---- model stages and generation -----------------------------------------------------------

def generate_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The model column over teacher prompts of every history."""
    h = assemble_history(read_table(spark, sf, "conversations"))
    return h.select("conv_id", generate_text(P.teacher_prompt_parts("messages"), MODEL).alias("reply"))


def critique_revise(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship, C1/U4/U5 + L1: the latest reply that answers a user message → critique → rewrite →
    preference pair (prompt = that message, rejected = that reply) + split.

    The split depends on the key only, so it is decided before any model call. Conversations
    without such a reply are listed by ``unanswered``.
    """
    lt = _answered(spark, sf).select(F.col("conv_id").alias("question_id"), "prompt", F.col("response").alias("initial_response"))
    lt = stage_table(lt, "answered")  # small rows, read twice for the split
    lt = exact_split(lt, ["question_id"], SPLIT_TEST_SIZE, SPLIT_SEED)
    lt = lt.withColumn("_hist", F.array(P.message("user", F.col("prompt"))))
    cfg = GenerationConfig(num_revisions=FLAGSHIP_ROUNDS, seed=GEN_SEED)
    out = critique_revise_op(lt, "_hist", "initial_response", MODEL, cfg)
    return out.select(
        "question_id", "prompt", F.col("revised_response").alias("chosen"),
        F.col("initial_response").alias("rejected"),
        _digest(F.col("critique_requests")).alias("critique_requests_md5"),
        _digest(F.col("critiques")).alias("critiques_md5"),
        _digest(F.col("revisions")).alias("revisions_md5"), "split")


def turn_critiques(spark: SparkSession, sf: str) -> DataFrame:
    """C1 over logged conversations: every assistant reply is critiqued and rewritten under a
    principle picked per (conversation, turn); the rewrite is ``chosen``, the reply ``rejected``."""
    pairs = reply_pairs(read_table(spark, sf, "conversations"))
    pairs = pairs.withColumn("_hist", F.array(P.message("user", F.col("prompt"))))
    cfg = GenerationConfig(num_revisions=1, seed=GEN_SEED)
    out = critique_revise_op(pairs, "_hist", "response", MODEL, cfg, key_cols=("conv_id", "turn"))
    return out.select("conv_id", "turn", "prompt", F.col("revised_response").alias("chosen"),
                      F.col("response").alias("rejected"), _digest(F.col("critique_requests")).alias("critique_requests_md5"),
                      _digest(F.col("critiques")).alias("critiques_md5"))


def _conversation_questions(spark: SparkSession, sf: str) -> DataFrame:
    return questions(questions_from_conversations(read_table(spark, sf, "conversations")))


def multi_turn(spark: SparkSession, sf: str) -> DataFrame:
    """Three turns with two critique rounds each, one row per turn."""
    cfg = GenerationConfig(num_turns=MULTI_TURNS, num_revisions=MULTI_ROUNDS, seed=GEN_SEED)
    return _pref_out(generate_preferences(_conversation_questions(spark, sf), MODEL, cfg))


def chained_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """C1 with ``chain=True``: each of three rounds critiques the previous rewrite."""
    cfg = GenerationConfig(num_revisions=CHAIN_ROUNDS, seed=GEN_SEED, chain=True)
    return _pref_out(generate_preferences(_conversation_questions(spark, sf), MODEL, cfg))


def _generated(spark: SparkSession, sf: str) -> tuple[str, dict]:
    """Three job slices of all documents, generated and written; their folder and the job summary."""
    qs = questions(questions_from_documents(read_table(spark, sf, "documents")))
    jobs = assign_jobs(qs, "question_id", max(1, -(-qs.count() // JOBS)))
    out = scratch_path(spark, "generation")
    return out, generation_job_plan(jobs, out, MODEL, GenerationConfig(seed=GEN_SEED))


def generation_job(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in three job slices, written per job and read back."""
    written = spark.read.parquet(_generated(spark, sf)[0])
    return _pref_out(written, F.col("job_id").cast("bigint").alias("job_id"))


def generation_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A4: the summary of that run (observed on the write), without its seconds."""
    s = _generated(spark, sf)[1]
    names = ["datapoints", "conversations", "errors", "rounds_per_conversation"]
    return spark.createDataFrame([tuple(s[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def _job_rows(docs: DataFrame) -> DataFrame:
    """Preference-shaped rows derived from documents, cut into ``JOBS`` contiguous id ranges
    of equal size (the job slices); used as job outputs to merge."""
    sliced = assign_jobs(docs, "doc_id", max(1, -(-docs.count() // JOBS)))
    return sliced.select(
        F.col("doc_id").alias("question_id"), F.lit(0).alias("turn"), content_id("text").alias("conversation_id"),
        F.col("text").alias("question"), F.lit(None).cast(PREFERENCES["messages"].dataType).alias("messages"),
        F.col("lang").alias("category"), F.md5("text").alias("initial_response"),
        *[F.array().cast("array<string>").alias(c) for c in
          ("critique_requests", "critiques", "revision_requests", "revisions")],
        F.col("text").alias("chosen"), F.md5("text").alias("rejected"), F.col("job_id").cast("int").alias("job_id"))


def _merge_out(df: DataFrame) -> DataFrame:
    return df.select("question_id", F.col("turn").cast("bigint").alias("turn"), "category", "chosen",
                     "rejected", F.col("job_id").cast("bigint").alias("job_id"))


def _merged_twice(spark: SparkSession, sf: str) -> tuple[str, list[dict]]:
    rows = _job_rows(read_table(spark, sf, "documents"))
    jobs_root, target = scratch_path(spark, "jobs"), scratch_path(spark, "published")
    write_jobs(rows, jobs_root)
    return target, [merge_jobs_plan(spark, jobs_root, target, PREFERENCES) for _ in range(2)]  # the re-run adds nothing


def merge_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Three job outputs merged twice (idempotent) into the table."""
    return _merge_out(read_published(spark, _merged_twice(spark, sf)[0], PREFERENCES))


def merge_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A5: rows loaded and written per job, for the merge and its re-run."""
    runs = [s["per_job"].select(F.lit(i).cast("bigint").alias("run"), F.col("job_id").cast("bigint").alias("job_id"), "loaded", "written")
            for i, s in enumerate(_merged_twice(spark, sf)[1])]
    return runs[0].unionByName(runs[1])


def incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs land one after another; each is appended exactly once by the stream."""
    rows = _job_rows(read_table(spark, sf, "documents"))
    jobs_root, target, ckpt = (scratch_path(spark, "jobs"), scratch_path(spark, "merged"),
                               scratch_path(spark, "merge-ckpt"))
    for j in range(JOBS):
        write_job(rows.filter(F.col("job_id") == j).drop("job_id"), jobs_root, j)
        incremental_merge_stream(spark, jobs_root, target, ckpt, PREFERENCES)
    incremental_merge_stream(spark, jobs_root, target, ckpt, PREFERENCES)  # nothing new
    return _merge_out(read_merged(spark, target, PREFERENCES))


def incremental_merge_keys(spark: SparkSession, sf: str) -> DataFrame:
    """X1 by key: jobs land one after another and job 0 is generated twice; each row key is
    published exactly once."""
    rows = _job_rows(read_table(spark, sf, "documents"))
    jobs_root, target, ckpt = (scratch_path(spark, "jobs"), scratch_path(spark, "published"),
                               scratch_path(spark, "merge-ckpt"))
    for j in range(JOBS):
        write_job(rows.filter(F.col("job_id") == j).drop("job_id"), jobs_root, j)
        if j == 1:
            write_job(rows.filter(F.col("job_id") == 0).drop("job_id"), jobs_root, 0)  # job 0 again
        incremental_merge_by_key(spark, jobs_root, target, ckpt, PREFERENCES)
    return _merge_out(read_published(spark, target, PREFERENCES))


# ---- split and training views ---------------------------------------------------------------

def split_exact(spark: SparkSession, sf: str) -> DataFrame:
    """L1: exact seeded 10 % test split of the documents."""
    d = read_table(spark, sf, "documents").select("doc_id")
    return exact_split(d, ["doc_id"], SPLIT_TEST_SIZE, SPLIT_SEED)


def _preferences(spark: SparkSession, sf: str) -> DataFrame:
    """A preference table of one turn per conversation, stored once."""
    return stage_table(generate_preferences(_conversation_questions(spark, sf), MODEL, GenerationConfig(seed=GEN_SEED)), "preferences")


def published_view(spark: SparkSession, sf: str) -> DataFrame:
    """Two turns per conversation in three job slices, merged, loaded from the published table and
    split on the merge key."""
    qs = _conversation_questions(spark, sf)
    jobs = assign_jobs(qs, "question_id", max(1, -(-qs.count() // JOBS)))
    jobs_root, target = scratch_path(spark, "jobs"), scratch_path(spark, "published")
    generation_job_plan(jobs, jobs_root, MODEL, GenerationConfig(num_turns=2, seed=GEN_SEED))
    merge_jobs_plan(spark, jobs_root, target, PREFERENCES)
    v = preference_view_op(read_split(spark, target), SPLIT_TEST_SIZE, SPLIT_SEED)
    return v.select("question_id", F.col("turn").cast("bigint").alias("turn"), F.col("job_id").cast("bigint").alias("job_id"),
                    "prompt", "chosen", "rejected", "category", "split")


def sft_view(spark: SparkSession, sf: str) -> DataFrame:
    """Templated training text with its split."""
    v = sft_view_op(_preferences(spark, sf), SPLIT_TEST_SIZE, SPLIT_SEED)
    return v.select("split", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n_chars"))


def preference_view(spark: SparkSession, sf: str) -> DataFrame:
    """prompt/chosen/rejected view with its split."""
    v = preference_view_op(_preferences(spark, sf), SPLIT_TEST_SIZE, SPLIT_SEED)
    return v.select("question_id", F.col("turn").cast("bigint").alias("turn"), "prompt", "chosen", "rejected",
                    "category", "split")


def length_caps(spark: SparkSession, sf: str) -> DataFrame:
    """word counts of prompt and answers and whether the pair fits 512/256."""
    v = preference_view_op(_preferences(spark, sf), SPLIT_TEST_SIZE, SPLIT_SEED)
    np_, nc, nr, fits = length_flags(F.col("prompt"), F.col("chosen"), F.col("rejected"))
    return v.select("question_id", np_.cast("bigint").alias("prompt_words"),
                    nc.cast("bigint").alias("chosen_words"), nr.cast("bigint").alias("rejected_words"),
                    fits.alias("fits"))


def truncated_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """gold pairs, the bad text part of the prompt, cut to 512 words (prompt 256)."""
    p = _pairs(spark, sf).withColumn("prompt", F.concat("prompt", F.lit("\n\n"), "rejected"))
    return truncate_pairs(p).select("lang", "rank", "chosen_id", "rejected_id", "prompt", "chosen", "rejected", "n_tokens", "cut")


def _all_texts(spark: SparkSession, sf: str) -> DataFrame:
    """``(src, id, turn, text)``: every document and every message (its conversation and turn)."""
    d = read_table(spark, sf, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"),
                                                  F.lit(None).cast("bigint").alias("turn"), "text")
    c = read_table(spark, sf, "conversations").select(F.lit("conversations").alias("src"), F.col("conv_id").alias("id"), "turn", "text")
    return d.unionByName(c)


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """token counts of every document and message (whitespace words, the default counter)."""
    return _all_texts(spark, sf).select("src", "id", "turn", token_count(F.col("text")).alias("tokens"))


# ---- evaluation ---------------------------------------------------------------------------

def _examples(spark: SparkSession, sf: str) -> DataFrame:
    return eval_examples_from_benchmark(read_table(spark, sf, "benchmark"))


def strip_echo_q(spark: SparkSession, sf: str) -> DataFrame:
    """Raw completions with the echoed prompt removed."""
    ex = _examples(spark, sf)
    raw = generate_text(F.array(P.message("user", F.col("prompt"))), ECHO)
    return ex.select("ord", raw.alias("raw"), strip_echo(raw, F.col("prompt")).alias("response"))


def default_examples(spark: SparkSession, sf: str) -> DataFrame:
    """A kit's evaluation questions, with the number of documents and messages that share a word with each."""
    ex = default_eval_examples(spark)
    words = F.array_distinct(F.split(F.lower("prompt"), "[^\\p{L}]+"))
    asked = ex.select("ord", "prompt", "category", F.explode(F.filter(words, lambda w: F.length(w) > 3)).alias("word"))
    said = _all_texts(spark, sf).select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^\\p{L}]+"))).alias("word"))
    counts = said.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return (asked.join(counts, "word", "left").groupBy("ord", "prompt", "category")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("uses")).withColumn("ord", F.col("ord").cast("bigint")))


def judge_prompt_q(spark: SparkSession, sf: str) -> DataFrame:
    """judge prompt over each example and its answer."""
    ex = with_answers(_examples(spark, sf), ECHO)
    jp = P.judge_prompt("prompt", "response")
    return ex.select("ord", F.size(jp).cast("bigint").alias("n_messages"),
                     F.element_at(jp, -1).getField("content").alias("user_text"))


def extract_score_q(spark: SparkSession, sf: str) -> DataFrame:
    """score parsing over every document and message text."""
    return with_score(_all_texts(spark, sf), "text").select("src", "id", "turn", "score", "score_source")


def judged_eval(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of one judged evaluation."""
    metrics, _ = judged_eval_plan(_examples(spark, sf), ECHO, JUDGE, num_examples=None, step=0)
    return rounded(metrics, ["value"])


def first_examples_eval(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluation of the first ``FIRST_EXAMPLES`` examples, as detail rows."""
    _, details = judged_eval_plan(_examples(spark, sf), ECHO, JUDGE, num_examples=FIRST_EXAMPLES, step=0)
    return details.select("ord", "prompt", "category", "response", "judgment", "score")


def service_judgments(spark: SparkSession, sf: str) -> DataFrame:
    """Every example judged through a window of bounded calls, as detail rows."""
    _, details = judged_eval_plan(_examples(spark, sf), ECHO, SERVICE_JUDGE, num_examples=None, step=0)
    return details.select("ord", "prompt", "category", "response", "judgment", "judge_error", "score")


def _step_answers(spark: SparkSession, sf: str) -> DataFrame:
    ex = _examples(spark, sf).withColumn("step", F.explode(F.array(*[F.lit(s).cast("bigint") for s in EVAL_STEPS])))
    ctx = P.message("system", F.concat(F.lit("checkpoint "), F.col("step").cast("string")))
    return with_answers(ex, ECHO, ctx).select("step", "ord", "prompt", "category", "response", "answer_error")


def _history(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return eval_history_plan(_step_answers(spark, sf), JUDGE, scratch_path(spark, "details"), scratch_path(spark, "metrics"))


def eval_history(spark: SparkSession, sf: str) -> DataFrame:
    """Judge every step's answers in one job, add details and metrics."""
    return rounded(_history(spark, sf)[0], ["value"])


def eval_details(spark: SparkSession, sf: str) -> DataFrame:
    """The detail rows of every step."""
    return _history(spark, sf)[1].select("step", "ord", "category", "response", "judgment", "score")


def _record_digests(r: DataFrame, *by: str) -> DataFrame:
    return r.select(*by, F.size("prompts").cast("bigint").alias("n"), _digest(F.col("prompts")).alias("prompts_md5"),
                    _digest(F.col("responses")).alias("responses_md5"), _digest(F.col("judgments")).alias("judgments_md5"),
                    F.array_join(F.transform("scores", lambda x: x.cast("int").cast("string")), ",").alias("scores"))


def eval_records(spark: SparkSession, sf: str) -> DataFrame:
    """The record of every step: parallel lists in example order."""
    return _record_digests(details_record(_history(spark, sf)[1]), "step")


def eval_record_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The records of every step in blocks of ``RECORD_BLOCK`` examples."""
    return _record_digests(record_blocks(_history(spark, sf)[1], block_rows=RECORD_BLOCK), "step", "block")


def eval_stream(spark: SparkSession, sf: str) -> DataFrame:
    """C8 as a stream: the answers land as one directory per step and are judged on arrival."""
    root, det, met, ck = (scratch_path(spark, n) for n in ("answers", "details", "metrics", "eval-ckpt"))
    _step_answers(spark, sf).withColumn("commit", F.col("step")).write.partitionBy("commit").parquet(root)
    for _ in range(2):  # the second run finds nothing new
        eval_history_stream(spark, root, JUDGE, det, met, ck)
    return rounded(spark.read.parquet(met).select(F.col("step").cast("bigint").alias("step"), "category", "metric",
                                                  "value"), ["value"])


def best_step(spark: SparkSession, sf: str) -> DataFrame:
    """The step with the best mean score (ties to the lowest step)."""
    metrics, _ = eval_history_plan(_step_answers(spark, sf), JUDGE)
    return rounded(best_step_op(metrics), ["best_value"]).withColumn("n_steps", F.col("n_steps").cast("bigint"))


# ---- preference re-aims ----------------------------------------------------------------------

def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    d, lab = read_table(spark, sf, "documents"), read_table(spark, sf, "labels").select("doc_id", "quality")
    p = gold_pairs(d.select("doc_id", "lang").join(lab, "doc_id"), d.select("doc_id", "text"), seed=PAIR_SEED)
    return p.withColumn("prompt", F.concat(F.lit(PAIR_PROMPT), F.col("lang")))


def pair_reward(spark: SparkSession, sf: str) -> DataFrame:
    """Reward of gold chosen/rejected pairs and whether the chosen wins."""
    s = pair_rewards(_pairs(spark, sf), SCORER)
    return rounded(s.select("lang", "rank", "chosen_id", "rejected_id", "reward_chosen", "reward_rejected",
                            "margin", "correct"), ["reward_chosen", "reward_rejected", "margin"])


def reward_accuracy_q(spark: SparkSession, sf: str) -> DataFrame:
    """C9 summary: per language, how often the reward prefers the gold chosen answer."""
    s = reward_accuracy(pair_rewards(_pairs(spark, sf), SCORER), ["lang"])
    return rounded(s.withColumn("n_pairs", F.col("n_pairs").cast("bigint")), ["accuracy", "mean_margin"])


def group_advantage(spark: SparkSession, sf: str) -> DataFrame:
    """Group-relative advantage of documents' rewards within their source."""
    d = read_table(spark, sf, "documents").select("doc_id", "source", "text")
    d = stage_table(d.select("doc_id", "source", score(F.col("source"), F.col("text"), SCORER).alias("reward")), "rewards")
    a = group_advantage_op(d, ["source"])
    return rounded(a.select("doc_id", "source", "reward", "group_mean", "group_std",
                            F.col("group_size").cast("bigint").alias("group_size"), "advantage"),
                   ["reward", "group_mean", "group_std", "advantage"])


def principle_preference(spark: SparkSession, sf: str) -> DataFrame:
    """C11: a sampled preference principle per pair and the judge's pick."""
    p = principle_preference_op(_pairs(spark, sf), VERDICT, seed=GEN_SEED)
    return p.select("lang", "rank", "chosen_id", "rejected_id", "principle", "swapped", "verdict", "preferred")


QUERIES = {
    "critique_revise": critique_revise,
    "unanswered": unanswered_q,
    "turn_critiques": turn_critiques,
    "slice_questions": slice_questions,
    "question_defaults": question_defaults,
    "conversation_ids": conversation_ids,
    "assemble_history": assemble_history_q,
    "history_snapshots": history_snapshots_q,
    "teacher_prompt": teacher_prompt_q,
    "critique_prompt": critique_prompt_q,
    "revision_prompt": revision_prompt_q,
    "student_prompt": student_prompt_q,
    "sample_principle": sample_principle_q,
    "reply_extract": reply_extract,
    "generate_batch": generate_batch,
    "multi_turn": multi_turn,
    "chained_rounds": chained_rounds,
    "generation_job": generation_job,
    "generation_summary": generation_summary,
    "merge_jobs": merge_jobs,
    "merge_summary": merge_summary,
    "incremental_merge": incremental_merge,
    "incremental_merge_keys": incremental_merge_keys,
    "split_exact": split_exact,
    "sft_view": sft_view,
    "preference_view": preference_view,
    "published_view": published_view,
    "length_caps": length_caps,
    "token_counts": token_counts,
    "truncated_pairs": truncated_pairs,
    "strip_echo": strip_echo_q,
    "judge_prompt": judge_prompt_q,
    "extract_score": extract_score_q,
    "default_examples": default_examples,
    "judged_eval": judged_eval,
    "first_examples_eval": first_examples_eval,
    "service_judgments": service_judgments,
    "eval_history": eval_history,
    "eval_details": eval_details,
    "eval_records": eval_records,
    "eval_record_blocks": eval_record_blocks,
    "eval_stream": eval_stream,
    "best_step": best_step,
    "pair_reward": pair_reward,
    "reward_accuracy": reward_accuracy_q,
    "group_advantage": group_advantage,
    "principle_preference": principle_preference,
}
