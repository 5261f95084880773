"""critloom: preference-data building and judging on Spark DataFrames.

Public functions take and return DataFrames or Columns. Model calls are a pluggable batch
backend evaluated as an Arrow-batched column; everything else is Catalyst.
"""

__version__ = "0.1.0"

from .functions.prompts import (chat_template, critique_prompt, judge_prompt, revision_prompt,  # noqa: E402
                                student_prompt, teacher_prompt, transcript)
from .functions.scoring import extract_score, with_score  # noqa: E402
from .operators.aggregate import best_step, eval_metrics, metrics_record  # noqa: E402
from .operators.history import (assemble_history, history_snapshots, last_by_role, last_reply_pair,  # noqa: E402
                                reply_pairs, unanswered)
from .functions.texts import DEFAULT_KIT, PromptKit  # noqa: E402
from .operators.model import Backend, FunctionBackend, StubModel, generate, generate_map, generate_text  # noqa: E402
from .operators.preference import gold_pairs, group_advantage, pair_rewards, principle_preference  # noqa: E402
from .operators.ranking import assign_jobs, exact_split, group_rank, row_numbers, slice_rows  # noqa: E402
from .plans.evaluate import eval_history, judged_eval  # noqa: E402
from .plans.generate import GenerationConfig, critique_revise, generate_preferences, generation_job  # noqa: E402
from .plans.merge import merge_jobs  # noqa: E402
from .plans.views import preference_view, sft_view  # noqa: E402
from .streaming.evaluate import eval_history_stream  # noqa: E402
from .streaming.merge import incremental_merge, incremental_merge_by_key  # noqa: E402

__all__ = [
    "Backend", "DEFAULT_KIT", "FunctionBackend", "GenerationConfig", "PromptKit", "StubModel",
    "assemble_history", "assign_jobs", "best_step", "chat_template", "critique_prompt", "critique_revise",
    "eval_history", "eval_history_stream", "eval_metrics", "exact_split", "extract_score", "generate",
    "generate_map", "generate_preferences", "generate_text", "generation_job", "gold_pairs", "group_advantage",
    "group_rank", "history_snapshots", "incremental_merge", "incremental_merge_by_key", "judge_prompt",
    "judged_eval", "last_by_role", "last_reply_pair", "merge_jobs", "metrics_record", "pair_rewards", "preference_view",
    "principle_preference", "reply_pairs", "revision_prompt", "row_numbers", "sft_view", "slice_rows", "student_prompt",
    "teacher_prompt", "transcript", "unanswered", "with_score",
]
