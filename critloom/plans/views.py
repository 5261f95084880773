"""Training views of the preference table (C5 SFT, C6 preference/reward/GRPO)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import CHATML, chat_template
from ..operators.ranking import exact_split
from .merge import DEFAULT_KEY  # the key that identifies a published row


def with_split(prefs: DataFrame, test_size: float | int = 0.1, seed: int = 42,
               key_cols: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """L1 on the preference table: adds ``split`` (``train``/``test``). The key is the merge key, as
    far as the table has its columns (rows that were never merged have no job)."""
    return exact_split(prefs, [k for k in key_cols if k in prefs.columns], test_size, seed)


def rename_question(df: DataFrame) -> DataFrame:
    """``question`` → ``prompt`` if present (a no-op otherwise)."""
    return df.withColumnRenamed("question", "prompt")


def sft_view(prefs: DataFrame, test_size: float | int = 0.1, seed: int = 42,
             key_cols: Sequence[str] = DEFAULT_KEY, template=CHATML) -> DataFrame:
    """``(split, text)`` with the chat-templated history as the only training column."""
    s = with_split(prefs, test_size, seed, key_cols)
    return rename_question(s).select("split", chat_template("messages", template).alias("text"))


def preference_view(prefs: DataFrame, test_size: float | int = 0.1, seed: int = 42,
                    key_cols: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """The preference table with ``prompt`` and without ``messages`` (P3, P4), plus ``split``."""
    return rename_question(with_split(prefs, test_size, seed, key_cols)).drop("messages")


def train_test(view: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two parts of a split view, without the ``split`` column."""
    return (view.filter(F.col("split") == "train").drop("split"),
            view.filter(F.col("split") == "test").drop("split"))
