"""Input tables (S1, S4, S6) and the question/evaluation views built on them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import texts as X
from ..functions.text import category_or_default
from ..operators.history import first_by_role
from ..schemas import EVAL_EXAMPLES
from ..session import ship_package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)  # model columns built on this table run code from this package
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_split(spark: SparkSession, path: str, split: str | None = "train") -> DataFrame:
    """A dataset and one of its splits. A ``split`` partition column (``…/split=train/``)
    is pruned at the scan; a dataset without one is a single split and is returned whole. A
    published table is such a dataset."""
    df = spark.read.parquet(path)
    if split is not None and "split" in df.columns:
        df = df.filter(F.col("split") == split).drop("split")
    return df


def questions(df: DataFrame, id_col: str = "question_id", text_col: str = "text",
              label_col: str = "label_text") -> DataFrame:
    """``(question_id, text, category)``; ``general`` only if the label column is missing."""
    return df.select(F.col(id_col).cast("bigint").alias("question_id"), F.col(text_col).alias("text"),
                     category_or_default(df, label_col).cast("string").alias("category"))


def questions_from_documents(docs: DataFrame) -> DataFrame:
    """Question table D3 from documents: whole text, language as the label."""
    return docs.select(F.col("doc_id").alias("question_id"), "text", F.col("lang").alias("label_text"))


def questions_from_conversations(conv: DataFrame) -> DataFrame:
    """Question table without a label column: each conversation's first user message."""
    return first_by_role(conv, "user").select(F.col("conv_id").alias("question_id"), "text")


# ---------------------------------------------------------------------------------
# Categories assigned to benchmark items by ``item_id % 7`` (5 named,
# one empty, one missing) so that every branch of the category rule is exercised.
# ---------------------------------------------------------------------------------
BENCHMARK_CATEGORIES = ["conceptual", "math", "science", "technical", "history", "", None]


def eval_examples_from_benchmark(bench: DataFrame) -> DataFrame:
    """D10 from the benchmark table: ``(ord, prompt, reference_answer, category)``."""
    cats = F.array(*[F.lit(c).cast("string") for c in BENCHMARK_CATEGORIES])
    return bench.select(
        F.col("item_id").cast("bigint").alias("ord"), F.col("text").alias("prompt"),
        F.lit(None).cast("string").alias("reference_answer"),
        F.element_at(cats, (F.pmod(F.col("item_id"), F.lit(len(BENCHMARK_CATEGORIES))) + 1).cast("int"))
        .alias("category"),
    )


def default_eval_examples(spark: SparkSession, kit: X.PromptKit = X.DEFAULT_KIT) -> DataFrame:
    """The evaluation questions of a kit."""
    rows = [(i, p, None, c) for i, (p, c) in enumerate(kit.examples)]
    return spark.createDataFrame(rows, EVAL_EXAMPLES)
