"""Pair scoring (C9), group-relative advantage (C10), principle-guided labelling (C11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import Prompt, last_element, message
from ..functions.texts import DEFAULT_KIT, PromptKit
from ..session import stage_table
from .model import Backend, Scorer, generate_text, score
from .ranking import group_rank
from .sampling import pick_index, sample_principle


def gold_pairs(items: DataFrame, texts: DataFrame, label: str = "quality", group: str = "lang",
               order: str = "doc_id", text: str = "text", seed: int | str = 11) -> DataFrame:
    """Pair the i-th good item with the i-th bad item of the same group, one to one.

    ``items`` has the id, group and label (0/1), ``texts`` the id and text. Items are ranked
    within their group by ``md5(seed:id)`` (a seeded shuffle, tie-broken by the id) with the
    skew-safe ``group_rank``. The contract is one-to-one: the surplus of the larger label of a
    group has no partner and is not scored. Ranking and pairing carry ids only; the texts are
    joined to the finished pairs.
    """
    ranked = group_rank(items.filter(F.col(label).isin(0, 1)).select(group, label, order), [group, label], order, seed=seed)
    # Each (group, rank) holds at most one good and one bad item: one aggregation pairs them.
    good, bad = F.col(label) == 1, F.col(label) == 0
    pairs = ranked.groupBy(group, "rank").agg(F.max(F.when(good, F.col(order))).alias("chosen_id"),
                                              F.max(F.when(bad, F.col(order))).alias("rejected_id"))
    pairs = stage_table(pairs.filter(F.col("chosen_id").isNotNull() & F.col("rejected_id").isNotNull()), "gold_pairs")
    for side in ("chosen", "rejected"):
        pairs = pairs.join(texts.select(F.col(order).alias(f"{side}_id"), F.col(text).alias(side)), f"{side}_id")
    return pairs


def pair_rewards(pairs: DataFrame, scorer: Scorer, prompt: str = "prompt") -> DataFrame:
    """Reward of both answers, their margin and whether the chosen one wins."""
    return (pairs.withColumn("reward_chosen", score(F.col(prompt), F.col("chosen"), scorer))
            .withColumn("reward_rejected", score(F.col(prompt), F.col("rejected"), scorer))
            .withColumn("margin", F.col("reward_chosen") - F.col("reward_rejected"))
            .withColumn("correct", F.col("margin") > 0))


def reward_accuracy(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    return scored.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.avg(F.col("correct").cast("double")).alias("accuracy"),
        F.avg("margin").alias("mean_margin"))


def group_advantage(df: DataFrame, group_cols: list[str], reward: str = "reward", eps: float = 1e-4,
                    column: str = "advantage", max_broadcast: int = 100_000, salts: int = 64) -> DataFrame:
    """``(r - mean) / (std + eps)`` over the answers of each prompt (sample std; 0 for one answer).

    Group statistics come from a partial aggregation (one row per group). Their number is
    counted: up to ``max_broadcast`` they are broadcast, beyond that they are joined on the
    group and a salt, so that the rows of a hot group still meet in ``salts`` tasks. ``df`` is
    read twice, so a model-made reward must be materialized first (``session.materialize``).
    """
    stats = stage_table(df.groupBy(*group_cols).agg(F.avg(reward).alias("group_mean"),
                                                    F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("group_std"),
                                                    F.count(F.lit(1)).alias("group_size")), "group_stats")
    if stats.count() <= max_broadcast:
        joined = df.join(F.broadcast(stats), group_cols)
    else:
        spread = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
        joined = df.withColumn("_salt", salt).join(spread, [*group_cols, "_salt"]).drop("_salt")
    return joined.withColumn(column, (F.col(reward) - F.col("group_mean")) / (F.col("group_std") + F.lit(eps)))


# The pairwise question.
PREFERENCE_SYSTEM_PROMPT = "You compare two tutor replies under a stated principle and name the better one."


def preference_prompt(principle: Column, prompt: Column, a: Column, b: Column):
    """The pairwise question as a ``Prompt`` (constant system message, per-row user message)."""
    user = F.concat(principle, F.lit("\n\nQUESTION:\n"), F.coalesce(prompt, F.lit("")),
                    F.lit("\n\n(A) "), F.coalesce(a, F.lit("")), F.lit("\n\n(B) "), F.coalesce(b, F.lit("")),
                    F.lit("\n\nEnd with 'Answer: A' or 'Answer: B'."))
    return Prompt((("system", PREFERENCE_SYSTEM_PROMPT),), F.array(message("user", user)))


VERDICT_PATTERN = r"(?i)answer:\s*\(?([AB])\)?"


def principle_preference(pairs: DataFrame, judge_backend: Backend, seed: int = 0,
                         key_cols: tuple[str, ...] = ("chosen_id", "rejected_id"),
                         prompt: str = "prompt", kit: PromptKit = DEFAULT_KIT) -> DataFrame:
    """C11: per pair, sample a preference principle, show the answers in a seeded order and
    ask the judge which it prefers; ``preferred`` is ``chosen``, ``rejected`` or null."""
    df = (pairs.withColumn("principle", sample_principle(seed, *key_cols, stage="rl", kit=kit).getField("critique"))
          .withColumn("swapped", pick_index(2, f"{seed}:order", *key_cols) == 1))
    a = F.when(F.col("swapped"), F.col("rejected")).otherwise(F.col("chosen"))
    b = F.when(F.col("swapped"), F.col("chosen")).otherwise(F.col("rejected"))
    df = df.withColumn("verdict", generate_text(preference_prompt(F.col("principle"), F.col(prompt), a, b),
                                                judge_backend))
    pick = F.upper(last_element(F.regexp_extract_all("verdict", F.lit(VERDICT_PATTERN), 1)))
    first_is_chosen = ~F.col("swapped")
    return df.withColumn("preferred", F.when(pick == "A", F.when(first_is_chosen, "chosen").otherwise("rejected"))
                         .when(pick == "B", F.when(first_is_chosen, "rejected").otherwise("chosen")))
