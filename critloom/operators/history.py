"""Conversation histories from message rows (A7, W1) and last-message lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .ranking import row_numbers


def assemble_history(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                     role: str = "role", content: str = "text") -> DataFrame:
    """One ordered ``array<struct<role,content>>`` per conversation.

    The array is the operator's output, so a conversation is necessarily assembled in one
    task; partial aggregation (``collect_list``) keeps the shuffle to one row per message.
    """
    entries = F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(content).alias("content"))
    return (
        turns.groupBy(key)
        .agg(F.sort_array(F.collect_list(entries)).alias("_h"))
        .select(
            key,
            F.transform("_h", lambda m: F.struct(m.getField("role").alias("role"),
                                                 m.getField("content").alias("content"))).alias("messages"),
            F.size("_h").cast("bigint").alias("n_messages"),
        )
    )


def history_snapshots(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                      role: str = "role", content: str = "text") -> DataFrame:
    """For every message row, the history up to and including it.

    Assembled once per conversation (A7) and cut with ``slice`` — one shuffle instead of a
    running ``collect_list`` window per row.
    """
    h = assemble_history(turns, key, order, role, content)
    return (
        h.select(key, "messages", F.explode(F.sequence(F.lit(1), F.size("messages"))).alias("_k"))
        .select(key, (F.col("_k") - 1).cast("bigint").alias("position"),
                F.slice("messages", 1, F.col("_k")).alias("messages"))
    )


def last_by_role(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                 content: str = "text", roles: tuple[str, ...] = ("user", "assistant"),
                 first_roles: tuple[str, ...] = ()) -> DataFrame:
    """The last message of each role (and the first of ``first_roles``) per conversation,
    without assembling the history.

    ``max_by`` aggregates partially on the map side, so a conversation with very many
    messages never has to meet in one task.
    """
    aggs: list[Column] = [F.max(order).alias("last_turn"), F.count(F.lit(1)).alias("n_messages")]
    for r in roles:
        hit = F.col(role) == r
        aggs.append(F.max_by(F.when(hit, F.coalesce(F.col(content), F.lit(""))),
                             F.when(hit, F.col(order))).alias(f"last_{r}"))
        aggs.append(F.max(F.when(hit, F.col(order))).alias(f"last_{r}_turn"))
    for r in first_roles:
        hit = F.col(role) == r
        aggs.append(F.min_by(F.when(hit, F.coalesce(F.col(content), F.lit(""))),
                             F.when(hit, F.col(order))).alias(f"first_{r}"))
    return turns.groupBy(key).agg(*aggs)


def last_message(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                 content: str = "text") -> DataFrame:
    """The last message of each conversation as ``struct<role, content>`` (partial aggregation)."""
    m = F.struct(F.col(role).alias("role"), F.col(content).alias("content"))
    return turns.groupBy(key).agg(F.max_by(m, F.col(order)).alias("last_message"),
                                  F.count(F.lit(1)).alias("n_messages"))


def first_by_role(turns: DataFrame, role_value: str = "user", key: str = "conv_id", order: str = "turn",
                  role: str = "role", content: str = "text") -> DataFrame:
    """The first message of a given role per conversation (partial aggregation)."""
    hit = F.col(role) == role_value
    return (turns.filter(hit).groupBy(key)
            .agg(F.min_by(F.coalesce(F.col(content), F.lit("")), F.col(order)).alias("text"),
                 F.min(order).alias("turn")))


def reply_pairs(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                content: str = "text") -> DataFrame:
    """Every assistant message with the user message right before it in its conversation:
    ``(key, turn, prompt, response)``.

    The message before is the one with the next lower turn, whatever the gap. All messages are
    numbered by (key, turn) and joined on that number, rather than by a ``lag`` window
    partitioned by conversation, so a conversation holding a third of all messages is spread
    over the join's partitions instead of one task. Only keys and hashes of texts are numbered and
    stored; each text is moved once, to its finished pair. Messages that share a turn are taken in the
    order of their roles and text hashes. Replies not preceded by a user message
    are left out (they answer nothing; see ``unanswered``).
    """
    return _with_texts(_pair_ids(turns, key, order, role, content), turns, key, order, role, content)


def _named(turns: DataFrame, key: str, order: str, role: str, content: str) -> DataFrame:
    """Key, turn and role of each message and a hash of its text (md5: equal for equal texts only)."""
    return turns.select(F.col(key).alias("_k"), F.col(order).alias("_t"), F.col(role).alias("_r"),
                        F.md5(F.coalesce(F.col(content), F.lit(""))).alias("_h"))


def _pair_ids(turns: DataFrame, key: str, order: str, role: str, content: str) -> DataFrame:
    """Replies and the user messages right before them: key, both turns and text hashes, and the reply's number."""
    rows = row_numbers(_named(turns, key, order, role, content), [F.col(c) for c in ("_k", "_t", "_r", "_h")], "_pos")
    replies = rows.filter(F.col("_r") == "assistant").select("_k", "_t", "_h", (F.col("_pos") - 1).alias("_pos"))
    asks = rows.filter(F.col("_r") == "user").select(F.col("_k").alias("_ak"), F.col("_t").alias("_at"), F.col("_h").alias("_ah"), "_pos")
    return replies.join(asks, "_pos").filter(F.col("_k").eqNullSafe(F.col("_ak"))).drop("_ak")


def _with_texts(pairs: DataFrame, turns: DataFrame, key: str, order: str, role: str, content: str) -> DataFrame:
    """``(key, turn, prompt, response)`` of numbered pairs."""
    texts = turns.select(F.col(key).alias("_tk"), F.col(order).alias("_tt"), F.col(role).alias("_tr"),
                         F.coalesce(F.col(content), F.lit("")).alias("_text")).withColumn("_th", F.md5("_text"))

    def put(df: DataFrame, who: str, turn: str, text_hash: str, name: str) -> DataFrame:
        said = texts.filter(F.col("_tr") == who)
        same = F.col("_k").eqNullSafe(F.col("_tk")) & F.col(turn).eqNullSafe(F.col("_tt")) & (F.col(text_hash) == F.col("_th"))
        # Equal messages have equal texts: one of them is enough, and each pair keeps its own row.
        return (df.join(said.dropDuplicates(["_tk", "_tt", "_th"]), same).withColumnRenamed("_text", name)
                .drop("_tk", "_tt", "_tr", "_th"))

    done = put(put(pairs, "assistant", "_t", "_h", "response"), "user", "_at", "_ah", "prompt")
    return done.select(F.col("_k").alias(key), F.col("_t").alias("turn"), "prompt", "response")


def last_reply_pair(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                    content: str = "text") -> DataFrame:
    """Per conversation the latest reply that answers a user message: ``(key, turn, prompt, response)``.

    The reply is found with a hash aggregate on row numbers, and texts are joined to the pairs found only.
    Conversations without such a reply are not in the
    result (``unanswered`` lists them).
    """
    pairs = stage_table(_pair_ids(turns, key, order, role, content), "reply_pairs")
    last = pairs.join(pairs.groupBy("_k").agg(F.max("_pos").alias("_pos")).select("_pos"), "_pos", "left_semi")
    return _with_texts(last, turns, key, order, role, content)


def unanswered(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
               content: str = "text") -> DataFrame:
    """Conversations in which no reply answers a user message: ``(key, n_messages, n_user, n_assistant)``."""
    answered = _pair_ids(turns, key, order, role, content).select(F.col("_k").alias(key)).distinct()
    sizes = turns.groupBy(key).agg(F.count(F.lit(1)).alias("n_messages"),
                                   F.count_if(F.coalesce(F.col(role) == "user", F.lit(False))).alias("n_user"),
                                   F.count_if(F.coalesce(F.col(role) == "assistant", F.lit(False))).alias("n_assistant"))
    answered = answered.withColumnRenamed(key, "_answered")
    return sizes.join(answered, F.col(key).eqNullSafe(F.col("_answered")), "left_anti")
