"""Chat formatting: reply trees, their best branches, and one templated conversation per branch; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_numbers, stage

START, STOP = "<|im_start|>", "<|im_end|>"
SALTS = 32  # parts of a tree ranked apart before its best branches meet


def escape(text: Column) -> Column:
    r"""Control strings cannot occur in the result: \ becomes \\, <| becomes <\|, a line feed in a role \n."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """The inverse: pairs of backslashes are taken from the left, what is left of them marks an escape."""
    return F.array_join(F.transform(F.split(text, r"\\\\"), lambda x: F.replace(
        F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))), "\\")


def paths(nodes: DataFrame) -> DataFrame:
    """(leaf, node, dist) of every root-to-leaf path of ``nodes`` (id bigint, parent bigint); dist 0 is the leaf.

    Self-joins that double: after round k each leaf knows its nearest 2^k path nodes, and every
    node its 2^k-th ancestor, so the rounds are logarithmic in the depth and the rows are those
    of the result. A parent that is not there counts as none. A cycle raises ValueError."""
    parents = nodes.select(F.col("id").alias("parent")).distinct()
    jump = stage(nodes.select("id", "parent").join(parents, "parent", "left_semi").select("id", F.col("parent").alias("up")), "reply_up")
    inner = jump.select(F.col("up").alias("id")).distinct()
    known = stage(nodes.select("id").join(inner, "id", "left_anti")
                  .select(F.col("id").alias("leaf"), F.col("id").alias("node"), F.lit(0).cast("bigint").alias("dist")), "reply_paths")
    total, step = nodes.count(), 1
    while jump.limit(1).count():
        if step > total:
            raise ValueError("the replies form a cycle")
        up = jump.withColumnRenamed("id", "node")
        known = stage(known.union(known.join(up, "node").select("leaf", F.col("up"), F.col("dist") + step)), "reply_paths")
        jump = stage(jump.join(jump.select(F.col("id").alias("up"), F.col("up").alias("far")), "up")
                     .select("id", F.col("far").alias("up")), "reply_up")
        step *= 2
    return known


def best_branches(found: DataFrame, nodes: DataFrame, top: int) -> DataFrame:
    """(leaf, rank) of the ``top`` paths of each tree by their summed score, ties to the smaller leaf id."""
    scored = (found.join(nodes.select(F.col("id").alias("node"), "score"), "node").groupBy("leaf")
              .agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("total"))
              .join(nodes.select(F.col("id").alias("leaf"), "tree"), "leaf"))
    best = [F.col("total").desc(), F.col("leaf")]
    salted = Window.partitionBy("tree", F.pmod(F.xxhash64("leaf"), F.lit(SALTS))).orderBy(*best)
    few = scored.withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= top)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*best)))
    return few.where(F.col("rank") <= top).select("leaf", "tree", "rank")


def unique_nodes(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the smallest row of each id. Only rows of repeated ids are compared."""
    cols = ["id", "parent", "tree", "role", "text", "score"]
    again = stage(nodes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("_id")), "repeated_ids")
    if again.isEmpty():
        return nodes.select(*cols)
    same = F.col("id").eqNullSafe(F.col("_id"))
    least = nodes.join(again, same, "left_semi").groupBy("id").agg(F.min(F.struct(*cols[1:])).alias("n")).select("id", "n.*")
    return nodes.join(again, same, "left_anti").select(*cols).union(least)


def format_trees(nodes: DataFrame, top: int = 1, learn: str = "assistant", texts: DataFrame | None = None) -> DataFrame:
    """(tree, leaf, rank, n_turns, formatted, loss_spans) of the best ``top`` branches of every reply tree.

    ``nodes`` has id bigint (unique; of repeated ids the smallest row stays), parent bigint, tree,
    role, text, score double. formatted holds per turn the start mark, the escaped role, a line
    feed, the escaped text, the stop mark and a line feed; loss_spans the code-point ranges
    (start, length) of the escaped texts of role ``learn``. Null roles and texts are empty, null
    scores 0; an empty table gives no rows; other columns are ignored. One conversation is one
    value, so a branch must fit a row. ``texts`` (id, role, text) may be given apart; ids must then be
    unique in both."""
    if texts is None:
        nodes = unique_nodes(nodes)
        texts = nodes
    slim = stage(nodes.select("id", "parent", "tree", "score"), "reply_nodes")  # texts wait for the chosen paths
    found = paths(slim)
    chosen = found.join(best_branches(found, slim, top), "leaf")
    turn = texts.select(F.col("id").alias("node"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = chosen.join(turn, "node").groupBy("leaf", "rank").agg(
        F.first("tree").alias("tree"), F.sort_array(F.collect_list(F.struct((-F.col("dist")).alias("at"), "role", "text"))).alias("turns"))
    head = lambda t: F.concat(F.lit(START), escape_role(t.role), F.lit("\n"))
    parts = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escape(t.text).alias("body"), (t.role == learn).alias("learn")))
    rows = stage(rows.select("tree", "leaf", "rank", parts.alias("parts")), "reply_parts")
    tail = F.lit(f"{STOP}\n")
    whole = F.array_join(F.transform("parts", lambda p: F.concat(p.head, p.body, tail)), "")
    lengths = F.transform("parts", lambda p: F.struct(F.length(p.head).alias("h"), F.length(p.body).alias("b"), p.learn.alias("learn")))
    return rows.select("tree", "leaf", "rank", F.size("parts").cast("bigint").alias("n_turns"), whole.alias("formatted"),
                       _running(lengths, len(STOP) + 1).alias("loss_spans"))


def _running(lengths: Column, tail: int) -> Column:
    """Ranges of the learned bodies from the lengths of all heads and bodies."""
    zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return F.aggregate(lengths, zero, lambda acc, x: F.struct(
        (acc.end + x.h + x.b + tail).alias("end"),
        F.when(x.learn, F.concat(acc.spans, F.array(F.struct((acc.end + x.h).alias("start"), x.b.alias("length")))))
        .otherwise(acc.spans).alias("spans")), lambda acc: acc.spans)


def _numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, parent, tree, score) of all turns as nodes, and (id, role, text)."""
    rows = row_numbers(conversations.select("conv_id", "turn", "role", "text"),
                       [F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text")], "id")
    place = rows.select("id", F.col("conv_id").alias("tree"))
    before = place.select((F.col("id") + 1).alias("id"), F.col("tree").alias("_tree"), F.col("id").alias("_parent"))
    nodes = (place.join(before, "id", "left")
             .withColumn("parent", F.when(F.col("tree").eqNullSafe(F.col("_tree")) & F.col("_parent").isNotNull(), F.col("_parent")))
             .select("id", "parent", "tree", F.lit(0.0).alias("score")))
    return nodes, rows.select("id", "role", "text")


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as reply trees with one branch each.

    Rows are numbered by (conv_id, turn, role, text); each replies to the row before it in its
    conversation, found by a join on that number (rows of a null conv_id form one conversation)."""
    nodes, texts = _numbered_turns(conversations)
    return nodes.join(texts, "id").select("id", "parent", "tree", "role", "text", "score")


def format_conversations(conversations: DataFrame, learn: str = "assistant") -> DataFrame:
    """``format_trees`` of a table of turns; texts are stored with their numbers and then moved to their
    conversation only."""
    nodes, texts = _numbered_turns(conversations)
    return format_trees(nodes, 1, learn, texts)


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    segments = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")
    return F.transform(segments, lambda x: F.struct(
        unescape(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.regexp_replace(F.regexp_replace(x, r"(?s)\A[^\n]*\n", ""), r"<\|im_end\|>\n\z", "")).alias("text")))


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s.start + 1, s.length))), "")
