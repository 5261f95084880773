"""Mixing sources to target weights: capped water-filling and seeded repetitions, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_numbers, stage

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
BROADCAST_SOURCES = 100_000  # a source table of at most so many rows is broadcast
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_key(source: Column) -> Column:
    """A key that is never null: null and every text stay apart."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(..., size, weight) with ``target``: shares of the total size by weight, at most max_epochs × size each.

    A level is raised until the words are dealt: sources whose cap lies under level × weight are
    clamped, their excess goes to the others. Each round is one aggregate over the source table;
    the clamped set only grows, so it ends."""
    cap = F.col("size") * F.lit(max_epochs)
    total, weight = sources.agg(F.sum("size"), F.sum("weight")).first()
    level, clamped = (total / weight if weight and total else 0.0), 0
    while level:
        under = cap < F.lit(float(level)) * F.col("weight")
        n, caps, rest = sources.agg(F.count_if(under), F.coalesce(F.sum(F.when(under, cap)), F.lit(0)),
                                    F.sum(F.when(~under, F.col("weight")))).first()
        if n == clamped or not rest:
            break
        clamped, level = n, (total - caps) / rest
    poured = F.lit(float(level)) * F.col("weight")
    return sources.withColumn("target", F.when(cap < poured, cap.cast("double")).otherwise(poured))


def _cut(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(key, cut): of each source the largest hash that gets one more copy ('' for none).

    Rows come in hash order until their sizes reach ``need``; the row at the border is in if more
    than half of it fits. The border is found by two levels of 256 hash buckets per source, and
    only the rows of the last bucket are ordered, so no source is sorted in one task."""
    found = plan.select("key", "need", F.lit("").alias("prefix")).where("need > 0")
    for n in (2, 4):
        sums = (rows.withColumn("bucket", F.substring("hash", 1, n)).groupBy("key", "bucket").agg(F.sum("size").alias("words")))
        if n == 4:
            sums = sums.withColumn("prefix", F.substring("bucket", 1, 2)).join(found, ["key", "prefix"])
        else:
            sums = sums.join(found, "key")
        order = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("upto", F.sum("words").over(order)).where(F.col("upto") > F.col("need"))
        found = stage(sums.groupBy("key").agg(F.min_by(F.struct("bucket", "upto", "words", "need"), "bucket").alias("b"))
                      .select("key", (F.col("b.need") - (F.col("b.upto") - F.col("b.words"))).alias("need"),
                              F.col("b.bucket").alias("prefix")), "mix_border")
    last = (rows.withColumn("prefix", F.substring("hash", 1, 4)).join(found, ["key", "prefix"])
            .groupBy("key", "prefix", "need", "hash").agg(F.sum("size").alias("words")))
    order = Window.partitionBy("key", "prefix").orderBy("hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("upto", F.sum("words").over(order)).where(F.col("upto") - F.col("words") / 2 < F.col("need"))
    last = last.groupBy("key").agg(F.max("hash").alias("cut"))
    return found.join(last, "key", "left").select("key", F.coalesce("cut", "prefix").alias("cut"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        carried: tuple[str, ...] | None = None) -> DataFrame:
    """The carried columns (default: the id) with ``size, source_size, target, copies, taken``.

    size is the text's words (null: 0). Sources in code-point order, null last, weigh ``weights``,
    repeating; they share the sum of all sizes up to max_epochs times their own. A document is
    repeated floor(target / source size) times; one more copy goes to the documents with the
    smallest seeded hash (of id and text) until the source's words come as near to its target as
    whole documents allow. taken = size × copies. Rows with the same id and text share a hash and
    their fate; null ids, empty texts and empty tables need no special care (a source without
    words gets none). Columns of the input with a name of the output are not carried."""
    own = ("size", "source_size", "target", "copies", "taken")
    carried = tuple(c for c in ((id_col,) if carried is None else carried) if c not in own)
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        *carried, F.col(source_col).cast("string").alias("_source"), word_count(F.col(text_col)).alias("_size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)).alias("_hash"))
    sized = stage(sized, "mix_sizes").withColumn("_key", source_key(F.col("_source")))
    rows = sized.select(F.col("_key").alias("key"), F.col("_size").alias("size"), F.col("_hash").alias("hash"))
    totals = sized.groupBy("_key").agg(F.min("_source").alias("source"), F.sum("_size").alias("size")).withColumnRenamed("_key", "key")
    ranked = row_numbers(totals, [F.col("source").isNull(), F.col("source")], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stage(ranked.select("key", "size", weight.cast("bigint").alias("weight")), "mix_sources")
    plan = water_fill(sources, max_epochs)
    whole = F.when(F.col("size") > 0, F.least(F.floor(F.col("target") / F.col("size")), F.lit(max_epochs))).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("bigint")).withColumn("need", F.col("target") - F.col("whole") * F.col("size"))
    plan = stage(plan.join(_cut(rows, plan), "key", "left")
                 .select(F.col("key").alias("_key"), F.col("size").alias("source_size"), "target", "whole",
                         F.coalesce("cut", F.lit("")).alias("cut")), "mix_plan")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    copies = F.col("whole") + (F.col("_hash") <= F.col("cut")).cast("bigint")
    return sized.join(plan, "_key").select(*carried, F.col("_size").alias("size"), "source_size", "target",
                                           copies.alias("copies"), (F.col("_size") * copies).alias("taken"))
