"""Quality rules as a short-circuit cascade, in DataFrame operations only."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
SAMPLE_ROWS = 2000  # rows that costs and rejection shares are estimated on (never the verdicts)
LEAST_SECONDS = 1e-3  # of a rule on the sample: differences below are noise
WINDOW = 5          # words of a repeated window


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable is never inlined into a loop."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def repeated_words(w: Column, size: int = WINDOW) -> Column:
    """Words inside ``size``-word windows that occur twice or more in the array, all occurrences counted.

    Windows are compared by a 64-bit hash of their words. Sorting (hash, position) pairs brings
    equal windows together, so the work is n log n in the text's words, and no row leaves its task."""
    def of_hashes(h):
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def of_pairs(p):
            at = F.sequence(F.lit(0), F.size(p) - 1)
            again = F.filter(at, lambda j: F.when(j > 0, p[j].h == F.get(p, j - 1).h).otherwise(False)
                             | F.coalesce(p[j].h == F.get(p, j + 1).h, F.lit(False)))
            starts = F.sort_array(F.transform(again, lambda j: p[j].i))
            zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(starts, zero, lambda acc, s: F.struct(
                (acc.n + s + size - F.greatest(acc.end, s)).alias("n"), (s + size).alias("end")), lambda acc: acc.n)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, of_pairs))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))
    return F.when(F.size(w) > size, let(hashes, of_hashes)).otherwise(F.lit(0)).cast("bigint")


def statistics(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of a text as one struct."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, BLANK, "")) > 0)
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n"),
                                            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dup")))
    by_word = let(words(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("again")))
    return let(F.struct(by_word.alias("w"), by_line.alias("l")), lambda s: F.struct(
        s.w.n.alias("n_words"), F.length(F.regexp_replace(text, BLANK, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("bigint").alias("n_symbols"), s.l.n.alias("n_lines"),
        s.l.dup.alias("n_dup_lines"), s.w.again.alias("n_repeat_words")))


@dataclass(frozen=True)
class Rule:
    """A rule rejects a row where ``rejects`` is true (null: it does not)."""

    name: str
    rejects: Column


def default_rules(text: Column) -> list[Rule]:
    """Rules over the text and its statistics in column ``stats``."""
    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    n, chars = F.col("stats.n_words"), F.col("stats.word_chars")
    return [
        Rule("few_words", n < 10),
        Rule("repeated_words", F.col("stats.n_repeat_words") * 100 > n * 20),
        Rule("symbols", F.col("stats.n_symbols") * 4 > n),
        Rule("repeated_lines", (F.col("stats.n_lines") > 3) & (F.col("stats.n_dup_lines") * 10 > F.col("stats.n_lines") * 3)),
        Rule("word_length", (chars < n * 2) | (chars > n * 20)),
        Rule("upper_case", share("[^A-Z]+") * 2 > share("[^A-Za-z]+")),
        Rule("digits", share("[^0-9]+") * 2 > chars),
        Rule("few_letters", share(r"[^\p{L}]+") * 2 < chars),
    ]


def take_sample(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> DataFrame:
    """A random sample of at most ``sample_rows`` raw rows, staged: taken before anything is computed on
    them. The rows are counted first (Parquet knows their number), so little more than the sample is moved."""
    share = min(1.0, 1.1 * sample_rows / max(1, docs.count()))
    return stage(docs.sample(share, seed=seed).limit(sample_rows), "rule_sample")


def order_rules(sample: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, rejected share) by rejections per second on the sample, best first.

    Each rule runs twice over the sample; the faster run counts, less the time of a rule that looks at
    nothing. An empty sample keeps the given order. The order decides how much work is saved, never which
    rows are kept."""
    total = sample.count()

    def run(rejects: Column) -> tuple[float, int]:
        seconds, rejected = float("inf"), 0
        for _ in range(2 if total else 0):
            began = time.perf_counter()
            rejected = sample.agg(F.count_if(F.coalesce(rejects, F.lit(False)))).first()[0]
            seconds = min(seconds, time.perf_counter() - began)
        return seconds, rejected

    empty, out = run(F.lit(False))[0], []
    for r in rules:
        seconds, rejected = run(r.rejects)
        out.append((r, max(seconds - empty, LEAST_SECONDS) if total else 0.0, rejected / total if total else 0.0))
    return sorted(out, key=lambda x: -(x[2] / x[1] if total else 0))


def cascade(docs: DataFrame, rules: list[Rule], sample: DataFrame) -> DataFrame:
    """``docs`` with ``failed_rule`` (first of the cascade that rejects; null if none) and ``kept``.

    The rules form one CASE expression in the order estimated on ``sample`` (rows like those of
    ``docs``), so a row stops at its first rejection. kept does not depend on that order;
    failed_rule does. Rows are judged alone: nulls, repeated rows and empty tables need no
    special care. Columns named failed_rule or kept are replaced."""
    first = F.lit(None).cast("string")
    for r, _, _ in reversed(order_rules(sample, rules)):
        first = F.when(F.coalesce(r.rejects, F.lit(False)), F.lit(r.name)).otherwise(first)
    return docs.withColumn("failed_rule", first).withColumn("kept", F.col("failed_rule").isNull())


def judge(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with the struct ``stats`` of every whole text (null: empty), failed_rule and kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sample = stage(take_sample(docs, sample_rows).withColumn("stats", statistics(text)), "rule_sample_stats")
    return cascade(docs.withColumn("stats", statistics(text)), rules or default_rules(text), sample)
