"""Judge-score extraction (two tiers, last match wins, clamped to [1, 10])."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .prompts import last_element

# ---------------------------------------------------------------------------------
# The score patterns and the default score.
#   tier 1: a "SCORE:" tag (any case) followed by a number not followed by a slash
#   tier 2: a whole-word integer 1..10 not part of a fraction
# Digits are written [0-9] (ASCII, as the cast requires); only the space after the
# tag is Unicode-aware.
# ---------------------------------------------------------------------------------
TAG_PATTERN = r"(?i)SCORE:(?U:\s*)([0-9]+(?:\.[0-9]+)?)(?!\s*/)"
FALLBACK_PATTERN = r"(?<![0-9/])\b(10|[1-9])\b(?!\s*/)"
DEFAULT_SCORE = 5.0
SCORE_MIN, SCORE_MAX = 1.0, 10.0
# ---------------------------------------------------------------------------------


def _last(arr: Column) -> Column:
    return last_element(arr)


def clamp(score: Column, lo: float = SCORE_MIN, hi: float = SCORE_MAX) -> Column:
    """``max(lo, min(hi, s))``; null stays null (``least``/``greatest`` skip nulls)."""
    return F.when(score.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), score)))


def _text(text) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def tag_score(text) -> Column:
    """Tier 1 value (unclamped) or null."""
    return _last(F.regexp_extract_all(_text(text), F.lit(TAG_PATTERN), 1)).try_cast("double")


def fallback_score(text) -> Column:
    """Tier 2 value or null. The look-around pattern only runs on texts holding a digit."""
    t = _text(text)
    hit = _last(F.regexp_extract_all(t, F.lit(FALLBACK_PATTERN), 1)).try_cast("double")
    return F.when(t.rlike("[0-9]"), hit)


def extract_score(text, strict: bool = False) -> Column:
    """last tagged score, else last eligible integer, else 5.0 (null if ``strict``)."""
    t1, t2 = tag_score(text), fallback_score(text)
    found = F.coalesce(t1, t2)
    if strict:
        return clamp(found)
    return clamp(F.coalesce(found, F.lit(DEFAULT_SCORE)))


def score_source(text) -> Column:
    """Which tier produced the score: ``tag``, ``fallback`` or ``default``."""
    return (F.when(tag_score(text).isNotNull(), F.lit("tag"))
            .when(fallback_score(text).isNotNull(), F.lit("fallback"))
            .otherwise(F.lit("default")))


def with_score(df, text: str, score: str = "score", source: str | None = "score_source", strict: bool = False):
    """Add the score (and its source) evaluating each pattern once per row."""
    df = df.withColumns({"_t1": tag_score(text), "_t2": fallback_score(text)})
    found = F.coalesce(F.col("_t1"), F.col("_t2"))
    cols = {score: clamp(found) if strict else clamp(F.coalesce(found, F.lit(DEFAULT_SCORE)))}
    if source:
        cols[source] = (F.when(F.col("_t1").isNotNull(), F.lit("tag"))
                        .when(F.col("_t2").isNotNull(), F.lit("fallback")).otherwise(F.lit("default")))
    return df.withColumns(cols).drop("_t1", "_t2")
