"""Small text functions: ids, reply extraction, echo stripping, defaults, length caps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import texts as X
from .prompts import _c, _s, history, last_element


def content_id(text) -> Column:
    """a stable 60-bit id from the text (first 15 hex digits of its md5)."""
    return F.conv(F.substring(F.md5(_s(text)), 1, 15), 16, 10).cast("bigint")


def reply_text(messages) -> Column:
    """content of the last message if its role is ``assistant``, else ''."""
    last = last_element(history(messages))
    return F.when(last.getField("role") == "assistant", _s(last.getField("content"))).otherwise(F.lit(""))


def default_if_empty(col, default: str = X.DEFAULT_STUDENT_RESPONSE) -> Column:
    """replace a null or empty reply by a default."""
    c = _c(col)
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def strip_echo(text, prompt) -> Column:
    """if the text starts with the prompt, drop it and strip whitespace; else unchanged."""
    t, p = _c(text), _s(prompt)
    rest = t.substr(F.length(p) + 1, F.lit(2147483647))
    stripped = F.regexp_replace(rest, r"(?U)^\s+|\s+$", "")
    return F.when(t.startswith(p), stripped).otherwise(t)


def word_count(text) -> Column:
    """F19 length measure: whitespace-separated words."""
    t = F.regexp_replace(_s(text), r"^\s+|\s+$", "")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))


def length_flags(prompt, chosen, rejected, max_length: int = 512, max_prompt_length: int | None = None):
    """word counts and whether a pair fits the caps (prompt cap defaults to half)."""
    mp = max_length // 2 if max_prompt_length is None else max_prompt_length
    np_, nc, nr = word_count(prompt), word_count(chosen), word_count(rejected)
    fits = (np_ <= mp) & (np_ + F.greatest(nc, nr) <= max_length)
    return np_, nc, nr, fits


def _runs(text: Column) -> Column:
    """Words and the white space between them, in order."""
    return F.regexp_extract_all(_s(text), F.lit(r"\S+|\s+"), 0)


def last_words(text, n) -> Column:
    """the text from its n-th last word on (whole if it has no more than n words)."""
    n, runs = F.lit(n) if isinstance(n, int) else n, _runs(_c(text))
    after = F.when(F.element_at(runs, -1).rlike(r"^\s"), 1).otherwise(0)  # white space behind the last word
    held = F.least(F.size(runs), F.lit(2) * n - 1 + after)
    kept = F.array_join(F.slice(runs, F.size(runs) - held + 1, held), "")
    return F.when(word_count(text) <= n, _s(text)).when(n <= 0, F.lit("")).otherwise(kept)


def first_words(text, n) -> Column:
    """the text up to the end of its n-th word (whole if it has no more than n words)."""
    n, runs = F.lit(n) if isinstance(n, int) else n, _runs(_c(text))
    before = F.when(F.element_at(runs, 1).rlike(r"^\s"), 1).otherwise(0)
    kept = F.array_join(F.slice(runs, F.lit(1), F.greatest(F.lit(2) * n - 1 + before, F.lit(0))), "")
    return F.when(word_count(text) <= n, _s(text)).when(n <= 0, F.lit("")).otherwise(kept)


def last_tokens(text, spans: Column, n) -> Column:
    """As ``last_words`` for tokens given by their places (``operators.model.token_spans``)."""
    n = F.lit(n) if isinstance(n, int) else n
    start = F.try_element_at(spans, F.greatest(F.size(spans) - n + 1, F.lit(1))).getField("s")
    return F.when(F.size(spans) <= n, _s(text)).when(n <= 0, F.lit("")).otherwise(_s(text).substr(start + 1, F.lit(2147483647)))


def first_tokens(text, spans: Column, n) -> Column:
    """As ``first_words`` for tokens given by their places."""
    n = F.lit(n) if isinstance(n, int) else n
    end = F.try_element_at(spans, F.greatest(n, F.lit(1))).getField("e")
    return F.when(F.size(spans) <= n, _s(text)).when(n <= 0, F.lit("")).otherwise(_s(text).substr(F.lit(1), end))


def truncate_pairs(df, max_length: int = 512, max_prompt_length: int | None = None, spans=None,
                   prompt: str = "prompt", answers: tuple[str, ...] = ("chosen", "rejected")):
    """preference pairs cut to the token caps (prompt cap defaults to half).

    A pair fits if the prompt and its longest answer have at most ``max_length`` tokens. Of a pair that
    does not, the prompt keeps its last ``max_prompt_length`` tokens; if it still does not, every answer
    that is too long beside that prompt keeps its first ``max_length - max_prompt_length`` tokens. Adds
    ``n_tokens`` (prompt and longest answer as cut) and ``cut`` (whether anything was). Tokens are
    words, or what ``spans`` (a function from a text column to its tokens' places) says. Null texts are empty.
    """
    cap = max_length // 2 if max_prompt_length is None else max_prompt_length
    cols = (prompt, *answers)
    if spans is None:
        count, last, first = {c: word_count(c) for c in cols}, last_words, first_words
    else:
        df = df.withColumns({f"_{c}_spans": spans(F.col(c)) for c in cols})
        count = {c: F.size(f"_{c}_spans") for c in cols}
        last, first = (lambda c, n: last_tokens(c, F.col(f"_{c}_spans"), n)), (lambda c, n: first_tokens(c, F.col(f"_{c}_spans"), n))
    df = df.withColumns({f"_{c}_n": count[c] for c in cols})
    longest = F.greatest(*[F.col(f"_{c}_n") for c in answers], F.lit(0))
    over = F.col(f"_{prompt}_n") + longest > max_length
    df = df.withColumn("_left", F.when(over, F.least(F.col(f"_{prompt}_n"), F.lit(cap))).otherwise(F.col(f"_{prompt}_n")))
    room = {c: F.when(F.col("_left") + F.col(f"_{c}_n") > max_length, F.lit(max_length - cap)).otherwise(F.col(f"_{c}_n")) for c in answers}
    kept = {c: F.least(F.col(f"_{c}_n"), room[c]) for c in answers}
    changed = (F.col("_left") < F.col(f"_{prompt}_n")) | F.greatest(*[F.col(f"_{c}_n") - kept[c] for c in answers], F.lit(0)).cast("boolean")
    df = df.withColumns({**{f"_{c}_cut": first(c, kept[c]) for c in answers}, f"_{prompt}_cut": last(prompt, F.col("_left")),
                         "n_tokens": (F.col("_left") + F.greatest(*kept.values(), F.lit(0))).cast("bigint"), "cut": changed})
    return df.withColumns({c: F.col(f"_{c}_cut") for c in cols}).drop("_left", *[f"_{c}_{x}" for c in cols for x in ("n", "cut", "spans")])


def category_or_default(df, column: str = "label_text", default: str = X.DEFAULT_CATEGORY) -> Column:
    """The category column if the table has it (nulls stay null), else a constant."""
    return F.col(column) if column in df.columns else F.lit(default)
