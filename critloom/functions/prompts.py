"""Prompt rendering as Catalyst expressions over ``array<struct<role,content>>`` columns.

Null content is treated as the empty string everywhere, and a null history as an empty
one. Instructions and worked examples come from a ``PromptKit``; they are rendered once on
the driver into literal arrays, so Catalyst folds them into constants.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import texts as X

Msg = tuple[str, str]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _s(x: Column | str) -> Column:
    """A string column with null read as ''."""
    return F.coalesce(_c(x), F.lit(""))


def message(role: Column | str, content: Column | str) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    c = F.lit(content) if isinstance(content, str) else content
    return F.struct(r.alias("role"), c.alias("content"))


def messages_literal(msgs: Sequence[Msg]) -> Column:
    """A literal ``array<struct<role,content>>``."""
    if not msgs:
        return F.array().cast("array<struct<role:string,content:string>>")
    return F.array(*[message(r, c) for r, c in msgs])


def history(col: Column | str) -> Column:
    """A history column with null read as the empty list."""
    return F.coalesce(_c(col), messages_literal([]))


def last_element(arr: Column) -> Column:
    """Last element of an array, null when it is empty or null.

    ``get(arr, size - 1)`` rather than ``try_element_at(arr, -1)``: same result, but the
    latter fails whole-stage code generation in some plans (the stage then falls back to the
    slower interpreted path).
    """
    return F.get(arr, F.size(arr) - 1)


def last_content(hist: Column | str) -> Column:
    """Content of the last message ('' for an empty history)."""
    return _s(last_element(history(hist)).getField("content"))


@dataclass(frozen=True)
class Prompt:
    """A prompt as a constant message prefix plus a per-row suffix column.

    ``column()`` gives the whole ``array<struct<role,content>>``; a model stage takes the
    Prompt itself so that only the suffix is shipped per row.
    """

    prefix: tuple[Msg, ...]
    suffix: Column

    def column(self) -> Column:
        return F.concat(messages_literal(self.prefix), self.suffix) if self.prefix else self.suffix


# ---- F1 teacher prompt -----------------------------------------------------------

def teacher_prompt_parts(hist: Column | str, kit: X.PromptKit = X.DEFAULT_KIT) -> Prompt:
    return Prompt((("system", kit.teacher),), history(hist))


def teacher_prompt(hist: Column | str, kit: X.PromptKit = X.DEFAULT_KIT) -> Column:
    return teacher_prompt_parts(hist, kit).column()


# ---- F2/F3 critique and revision questions ---------------------------------------

# One template each, for rows (columns) and worked examples (strings): label and field per line.
CRITIQUE_LINES = ((X.QUESTION_LABEL, "question"), (X.INITIAL_RESPONSE_LABEL, "reply"),
                  (X.CRITIQUE_REQUEST_LABEL, "critique_request"))
REVISION_LINES = (*CRITIQUE_LINES, (X.CRITIQUE_LABEL, "critique"), (X.REVISION_REQUEST_LABEL, "revision_request"))


def fill(lines, fields: dict[str, Column]) -> Column:
    """A template with one column per field; null reads as ''."""
    return F.concat_ws("\n", *[F.concat(F.lit(label), _s(fields[name])) for label, name in lines])


def fill_example(lines, example: X.WorkedRevision) -> str:
    """The same template with the fields of a worked example."""
    return "\n".join(label + getattr(example, name) for label, name in lines)


def critique_question(question, response, request) -> Column:
    return fill(CRITIQUE_LINES, {"question": question, "reply": response, "critique_request": request})


def revision_question(question, response, request, critique, revision_request) -> Column:
    return fill(REVISION_LINES, {"question": question, "reply": response, "critique_request": request,
                                 "critique": critique, "revision_request": revision_request})


# ---- F4 few-shot expansion (driver side, once) -------------------------------------

def worked_prefix(system: str, lines, answer: str, kit: X.PromptKit) -> tuple[Msg, ...]:
    """System message, then a user and an assistant message per worked example; ``answer`` is its reply field."""
    return (("system", system), *(m for e in kit.revisions
                                  for m in (("user", fill_example(lines, e)), ("assistant", getattr(e, answer)))))


# ---- F5/F6 critique and revision prompts ------------------------------------------

def critique_prompt_parts(hist, initial_response, critique_request, kit: X.PromptKit = X.DEFAULT_KIT) -> Prompt:
    """System, the worked examples and 1 user message; only the last history message is used."""
    q = critique_question(last_content(hist), initial_response, critique_request)
    return Prompt(worked_prefix(kit.critique, CRITIQUE_LINES, "critique", kit), F.array(message("user", q)))


def critique_prompt(hist, initial_response, critique_request, kit: X.PromptKit = X.DEFAULT_KIT) -> Column:
    return critique_prompt_parts(hist, initial_response, critique_request, kit).column()


def revision_prompt_parts(hist, initial_response, critique_request, critique, revision_request,
                          kit: X.PromptKit = X.DEFAULT_KIT) -> Prompt:
    q = revision_question(last_content(hist), initial_response, critique_request, critique, revision_request)
    return Prompt(worked_prefix(kit.revision, REVISION_LINES, "revision", kit), F.array(message("user", q)))


def revision_prompt(hist, initial_response, critique_request, critique, revision_request,
                    kit: X.PromptKit = X.DEFAULT_KIT) -> Column:
    return revision_prompt_parts(hist, initial_response, critique_request, critique, revision_request, kit).column()


# ---- F7/F8 transcript and student prompt ------------------------------------------

TRANSCRIPT_END = "\n" + X.STUDENT_PROMPT


def transcript(hist) -> Column:
    """``Conversation:`` then ``student: …\\n`` / ``teacher: …\\n`` per message, then the ask."""
    lines = F.transform(
        history(hist),
        lambda m: F.concat(
            F.when(m.getField("role") == "user", F.lit(X.STUDENT_ROLE_NAME)).otherwise(
                F.lit(X.TEACHER_ROLE_NAME)),
            F.lit(": "), _s(m.getField("content")), F.lit("\n"),
        ),
    )
    return F.concat(F.lit(X.TRANSCRIPT_HEADER), F.array_join(lines, ""), F.lit(TRANSCRIPT_END))


def dialogue_prefix(kit: X.PromptKit) -> tuple[Msg, ...]:
    """System message, then per worked dialogue its transcript and the message that followed."""
    out: list[Msg] = [("system", kit.student)]
    for d in kit.dialogues:
        said = "".join(f"{speaker}: {text}\n" for speaker, text in d.said)
        out += [("user", X.TRANSCRIPT_HEADER + said + TRANSCRIPT_END), ("assistant", d.next_message)]
    return tuple(out)


def student_prompt_parts(hist, kit: X.PromptKit = X.DEFAULT_KIT) -> Prompt:
    """System, the worked dialogues and the transcript of the history."""
    return Prompt(dialogue_prefix(kit), F.array(message("user", transcript(hist))))


def student_prompt(hist, kit: X.PromptKit = X.DEFAULT_KIT) -> Column:
    return student_prompt_parts(hist, kit).column()


# ---- F11 chat template -------------------------------------------------------------

# A ChatML-style template; the pieces are parameters because the template belongs to the
# tokenizer of whatever model is trained.
CHATML = ("<|im_start|>", "\n", "<|im_end|>\n")


def chat_template(hist, template: tuple[str, str, str] = CHATML) -> Column:
    start, sep, end = template
    return F.array_join(
        F.transform(history(hist), lambda m: F.concat(
            F.lit(start), _s(m.getField("role")), F.lit(sep), _s(m.getField("content")), F.lit(end))),
        "",
    )


# ---- F13 judge prompt ---------------------------------------------------------------

def judge_user_text(prompt, response, kit: X.PromptKit = X.DEFAULT_KIT) -> Column:
    return F.concat(
        F.lit(kit.rubric + "\n\n" + X.JUDGE_QUESTION_HEADER + "\n"), _s(prompt),
        F.lit("\n\n" + X.JUDGE_RESPONSE_HEADER + "\n"), _s(response),
        F.lit("\n\n" + kit.closing),
    )


def judge_prompt_parts(prompt, response, kit: X.PromptKit = X.DEFAULT_KIT) -> Prompt:
    return Prompt((("system", kit.judge),), F.array(message("user", judge_user_text(prompt, response, kit))))


def judge_prompt(prompt, response, kit: X.PromptKit = X.DEFAULT_KIT) -> Column:
    return judge_prompt_parts(prompt, response, kit).column()
