"""Prompt rendering (F1–F8, F11, F13) on literal histories."""

from dataclasses import replace

from pyspark.sql import functions as F

from critloom.functions import prompts as P
from critloom.functions.texts import DEFAULT_KIT as KIT
from critloom.operators.sampling import sample_principle
from critloom.schemas import MESSAGES

HISTORIES = [
    (1, [("system", "be kind"), ("user", "why?"), ("assistant", "because")]),  # starts with system
    (2, [("user", "one question")]),                                         # single user turn
    (3, [("user", "a"), ("assistant", "b"), ("user", "c")]),                  # ends with user
    (4, [("user", ""), ("assistant", "empty before")]),                       # empty content
    (5, [("user", None), ("assistant", "null before")]),                      # null content
]


def _df(spark):
    rows = [(i, [{"role": r, "content": c} for r, c in h]) for i, h in HISTORIES]
    return spark.createDataFrame(rows, f"id int, h {MESSAGES.simpleString()}")


def said(h):
    return "".join(("student: " if r == "user" else "teacher: ") + (c or "") + "\n" for r, c in h)


def test_transcript(spark):
    got = {r["id"]: r["t"] for r in _df(spark).select("id", P.transcript("h").alias("t")).collect()}
    for i, h in HISTORIES:
        assert got[i] == "Conversation:" + said(h) + "\nWhat does the student say next?"
    assert got[2] == "Conversation:student: one question\n\nWhat does the student say next?"
    assert got[1].startswith("Conversation:teacher: be kind\n")  # system maps to teacher


def test_teacher_and_student_prompt_shapes(spark):
    df = _df(spark).select("id", P.teacher_prompt("h").alias("tp"), P.student_prompt("h").alias("sp"),
                           P.transcript("h").alias("t"))
    for r in df.collect():
        n = len(dict(HISTORIES)[r["id"]])
        assert len(r["tp"]) == n + 1 and r["tp"][0]["role"] == "system"
        assert len(r["sp"]) == 2 + 2 * len(KIT.dialogues) and r["sp"][0]["content"] == KIT.student
        assert r["sp"][-1]["content"] == r["t"] and r["sp"][2]["content"] == KIT.dialogues[0].next_message


def test_worked_examples_use_the_template_of_rows(spark):
    e = KIT.revisions[0]
    row = spark.range(1).select(
        P.critique_question(F.lit(e.question), F.lit(e.reply), F.lit(e.critique_request)).alias("c"),
        P.revision_question(F.lit(e.question), F.lit(e.reply), F.lit(e.critique_request), F.lit(e.critique),
                            F.lit(e.revision_request)).alias("r")).first()
    assert row["c"] == P.fill_example(P.CRITIQUE_LINES, e) and row["r"] == P.fill_example(P.REVISION_LINES, e)


def test_critique_and_revision_prompts(spark):
    df = _df(spark).select(
        "id", P.critique_prompt("h", F.lit("ans"), F.lit("req")).alias("c"),
        P.revision_prompt("h", F.lit("ans"), F.lit("req"), F.lit(None), F.lit("rev")).alias("r"))
    for row in df.collect():
        last = dict(HISTORIES)[row["id"]][-1][1] or ""
        assert len(row["c"]) == len(row["r"]) == 2 + 2 * len(KIT.revisions)
        asked = f"question: {last}\ninitial response: ans\ncritique request: req"
        assert row["c"][-1]["content"] == asked
        assert row["r"][-1]["content"] == asked + "\ncritique: \nrevision request: rev"
        assert row["c"][1]["role"] == "user" and row["c"][2]["role"] == "assistant"
        assert row["c"][2]["content"] == KIT.revisions[0].critique and row["r"][2]["content"] == KIT.revisions[0].revision


def test_texts_are_inputs(spark):
    kit = replace(KIT, teacher="T", critique="C", judge="J", rubric="R", closing="END", revisions=(), dialogues=(),
                  principles=(("only", "this"),), preferences=("one",))
    df = _df(spark).select(P.teacher_prompt("h", kit).alias("t"), P.critique_prompt("h", F.lit("a"), F.lit("q"), kit).alias("c"),
                           P.student_prompt("h", kit).alias("s"), P.judge_prompt(F.lit("p"), F.lit("a"), kit).alias("j"),
                           sample_principle(1, "id", kit=kit).alias("p"), sample_principle(1, "id", stage="rl", kit=kit).alias("rl"))
    for r in df.collect():
        assert r["t"][0]["content"] == "T" and [m["role"] for m in r["c"]] == ["system", "user"] and len(r["s"]) == 2
        assert r["j"][1]["content"].startswith("R\n\n") and r["j"][1]["content"].endswith("\n\nEND")
        assert tuple(r["p"]) == ("only", "this") and r["rl"]["critique"] == "one"


def test_chat_template_and_judge_prompt(spark):
    df = _df(spark).select("id", P.chat_template("h").alias("t"), P.judge_prompt(F.lit("q"), F.lit("a")).alias("j"))
    r = {x["id"]: x for x in df.collect()}
    assert r[2]["t"] == "<|im_start|>user\none question<|im_end|>\n"
    assert r[5]["t"].startswith("<|im_start|>user\n<|im_end|>\n")
    j = r[1]["j"]
    assert [m["role"] for m in j] == ["system", "user"]
    assert "\n\nSTUDENT QUESTION:\nq\n\nTUTOR RESPONSE:\na\n\n" in j[1]["content"]


def test_null_history_is_empty(spark):
    df = spark.createDataFrame([(1, None)], f"id int, h {MESSAGES.simpleString()}")
    r = df.select(P.transcript("h").alias("t"), F.size(P.teacher_prompt("h")).alias("n")).first()
    assert r["t"] == "Conversation:\nWhat does the student say next?" and r["n"] == 1
