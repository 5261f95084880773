"""Small text functions (F9, F10, F12, F17, F19) and question defaults."""

from pyspark.sql import functions as F

from critloom.functions.text import (content_id, default_if_empty, length_flags, reply_text, strip_echo,
                                     word_count)
from critloom.schemas import MESSAGES
from critloom.sources.tables import questions


def test_reply_text(spark):
    rows = [(1, [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]),
            (2, [{"role": "assistant", "content": "a"}, {"role": "user", "content": "q"}]),
            (3, []), (4, None), (5, [{"role": "assistant", "content": None}])]
    df = spark.createDataFrame(rows, f"id int, m {MESSAGES.simpleString()}")
    got = {r["id"]: r["x"] for r in df.select("id", reply_text("m").alias("x")).collect()}
    assert got == {1: "a", 2: "", 3: "", 4: "", 5: ""}


def test_default_and_strip_echo(spark):
    df = spark.createDataFrame([("p", "p\n  answer \n"), ("p", "other"), ("p", ""), ("p", None)], "p string, t string")
    r = df.select(strip_echo("t", "p").alias("s"), default_if_empty("t").alias("d")).collect()
    assert [x["s"] for x in r] == ["answer", "other", "", None]
    d = [x["d"] for x in r]
    assert d == ["p\n  answer \n", "other", "I am still confused", "I am still confused"]


def test_content_id_equal_texts(spark):
    df = spark.createDataFrame([(1, "same"), (2, "same"), (3, "other")], "qid int, text string")
    ids = {r["qid"]: r["c"] for r in df.select("qid", content_id("text").alias("c")).collect()}
    assert ids[1] == ids[2] != ids[3] and ids[1] > 0


def test_question_defaults(spark):
    with_label = spark.createDataFrame([(1, "q", "math"), (2, "q", None)], "question_id long, text string, label_text string")
    without = spark.createDataFrame([(3, "q")], "question_id long, text string")
    assert [r["category"] for r in questions(with_label).orderBy("question_id").collect()] == ["math", None]
    assert questions(without).first()["category"] == "general"


def test_word_count_and_flags(spark):
    df = spark.createDataFrame([("  a b\n c ", "x", "y y"), ("", "", "")], "p string, c string, r string")
    np_, nc, nr, fits = length_flags(F.col("p"), F.col("c"), F.col("r"), max_length=4)
    rows = df.select(np_.alias("p"), nc.alias("c"), nr.alias("r"), fits.alias("f"), word_count("p").alias("w")).collect()
    assert [(x["p"], x["c"], x["r"], x["f"]) for x in rows] == [(3, 1, 2, False), (0, 0, 0, True)]
