"""Declared schemas for every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])
MESSAGES = T.ArrayType(MESSAGE)

QUESTIONS = T.StructType([
    T.StructField("question_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("label_text", T.StringType()),
])

PRINCIPLES = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("idx", T.IntegerType()),
    T.StructField("critique", T.StringType()),
    T.StructField("revision", T.StringType()),
])

_STRS = T.ArrayType(T.StringType())

PREFERENCES = T.StructType([
    T.StructField("question_id", T.LongType()),
    T.StructField("turn", T.IntegerType()),
    T.StructField("conversation_id", T.LongType()),
    T.StructField("question", T.StringType()),
    T.StructField("messages", MESSAGES),
    T.StructField("category", T.StringType()),
    T.StructField("initial_response", T.StringType()),
    T.StructField("critique_requests", _STRS),
    T.StructField("critiques", _STRS),
    T.StructField("revision_requests", _STRS),
    T.StructField("revisions", _STRS),
    T.StructField("chosen", T.StringType()),
    T.StructField("rejected", T.StringType()),
    T.StructField("job_id", T.IntegerType()),
])

EVAL_EXAMPLES = T.StructType([
    T.StructField("ord", T.LongType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("reference_answer", T.StringType()),
    T.StructField("category", T.StringType()),
])

JUDGE_RESULT = T.StructType([
    T.StructField("judgment", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

JUDGEMENT_DETAILS = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("judgment", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

METRICS = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

COUNTS = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("step", T.LongType()),
    T.StructField("block", T.LongType()),
])

GENERATED = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()),
])
