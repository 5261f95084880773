"""The model column keeps order and length, applies the failure rule (T5), runs once per stage."""

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from critloom.functions.prompts import message
from critloom.operators.model import FunctionBackend, StubModel, generate, run_chunk, stub_digest


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import test modules


def _reply_or_fail(batch):
    out = []
    for msgs in batch:
        c = msgs[-1]["content"] if msgs else ""
        if c == "boom":
            raise RuntimeError("bad row")
        out.append("re:" + (c or ""))
    return out


def test_order_and_length_under_repartition(spark):
    df = spark.range(500).repartition(7).select("id", F.array(message("user", F.col("id").cast("string"))).alias("m"))
    out = df.select("id", generate(F.col("m"), FunctionBackend(_reply_or_fail, batch_size=8)).alias("g"))
    rows = out.collect()
    assert len(rows) == 500
    assert all(r["g"]["text"] == f"re:{r['id']}" and r["g"]["error"] is None for r in rows)


def test_failure_rule_row_retry_and_blank_batch(spark):
    texts = ["a", "boom", "c", "d"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    m = F.array(message("user", F.col("t")))
    be = FunctionBackend(_reply_or_fail, batch_size=8)
    rows = df.select("i", generate(m, be).alias("g")).orderBy("i").collect()
    assert [r["g"]["text"] for r in rows] == ["re:a", "", "re:c", "re:d"]
    assert rows[1]["g"]["error"].startswith("RuntimeError") and rows[0]["g"]["error"] is None
    rows = df.select("i", generate(m, be, blank_batch=True).alias("g")).orderBy("i").collect()
    assert [r["g"]["text"] for r in rows] == ["", "", "", ""]


def test_run_chunk_length_mismatch_is_an_error():
    be = FunctionBackend(lambda b: ["x"], batch_size=8)
    out = run_chunk(be, [[{"role": "user", "content": "1"}], [{"role": "user", "content": "2"}]], False)
    assert out[0][0] == "x" and out[1][0] == "x"  # row-by-row retry returns one reply each


def test_stub_digest_matches_sql_shape():
    msgs = [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]
    import hashlib
    assert stub_digest(msgs) == hashlib.md5("user\x1ea\x1fassistant\x1e".encode()).hexdigest()
    assert StubModel().generate_batch([msgs, []])[1] == hashlib.md5(b"").hexdigest()


def test_one_python_evaluation_per_stage(spark):
    df = spark.range(10).select(F.array(message("user", F.col("id").cast("string"))).alias("m"))
    g = df.withColumn("g", generate(F.col("m"), StubModel()))
    out = g.select(F.col("g.text").alias("a"), F.col("g.error").alias("b"), F.upper("g.text").alias("c"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    rows = FunctionBackend(lambda b: [str(len(b))] * len(b), batch_size=10_000)
    df = spark.range(0, 48, 1, 1).select(F.array(message("user", F.repeat(F.lit("x"), 1 << 20))).alias("m"))
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    sizes = [int(r.t) for r in df.select(generate(F.col("m"), rows).getField("text").alias("t")).collect()]
    assert len(sizes) == 48 and max(sizes) <= 8
