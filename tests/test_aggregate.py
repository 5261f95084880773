"""A1–A3 (T2) and O4."""

import pytest

from critloom.operators.aggregate import best_step, eval_metrics


def test_population_std(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (1, "a", 4.0)], "step long, category string, score double")
    m = {r["metric"]: r["value"] for r in eval_metrics(df).collect()}
    assert m["teaching_quality_score"] == pytest.approx(7 / 3) and m["teaching_quality_std"] == pytest.approx(1.247219, abs=1e-6)
    assert (m["teaching_quality_min"], m["teaching_quality_max"]) == (1.0, 4.0)


def test_metrics_long_table(spark):
    df = spark.createDataFrame([(200, "a", 1.0), (200, "a", 2.0), (200, "b", 4.0), (200, None, 9.0), (200, "", 3.0)],
                               "step long, category string, score double")
    m = {(r["category"], r["metric"]): r["value"] for r in eval_metrics(df).collect()}
    assert m[(None, "teaching_quality_score")] == pytest.approx(19 / 5)  # null and '' still count overall
    assert m[(None, "teaching_quality_max")] == 9.0
    assert m[("a", "teaching_quality_a")] == 1.5 and m[("b", "teaching_quality_b")] == 4.0
    assert len(m) == 6  # 4 overall + a + b; no row for null or empty


def test_metric_named_like_overall_keeps_both(spark):
    df = spark.createDataFrame([(1, "score", 2.0), (1, "x", 4.0)], "step long, category string, score double")
    rows = eval_metrics(df).collect()
    names = sorted((r["category"] or "", r["metric"]) for r in rows)
    assert ("", "teaching_quality_score") in names and ("score", "teaching_quality_score") in names


def test_best_step_ties_to_lowest(spark):
    df = spark.createDataFrame([(200, None, "teaching_quality_score", 7.0), (400, None, "teaching_quality_score", 8.0),
                                (600, None, "teaching_quality_score", 8.0)],
                               "step long, category string, metric string, value double")
    r = best_step(df).first()
    assert (r["best_step"], r["best_value"]) == (400, 8.0)
    assert best_step(df, mode="min").first()["best_step"] == 200


def test_fixture_t2_exact(spark):
    df = spark.createDataFrame([(200, "a", 1.0), (200, "a", 2.0), (200, "b", 4.0), (200, None, 9.0)],
                               "step long, category string, score double")
    m = {(r["category"], r["metric"]): r["value"] for r in eval_metrics(df).collect()}
    assert m[(None, "teaching_quality_score")] == 4.0
    assert m[("a", "teaching_quality_a")] == 1.5 and m[("b", "teaching_quality_b")] == 4.0
    assert not any(k[1] == "teaching_quality_None" for k in m) and len(m) == 6


def test_metrics_record_edge(spark):
    from critloom.operators.aggregate import metrics_record
    df = spark.createDataFrame([(1, "score", 2.0), (1, "x", 4.0)], "step long, category string, score double")
    rec = metrics_record(eval_metrics(df)).first()
    assert rec["metrics"]["teaching_quality_score"] == 2.0     # the category called "score" wins
    assert rec["metrics"]["teaching_quality_x"] == 4.0 and rec["metrics"]["teaching_quality_max"] == 4.0


def test_record_blocks_are_bounded_and_in_order(spark):
    from critloom.plans.evaluate import details_record, record_blocks
    rows = [(s, o, f"p{o}", f"r{s}-{o}", f"j{o}", float(o % 10)) for s in (1, 2) for o in range(3, 60 if s == 1 else 9, 2)]
    rows += [(1, 7, "p7", "again", "j", None), (None, 1, "p", "r", "j", 1.0)]
    df = spark.createDataFrame(rows, "step long, ord long, prompt string, response string, judgment string, score double").repartition(5)
    got = sorted(record_blocks(df, block_rows=10).collect(), key=lambda r: (r.step is None, r.step or 0, r.block))
    assert [(r.step, r.block, len(r.prompts)) for r in got] == [(1, 0, 10), (1, 1, 10), (1, 2, 10), (2, 0, 3), (None, 0, 1)]
    for whole in details_record(df).collect():
        mine = [r for r in got if r.step == whole.step]
        assert [p for r in mine for p in r.prompts] == whole.prompts and [x for r in mine for x in r.scores] == whole.scores or whole.step == 1
        assert sorted(x for r in mine for x in r.responses) == sorted(whole.responses)


def test_metrics_of_histograms_equal_metrics_of_rows(spark):
    from critloom.operators.aggregate import eval_metrics, metrics_of_counts, score_counts
    rows = [(s, c, x) for s in (1, 2) for c, x in (("a", 4.0), ("a", 4.0), ("b", 9.5), (None, 1.0), ("", 3.0), ("c", None))]
    rows += [(3, "a", None), (4, "a", 7.0), (4, "a", 7.0), (4, "a", 7.0)]
    df = spark.createDataFrame(rows, "step long, category string, score double")
    want = sorted((r.step, r.category or "", r.metric, r.value if r.value is None else round(r.value, 9)) for r in eval_metrics(df).collect())
    parts = [score_counts(df.filter(f), "step") for f in ("score > 4 OR score IS NULL", "score <= 4")]  # counted apart, then added up
    got = metrics_of_counts(parts[0].unionByName(parts[1])).collect()
    assert sorted((r.step, r.category or "", r.metric, r.value if r.value is None else round(r.value, 9)) for r in got) == want


def test_a_late_row_reads_its_block_only_and_replays_change_nothing(spark, tmp_dir):
    import os

    from critloom.operators.model import StubJudge
    from critloom.plans import evaluate as E
    det, met, cnt = (os.path.join(tmp_dir, d) for d in ("details", "metrics", "counts"))
    schema = "step long, ord long, prompt string, category string, response string"
    rows = [(1, o, f"q{o}", "ab"[o % 2], f"r{o}") for o in range(50)]
    add = E.add_details.__defaults__
    try:
        E.add_details.__defaults__ = (None, 10)
        E.eval_history(spark.createDataFrame(rows, schema), StubJudge(), det, met, counts_path=cnt)
        before = {d: sorted(os.listdir(os.path.join(det, "step=1", d))) for d in os.listdir(os.path.join(det, "step=1"))}
        assert len(before) == 5
        late = [(1, 23, "q23", "b", "another answer"), (1, 51, "q51", None, "late")]
        for _ in range(2):                                                        # the second time as a replay
            m, d = E.eval_history(spark.createDataFrame(late, schema), StubJudge(), det, met, counts_path=cnt)
        after = {d: sorted(os.listdir(os.path.join(det, "step=1", d))) for d in os.listdir(os.path.join(det, "step=1"))}
        assert {k for k in before if after[k] != before[k]} == {"block=2"} and set(after) - set(before) == {"block=5"}
        rows = [r for r in rows if r[1] != 23] + late
        want, _ = E.eval_history(spark.createDataFrame(rows, schema), StubJudge())
        flat = lambda x: sorted((r.step, r.category or "", r.metric, round(r.value, 9)) for r in x.collect())
        assert flat(m) == flat(want) == flat(spark.read.parquet(met))
        assert d.count() == 51 and d.filter("ord = 23").first().response == "another answer"
    finally:
        E.add_details.__defaults__ = add
