"""Outputs conform to the declared schemas (names and types)."""

from critloom.operators.aggregate import eval_metrics
from critloom.operators.model import StubEchoModel, StubJudge, StubModel
from critloom.plans.evaluate import judged_eval
from critloom.plans.generate import GenerationConfig, generate_preferences
from critloom.schemas import JUDGEMENT_DETAILS, METRICS, PREFERENCES, QUESTIONS
from critloom.sources.tables import default_eval_examples, questions, questions_from_documents, read_table

from conftest import SF_SMALL


def _types(schema, names=None):
    return {f.name: f.dataType for f in schema.fields if names is None or f.name in names}


def test_metrics_and_details(spark):
    metrics, details = judged_eval(default_eval_examples(spark), StubEchoModel(), StubJudge(), step=5)
    assert _types(metrics.schema) == _types(METRICS)
    assert _types(details.schema, set(JUDGEMENT_DETAILS.fieldNames())) == _types(JUDGEMENT_DETAILS)
    assert _types(eval_metrics(details).schema) == _types(METRICS)


def test_questions_and_preferences(spark):
    q = questions_from_documents(read_table(spark, SF_SMALL, "documents"))
    assert _types(q.schema) == _types(QUESTIONS)
    prefs = generate_preferences(questions(q).limit(3), StubModel(), GenerationConfig())
    want = {n: t for n, t in _types(PREFERENCES).items() if n != "job_id"}
    assert _types(prefs.schema, set(want)) == want
