"""The pipeline's stages: contracts of each, decisions on planted documents, edge cases."""

from llm_fixtures import SF_SMALL, docs  # noqa: F401
import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from critloom.llm.common import stage

SF = f"{SF_SMALL}/../sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, fn in P.STAGES:
        before, docs = docs, stage(fn(spark, docs, SF), "test")
        out[name.split()[0].lower()] = (before, docs)
    return out


def test_order_and_registration():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "PII", "mixing sources to target weights"]
    assert E.queries()["pipeline"] is P.run and ("pipeline" in E.oracle_sql()) == (P.ORACLE_SQL is not None)


def test_all_but_the_last_return_documents(stages, spark):
    want = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(out.columns == want for name, (_, out) in stages.items() if name != "mixing")


def test_quality_keeps_good_documents(stages, spark):
    before, after = stages["quality"]
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    good, bad = (before.join(lab.where(f"quality = {q}"), "doc_id", "left_semi") for q in (1, 0))
    assert good.join(after, "doc_id", "left_anti").count() <= 0.02 * good.count()
    assert bad.join(after, "doc_id", "left_semi").count() <= 0.2 * bad.count()


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash"]
    from critloom.llm.simhash import near_duplicates

    groups = {r.component_id for r in near_duplicates(before).collect()}
    assert {r.doc_id for r in after.select("doc_id").collect()} == groups and after.count() == len(groups)


def test_contaminated_documents_go_and_others_stay(stages, spark):
    before, after = stages["benchmark"]
    from critloom.llm.winnow import contamination

    hits = {r.doc_id: r.n_hit for r in contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, n in hits.items() if n == 0} and any(hits.values())


def test_personal_data_is_replaced_and_no_document_goes(stages):
    before, after = stages["pii"]
    from critloom.llm.pii import base_spans

    old = {r.doc_id: r.text for r in before.collect()}
    new = {r.doc_id: r.text for r in after.collect()}
    assert old.keys() == new.keys() and any(base_spans(t) for t in old.values())
    assert not any(base_spans(t) for t in new.values())


def test_mix_and_run(stages, spark):
    before, after = stages["mixing"]
    rows = after.collect()
    assert rows and all(1 <= r.copies <= 3 and r.taken == r.copies * r["size"] for r in rows)
    again = {(r.doc_id, r.taken) for r in P.run(spark, SF).select("doc_id", "taken").collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_empty_null_repeated_and_clashing_rows(spark, docs):
    rows = [(None, None, None, None), (1, "plain text with ordinary words in it", "en", "a"), (1, "plain text with ordinary words in it", "en", "a"), (2, "", "en", None)]
    clash = docs(rows)
    for c in ("score", "predicted", "n_words", "items", "spans", "size", "component_id", "_row", "node"):
        clash = clash.withColumn(c, F.lit("x"))
    for start in (clash, clash.limit(0)):
        d = start
        for name, fn in P.STAGES:
            d = stage(fn(spark, d, SF), "test")
            if not name.startswith("mixing"):
                assert d.columns == start.columns
        if not start.take(1):
            assert d.count() == 0


@pytest.mark.parametrize("quality", [None, "null", "unmatched"])
def test_without_usable_labels_every_document_stays(spark, docs, tmp_path, quality):
    rows = {None: "limit 0", "null": "limit 1", "unmatched": "limit 1"}[quality]
    value, doc = ("CAST(NULL AS INT)", 1) if quality == "null" else ("1", -7)
    spark.sql(f"SELECT CAST({doc} AS BIGINT) AS doc_id, {value} AS quality {rows}").write.parquet(f"{tmp_path}/labels.parquet")
    d = docs([(1, "plain text with ordinary words in it"), (2, ""), (None, None)])
    assert sorted(map(str, P.quality(spark, d, str(tmp_path)).collect())) == sorted(map(str, d.collect()))
