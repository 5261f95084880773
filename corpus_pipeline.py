"""The corpus pipeline: quality, near-duplicates, benchmark decontamination, personal data, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of their input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from critloom.llm import gbdt, mixing, pii, simhash, winnow
from critloom.llm.common import crc_mod, read, stage

ORACLE_SQL = None  # trained trees and SimHash cannot be expressed in SQL


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with columns c0, c1, …, so that no other column can clash with an operator's."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def _at(docs: DataFrame, column: str) -> str:
    return f"c{docs.columns.index(column)}"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from the labels of the documents at hand.

    Without usable labels of both kinds (none matches, or all are null, contradicting or held out)
    no model can be fitted, and every document stays."""
    model = gbdt.train(docs, read(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    if not len(model.feature):  # no tree
        return docs
    scored = gbdt.classify(_plain(docs), model, _at(docs, "text"))
    return scored.where("predicted = 1").drop("score", "predicted").toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints stays: the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of the benchmark go."""
    plain = _plain(docs)
    found = winnow.contamination(plain, read(spark, sf_dir, "benchmark"), _at(docs, "doc_id"), _at(docs, "text"),
                                 carried=tuple(plain.columns))
    return found.where("n_hit = 0").select(*plain.columns).toDF(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are replaced in the texts; every document stays."""
    plain, text = _plain(docs), _at(docs, "text")
    done = pii.sanitise(plain, text, keep_text=False).withColumnRenamed("sanitised", text)
    return done.select(*plain.columns).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents taken at least once, with their number of copies."""
    mixed = mixing.mix(docs, carried=tuple(docs.columns))
    return mixed.where("copies > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again in the shared stage folder."""
    docs = read(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), "pipeline_" + name.split()[0].lower())
    return docs
