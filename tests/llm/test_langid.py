"""Bundles against naive binding, held-out accuracy, edge cases."""

from llm_fixtures import SF_SMALL, docs  # noqa: F401
import numpy as np
from pyspark.sql import functions as F

from critloom.llm import langid
from critloom.llm.common import crc_mod
from critloom.llm.queries import op7_language_id


def naive(text, dimensions):
    """One letter at a time, with a vector for each."""
    points = [0]
    for c in text.lower():
        p = ord(c) if c.isalpha() else 0
        if p or points[-1]:
            points.append(p)
    if points[-1]:
        points.append(0)
    v = {p: langid.letter_vectors(np.array([p]), dimensions)[0] for p in set(points)}
    total = np.zeros(dimensions)
    for a, b, c in zip(points, points[1:], points[2:]):
        if b:
            total += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    return total


TEXTS = ["", "Été à la mer!", "a", "123", "  x  yz ", "straße ÄÖ", "日本語 text", "no-one's\nhere", "İstanbul"]


def test_bundles_equal_naive_binding(monkeypatch):
    sums, has = langid.bundle(TEXTS, 64)
    assert np.array_equal(sums, np.array([naive(t, 64) for t in TEXTS]))
    assert has.tolist() == [any(ch.isalpha() for ch in t) for t in TEXTS]
    monkeypatch.setattr(langid, "CELLS", 1)
    assert np.array_equal(langid.bundle(TEXTS, 64)[0], sums)


def test_every_letter_has_a_vector_of_its_own():
    points = np.flatnonzero(langid.is_letter())
    v = langid.letter_vectors(points, 128)
    assert set(np.unique(v)) == {-1, 1} and abs(v.mean()) < 0.01
    assert len(np.unique(np.packbits(v > 0, axis=1), axis=0)) == len(points)
    some = langid.letter_vectors(np.array([ord(c) for c in "ékäfößa"]), langid.DIMENSIONS).astype(int)
    assert np.abs(some @ some.T - langid.DIMENSIONS * np.eye(len(some), dtype=int)).max() < 200  # nearly orthogonal


def test_predictions_equal_brute_force(spark, docs):
    """Prototypes, cosine and ties by the definition."""
    train = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat", "en"), ("le chat été", "fr"), ("die Katze über", "de"),
                                                          ("the hat", "en"), ("le chat été", "ga"), (None, "de"), ("xx", None)])]
    asked = [(100 + i, t) for i, t in enumerate([*TEXTS, "the", "chat", "über Katzen", "zzz", "le chat été"])]
    protos = {}
    for _, t, lang in train:
        if t is not None and lang is not None:
            protos[lang] = protos.get(lang, 0) + naive(t, langid.DIMENSIONS)
    want = {}
    for i, t in asked:
        v = naive(t, langid.DIMENSIONS)
        cos = {k: v @ p / max(np.linalg.norm(v) * np.linalg.norm(p), 1e-9) for k, p in protos.items()}
        best = min(cos, key=lambda k: (-round(cos[k], 6), k))
        want[i] = (best, max(0.0, cos[best])) if any(c.isalpha() for c in t) else ("und", 0.0)
    d = docs(train + [(i, t, "zz") for i, t in asked])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(d, F.col("doc_id") < 100).collect() if r.doc_id >= 100}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-5 for k in want)


def test_any_number_of_languages(spark, docs, monkeypatch):
    import random
    r = random.Random(5)
    rows = [(i, "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=12)), f"l{i:02d}") for i in range(45)]
    want = {x.doc_id: (x.lang_pred, round(x.score, 5)) for x in langid.identify(docs(rows), F.lit(True)).collect()}
    assert {k: v[0] for k, v in want.items()} == {i: lang for i, _, lang in rows}
    monkeypatch.setattr(langid, "BLOCK", 10)
    got = {x.doc_id: (x.lang_pred, round(x.score, 5)) for x in langid.identify(docs(rows), F.lit(True)).collect()}
    assert got == want


def test_held_out_accuracy(spark):
    sf = f"{SF_SMALL}/../sf0.01"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    got = op7_language_id(spark, sf)
    assert got.count() == d.count()
    right = got.join(d, "doc_id").where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.95 and 0 <= right[1] and right[2] <= 1


def test_prediction_reads_the_text_only(spark):
    sf = f"{SF_SMALL}/../sf0.01"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    train = crc_mod("doc_id", 3) != 1
    base = {r.doc_id: r.lang_pred for r in langid.identify(d, train).collect()}
    changed = d.withColumn("lang", F.when(train, F.col("lang"))).withColumn("source", F.lit("x"))
    assert {r.doc_id: r.lang_pred for r in langid.identify(changed, train).collect()} == base


def test_edges(spark, docs):
    rows = [(1, "the cat and the hat", "en"), (2, "der hund und die katze", "de"), (3, None, "de"), (4, "", "en"), (5, "12 34!", "en"),
            (None, "und der", None), (None, "und der", None), (8, "the " * 400_000, "en")]
    d = docs(rows).withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit(1))
    got = langid.identify(d, F.col("doc_id") < 8).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[3] == by[4] == by[5] == ("und", 0.0) and by[None][0] == "de" and by[8][0] == "en" and by[1][0] == "en"
    assert {r.lang_pred for r in langid.identify(d, F.lit(False)).collect()} == {"und"}
    assert langid.identify(docs([]), F.lit(True)).count() == 0
