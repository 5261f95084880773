"""Context-tree weighting against direct recursion; the unigram baseline; edge cases."""

import math
import zlib
from collections import Counter

from llm_fixtures import SF_SMALL, docs  # noqa: F401
import numpy as np
import pytest
from pyspark.sql import functions as F

from critloom.llm import ctw
from critloom.llm.queries import op4_lm_scoring


def kt(bits):
    n, p = [0, 0], 0.0
    for b in bits:
        p += math.log((n[b] + 0.5) / (n[0] + n[1] + 1))
        n[b] += 1
    return p


def weighted(seq, depth, d=0):
    """log P_w of (context, bit) pairs by the definition: half the KT estimate, half the split by one more byte."""
    here = kt([b for _, b in seq])
    if d == depth:
        return here
    parts = {}
    for c, b in seq:
        parts.setdefault(c[-1 - d], []).append((c, b))
    return float(np.logaddexp(here, sum(weighted(p, depth, d + 1) for p in parts.values()))) - math.log(2)


def brute_log10(train, context, byte, depth):
    total = 0.0
    pairs = [(b"\n" * depth + t)[i:i + depth + 1] for t in train for i in range(len(t))]
    for level in range(8):
        prefix, bit = byte >> (8 - level), (byte >> (7 - level)) & 1
        seq = [(p[:-1], (p[-1] >> (7 - level)) & 1) for p in pairs if p[-1] >> (8 - level) == prefix]
        total += weighted([*seq, (context, bit)], depth) - weighted(seq, depth)
    return total / math.log(10)


@pytest.mark.parametrize("depth", [1, 2])
def test_scores_equal_the_weighting_by_definition(spark, depth):
    train = [b"abracadabra", b"a bar a car", b"", "é b".encode()]
    tree = ctw.fit(spark.createDataFrame([(t.decode(),) for t in train], "text string"), depth=depth, max_nodes=10**6)
    for text in (b"abra", b"zebra", b"a", "é".encode()):
        padded = b"\n" * depth + text
        want = sum(brute_log10(train, padded[i:i + depth], text[i], depth) for i in range(len(text)))
        assert tree.score([text])[0] == pytest.approx(want, rel=1e-4)


@pytest.mark.parametrize("max_nodes", [3, 50, 10**6])
def test_probabilities_sum_to_one(spark, max_nodes):
    tree = ctw.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(30), depth=2, max_nodes=max_nodes)
    assert np.allclose((10.0 ** tree.logp.astype(float)).sum(axis=1), 1, atol=1e-4)


def test_query_against_plain_counts(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    words = {i: [*t.encode().lower().split(), None] for i, t in rows.items()}
    count = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    got = op4_lm_scoring(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        ws = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(w in count for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
    new = [r for r in got if r.held_out and rows[r.doc_id]]
    assert np.mean([r.bits_per_byte for r in new]) < 4  # a uniform byte costs 8


def test_rare_tokens_take_the_join(spark, docs, monkeypatch):
    d = docs([(1, "a a a b"), (2, "A c"), (3, "d a"), (4, None), (None, "a")])
    usual = {r.doc_id: r for r in ctw.score(d, F.col("doc_id") < 3).collect()}
    monkeypatch.setattr(ctw, "FREQUENT", 2)  # only tokens with half of all are broadcast
    for r in ctw.score(d, F.col("doc_id") < 3).collect():
        assert (r.n_known, r.n_tokens) == (usual[r.doc_id].n_known, usual[r.doc_id].n_tokens)
        assert r.base_score == pytest.approx(usual[r.doc_id].base_score)


def test_edges(spark, docs):
    d = docs([(1, ""), (2, None), (3, "x"), (3, "x"), (4, "y" * 3_000_000)]).withColumn("score", F.lit("clash")).withColumn("rare", F.lit(0))
    rows = ctw.score(d, F.lit(False)).collect()  # nothing to learn from
    assert len(rows) == 5 and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1].score == by[2].score == 0 and by[1].bits_per_byte is None and by[3].bits_per_byte == pytest.approx(8)
    assert by[4].n_bytes == 3_000_000
    assert ctw.score(docs([]), F.lit(True)).count() == 0


@pytest.mark.parametrize("top", [0, 200, 10**6])
def test_every_context_counts_however_rare(spark, top):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    train = F.col("doc_id") % 5 != 0
    tree = ctw.fit(d.where(train), depth=3, max_nodes=10**9)  # no context is left out
    texts = {r.doc_id: (r.text or "").encode() for r in d.collect()}
    got = {r.doc_id: r.score for r in ctw.score(d, train, depth=3, top=top).collect()}
    assert got == pytest.approx({i: tree.score([t])[0] for i, t in texts.items()}, rel=1e-4)


def test_deep_contexts_equal_the_weighting_by_definition(spark, docs):
    train = ["abracadabra abracadabra", "a bar a car", ""]
    rows = [*enumerate(train), (10, "abracadabra"), (11, "zebra é")]
    got = {r.doc_id: r.score for r in ctw.score(docs(rows), F.col("doc_id") < 10).collect()}
    raw = [t.encode() for t in train]
    for i, text in rows[3:]:
        padded = b"\n" * ctw.DEPTH + text.encode()
        want = sum(brute_log10(raw, padded[k:k + ctw.DEPTH], padded[k + ctw.DEPTH], ctw.DEPTH) for k in range(len(text.encode())))
        assert got[i] == pytest.approx(want, rel=1e-4)


def test_grams_are_shuffled_in_blocks(spark, docs, monkeypatch):
    letters = np.random.default_rng(2).choice([*"abcdefgh é"], (40, 400))
    d = docs([(-1, None), (-2, ""), *enumerate("".join(x) for x in letters)]).coalesce(1)
    frames, plain = [], ctw.map_arrow
    monkeypatch.setattr(ctw, "map_arrow", lambda *a: frames.append(plain(*a)) or frames[-1])
    got = {r.code: (r.n, r.m) for r in ctw.gram_table(d, F.col("doc_id") % 5 != 0, "text", 6).collect()}
    want = {True: Counter(), False: Counter()}
    for r in d.collect():
        padded = b"\n" * 6 + (r.text or "").encode()
        want[r.doc_id % 5 != 0].update(int.from_bytes(padded[i:i + 7]) for i in range(len(padded) - 6))
    assert got == {c: (want[True][c], want[True][c] + want[False][c]) for c in want[True] | want[False]}
    assert frames[0].count() <= 2 ** 12 < len(got)  # rows that one counting task hands to the shuffle


def test_blocks_keep_buckets_whole_over_batches(monkeypatch):
    monkeypatch.setattr(ctw, "HELD_GRAMS", 100)
    ids = np.random.default_rng(1).integers(0, 3000, 20_000)
    key, n = ctw._merge([(ctw._spread(ids[i::4]), np.ones(5000, np.int64)) for i in range(4)])
    once = [b for b in ctw._blocks(key, n=n)]
    rows = sorted((b.slice(i, 1) for b in [*once, *once] for i in range(b.num_rows)), key=lambda r: r["bucket"][0].as_py())
    sums = [*ctw._sums(rows, "n")]
    assert len(sums) > 1
    got = [(int(i), int(k)) for part, v in sums for i, k in zip(ctw._gather(part), v)]
    assert len(got) == len(dict(got)) and dict(got) == {i: 2 * k for i, k in Counter(ids.tolist()).items()}
