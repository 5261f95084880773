"""Encoding and decoding against the sentencepiece library on whole texts, a naive merge loop, edge cases."""

import hashlib
import random

from llm_fixtures import SF_SMALL, docs  # noqa: F401
import public_tokenizers
import pytest
import sentencepiece

from critloom.llm import pieces
from critloom.llm.queries import op13_sentencepiece

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(MODEL)


def naive(v, text):
    """Look at all pairs, merge the best, start again."""
    symbols = list(text)
    while True:
        pairs = [(v.scores[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in v.scores]
        if not pairs:
            return symbols
        i = -max(pairs)[1]
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]


def random_texts(n, longest, seed):
    r = random.Random(seed)
    alphabet = [*"  ab▁\n\té日𐍈<s>\u0000�‍😀́½ﬁ019,.", "the", "ing", "  ", "tion"]
    return ["".join(r.choices(alphabet, k=r.randint(0, longest))) for _ in range(n)]


def test_agenda_equals_naive_merging(vocabulary):
    texts = [x for x in random_texts(300, 30, 1) if x] + ["▁the▁▁theory", "aaaaaaa", "x"]
    for x in texts:
        assert vocabulary.merge(x) == naive(vocabulary, x)
    ids = [[i for s in naive(vocabulary, x) for i in ([vocabulary.ids[s]] if s in vocabulary.ids else vocabulary.char_ids(s))] for x in texts]
    assert vocabulary.merge_all(texts) == ids


def test_random_and_long_texts_equal_the_library(vocabulary):
    r = random.Random(3)
    texts = [*random_texts(4000, 60, 2), "", " ", "▁", "a ", " a", "\n", "".join(r.choices("abcdefghij", k=60_000)),
             "word " * 30_000, "日本語" * 5_000, "▁▁ x", "<unk></s><0x41>"]
    ids, agrees = vocabulary.encode(texts)
    assert ids == LIBRARY.encode(texts) and all(agrees)
    assert [vocabulary.decode(x) for x in ids] == LIBRARY.decode(ids)


def test_a_small_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_HELD", 3)
    v, texts = pieces.Vocabulary(MODEL), random_texts(200, 40, 5)
    assert [v.encode([x])[0][0] for x in texts] == LIBRARY.encode(texts)


def test_a_difference_is_told(vocabulary):
    v = pieces.Vocabulary(MODEL)
    v.scores.pop("▁the"), v.held.clear()
    keep = v.joins != -1
    the = v.ids["▁the"]
    keep[:-1] &= v.joined[:-1] != the
    v.joins, v.joined, v.join_scores = v.joins[keep], v.joined[keep], v.join_scores[keep]
    ids, agrees = v.encode(["the cat", "a cat"])
    assert agrees == [False, True] and ids[0] != LIBRARY.encode("the cat")


def test_bytes_that_are_no_text_are_replaced(vocabulary):
    b = vocabulary.byte_ids
    for ids in ([b[0xE6], b[0x97]], [b[0x41], b[0xFF], vocabulary.ids["▁the"]], [1, vocabulary.ids["▁the"], 2], []):
        assert vocabulary.decode(ids) == LIBRARY.decode(ids)


def test_a_worker_keeps_its_words_from_task_to_task():
    v = pieces.own_vocabulary(MODEL)
    texts = [*random_texts(300, 60, 7), "x" * 100]
    want = LIBRARY.encode(texts)
    assert v.encode(texts)[0] == want and pieces.own_vocabulary(MODEL) is v
    held = dict(v.held)
    assert v.encode(texts[::-1])[0] == want[::-1]
    assert v.held == held and max(map(len, held)) <= pieces.SHORT  # nothing new, and long words are not remembered


def test_other_models_are_refused():
    word_model = b"\x12\x02\x18\x01"  # a unigram model
    with pytest.raises(ValueError):
        pieces.Vocabulary(word_model)


def test_query_equals_the_library_on_a_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op13_sentencepiece(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = LIBRARY.encode(r.text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(), True)
        assert tuple(got[r.doc_id])[1:] == want


def test_edges(spark, docs):
    rows = [(1, None), (2, ""), (3, "the cat"), (3, "the cat"), (None, "x"), (6, "the " * 300_000)]
    d = docs(rows).drop("lang").selectExpr("*", "1 AS ids", "'x' AS decoded")
    got = pieces.encode(d, MODEL).collect()
    assert sorted((r.doc_id or 0, len(r.ids), r.decoded[:7]) for r in got) == [
        (0, 1, "x"), (1, 0, ""), (2, 0, ""), (3, 2, "the cat"), (3, 2, "the cat"), (6, 300_001, "the the")]
    assert all(r.agrees for r in got)
    kept = pieces.encode(d, MODEL, carried=("source", "n_chars"))
    assert kept.columns == ["doc_id", "source", "n_chars", "ids", "decoded", "agrees"]
    assert pieces.encode(docs([]), MODEL).count() == 0
