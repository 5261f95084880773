"""Shared spans against brute force, the guarantee on random words, edge cases."""

import random
import re

from llm_fixtures import docs  # noqa: F401
import pytest
from pyspark.sql import functions as F

from critloom.llm import winnow

ITEMS = "item_id string, text string"


def words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute(texts, items, window):
    out = []
    owners = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            owners.setdefault(tuple(w[i:i + n]), set()).add(item)
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in owners}:
            for i in range(len(w) - n + 1):
                own = owners.get(tuple(w[i:i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((len(w), len(hit), sorted(str(x) for x in found)))
    return out


def run(docs, spark, texts, items, **kw):
    got = winnow.contamination(docs(list(enumerate(texts))), spark.createDataFrame(items, ITEMS), **kw).collect()
    assert len(got) == len(texts)
    return [(r.n_words, r.n_hit, r["items"]) for r in sorted(got, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("seed,alphabet,window,k", [(1, 3, 10, 5), (2, 30, 10, 5), (3, 2, 4, 2), (4, 5, 6, 6), (5, 4, 5, 1)])
def test_random_texts(docs, spark, seed, alphabet, window, k):
    rnd = random.Random(seed)
    say = lambda n: " ".join(f"W{rnd.randrange(alphabet)}" for _ in range(n))
    items = [(f"i{i}", say(rnd.choice([0, 1, 3, window - 1, window, window + 1, 25]))) for i in range(12)]
    texts = [say(rnd.choice([0, 1, 5, 12, 60])) for _ in range(40)]
    for i in range(20):  # passages of the items inside other words
        w = items[rnd.randrange(12)][1].split()
        a = rnd.randrange(len(w) + 1)
        texts.append(f"{say(7)}, {' '.join(w[a:a + rnd.randrange(1, 30)]).upper()}; {say(9)}")
    assert run(docs, spark, texts, items, window=window, k=k) == brute(texts, items, window)


def test_special_texts(docs, spark):
    ten = "one two three four five six seven eight nine ten"
    items = [("9", ten), ("10", f"x {ten} y"), ("a", "Été ça"), ("b", None), ("c", ""), ("d", "!!!"), ("e", "été"), ("9", ten)]
    texts = [ten, ten.upper().replace(" ", "\x00"), ten.replace(" ", "-\n"), f"{ten} {ten}", ten[:-4], None, "", "!!!", "l'été ça va", "ÉTÉ",
             "étéx", ("filler " * 200_000) + ten, "one two"]
    got = run(docs, spark, texts, items)
    assert got == brute(texts, items, 10)
    assert got[0][2] == ["10", "9"]  # sorted as strings


def test_saturated_maps_stay_exact(docs, spark):
    rnd = random.Random(7)
    say = lambda n: " ".join(f"w{rnd.randrange(50)}" for _ in range(n))
    items, texts = [(f"i{i}", say(30)) for i in range(40)], [say(100) for _ in range(20)]
    texts += [items[3][1], items[4][1][4:]]
    assert run(docs, spark, texts, items, map_bits=6) == brute(texts, items, 10)  # every bit is set: the join alone decides


def test_edges(docs, spark):
    items = spark.createDataFrame([("i", "a b c")], ITEMS)
    d = docs([(None, "x a b c"), (None, "x a b c"), (1, None)]).withColumn("n_words", F.lit("clash")).withColumn("items", F.lit(0)).withColumn("w", F.lit(0))
    rows = winnow.contamination(d, items).collect()
    assert sorted((r.n_words, r.n_hit) for r in rows) == [(0, 0), (4, 3), (4, 3)]
    assert winnow.contamination(docs([]), items).count() == 0
    none = winnow.contamination(docs([(1, "a b c")]), items.limit(0)).collect()
    assert [(r.n_words, r.n_hit, r["items"], r.windows) for r in none] == [(3, 0, [], [])]
    same = winnow.contamination(docs([(1, "a b c")]), spark.createDataFrame([(None, "a b c"), ("z", "a b c")], ITEMS)).first()
    assert (same.n_hit, same["items"]) == (3, ["z"])  # an item without an id hits but has no name
