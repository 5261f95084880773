"""Language identification with hyperdimensional n-gram profiles."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow, mix64, row_numbers, stage

DIMENSIONS = 1024
BLOCK = 1000          # languages whose prototypes are sent at once: at most this many times DIMENSIONS numbers
SEED = 20240607
CELLS = 2_000_000     # counts (texts x trigrams) held at once
_TABLE: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _TABLE:
        table = np.zeros(0x110000, bool)
        table[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"]] = True
        _TABLE.append(table)
    return _TABLE[0]


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """A random vector of ±1 for each code point, made from a seeded hash of it (0, a run of non-letters,
    has one too), so every letter has its own and none is kept."""
    words = -(-dimensions // 64)
    key = points.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
    bits = np.unpackbits(mix64(key + np.uint64(SEED)).view(np.uint8), axis=1)[:, :dimensions]
    return bits.astype(np.int8) * 2 - 1


def gram_vectors(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bind: the first letter's vector rotated twice, the second's once and the third's, multiplied.
    A code numbers three rows of ``letters``."""
    k = len(letters)
    a, b, c = codes // (k * k), codes // k % k, codes % k
    return (np.roll(letters, 2, axis=1)[a] * np.roll(letters, 1, axis=1)[b] * letters[c]).astype(np.float32)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, trigram code) of every letter trigram, the code points that the codes number, and
    whether each text has a letter.

    Texts are lower-cased; a run of non-letters counts as one symbol, before and after the text too."""
    joined = "\n".join(["", *(x.lower() for x in texts), ""])
    point = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    point = np.where(is_letter()[point], point, 0)
    ends = np.cumsum([1] + [len(x.lower()) + 1 for x in texts])
    keep = np.flatnonzero((point > 0) | (np.concatenate([[1], point[:-1]]) > 0))
    known = np.zeros(0x110000, bool)
    known[point[keep]] = known[0] = True
    points = np.flatnonzero(known)
    number = np.zeros(0x110000, np.int64)
    number[points] = np.arange(len(points))
    s = number[point[keep]]
    code = (s[:-2] * len(points) + s[1:-1]) * len(points) + s[2:]
    who = np.searchsorted(ends, keep[1:-1], side="right") - 1  # the text of the middle symbol
    inner = (s[1:-1] > 0)
    has = np.bincount(who[inner], minlength=len(texts)) > 0 if len(s) > 2 else np.zeros(len(texts), bool)
    return who[inner], code[inner], points, has


def bundle(texts: list[str], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the trigram vectors of each text (texts, dimensions), and whether it has a letter."""
    who, code, points, has = trigrams(texts)
    known, at = np.unique(code, return_inverse=True)
    vectors, out = gram_vectors(known, letter_vectors(points, dimensions)), np.zeros((len(texts), dimensions), np.float32)
    rows = max(1, CELLS // max(1, len(known)))  # texts whose counts are held at once
    for i in range(0, len(texts), rows):
        a, z = np.searchsorted(who, [i, i + rows])
        n = min(rows, len(texts) - i)
        counts = np.bincount((who[a:z] - i) * len(known) + at[a:z], minlength=n * len(known)).reshape(n, len(known))
        out[i:i + n] = counts.astype(np.float32) @ vectors
    return out, has


def prototypes(docs: DataFrame, text_col: str, lang_col: str, dimensions: int) -> DataFrame:
    """(lang, i, x): per language, the bundle of all its trigrams; tasks add up vectors before the shuffle; staged."""
    def out(held):
        for lang, total in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions, pa.string()), pa.array(np.arange(dimensions, dtype=np.int32)),
                                              pa.array(np.rint(total).astype(np.int64))], ["lang", "i", "x"])

    def run(batches):
        held = {}
        for b in batches:
            langs, texts = b.column(1).to_pylist(), [x or "" for x in b.column(0).to_pylist()]
            for i, j in chunks(texts):
                sums, _ = bundle(texts[i:j], dimensions)
                for r, lang in enumerate(langs[i:j]):
                    held[lang] = held.get(lang, 0) + sums[r].astype(np.float64)
                if len(held) > BLOCK:
                    yield from out(held)
                    held = {}
        yield from out(held)

    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    part = map_arrow(known.select(F.col(text_col).alias("_t"), F.col(lang_col).cast("string").alias("_l")), run,
                     "lang string, i int, x bigint")
    return stage(part.groupBy("lang", "i").agg(F.sum("x").alias("x")), "prototypes")


def _block(proto: DataFrame, names: DataFrame, number: int, dimensions: int) -> tuple[np.ndarray, list[str]]:
    """Unit prototypes and names of the languages numbered from ``number * BLOCK`` on, in order."""
    some = names.where((F.col("k") >= number * BLOCK) & (F.col("k") < (number + 1) * BLOCK))
    rows = proto.join(F.broadcast(some), "lang").toPandas()  # BLOCK * dimensions rows at most
    langs = sorted(rows["lang"].unique())
    out = np.zeros((len(langs), dimensions))
    out[rows["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(np.int64), rows["i"].to_numpy(np.int64)] = rows["x"]
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1)).astype(np.float32), langs


def identify(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             dimensions: int = DIMENSIONS, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``(<id>, carried, lang_pred, score)``.

    ``train`` marks the rows to learn prototypes from (null: no); among them null languages and
    null texts are left out. Prototypes and texts are compared by cosine; score is the best
    cosine, at least 0. ``und`` with score 0 for null texts, texts without a letter, and when
    nothing was learned; ties go to the first language by name. Every letter has a vector of its own. Any
    number of languages is compared: ``BLOCK`` of them are sent at once, and each further block is one more
    pass over the texts, which keeps the best so far. Repeated rows and null ids are
    scored as they come; an empty table gives no rows; only the named columns are read."""
    proto = prototypes(docs.where(F.coalesce(train, F.lit(False))), text_col, lang_col, dimensions)
    names = row_numbers(proto.select("lang").distinct(), [F.col("lang")], "k")
    blocks = max(1, -(-names.count() // BLOCK))
    cols = [id_col, *carried]
    done = docs.select(F.col(text_col).alias("_t"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)],
                       F.lit("und").alias("_lang"), F.lit(-1.0).alias("_cos"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in done.schema.fields[:-2]) + "_lang string, _cos double"
    for number in range(blocks):
        model = docs.sparkSession.sparkContext.broadcast(_block(proto, names, number, dimensions))

        def run(batches, model=model):
            proto, langs = model.value
            for b in batches:
                texts = [x or "" for x in b.column(0).to_pylist()]
                best, scores = b.column("_lang").to_pylist(), b.column("_cos").to_numpy().copy()
                for i, j in chunks(texts) if langs else ():
                    sums, has = bundle(texts[i:j], dimensions)
                    cos = (sums @ proto.T) / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
                    at, top = cos.argmax(axis=1), cos.max(axis=1)
                    for r in np.flatnonzero(has & (top > scores[i:j])):
                        best[i + r], scores[i + r] = langs[at[r]], top[r]
                yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(best, pa.string()), pa.array(scores)], b.schema.names)

        done = map_arrow(done, run, kinds)
        if blocks > 1:
            done = stage(done, "languages")
    return done.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(cols)], F.col("_lang").alias("lang_pred"),
                       F.greatest(F.least("_cos", F.lit(1.0)), F.lit(0.0)).alias("score"))
