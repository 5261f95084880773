"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, raw_texts

MAX_LABELLED = 20_000  # labelled rows the model is fitted on (those with the smallest hash of their id)
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.2
MIN_ROWS, L2 = 5, 1.0
CUT = 0.7              # predicted is 1 from this score on

FEATURES = ("log_words", "mean_word", "max_word", "symbols", "marks", "upper", "digits", "spaces", "lines_per_word",
            "distinct_words", "top_word", "repeated_lines", "repeated_5grams", "non_ascii", "entropy", "bare_words",
            "letters", "mean_line")
_BYTES = np.arange(256)
_SYMBOLS = np.isin(_BYTES, list(b"#*$%&|<>"))
_MARKS = np.isin(_BYTES, list(b".,;:!?\"'()[]{}-_/"))
_UPPER, _LOWER = (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122)
_DIGITS, _SPACES = (_BYTES >= 48) & (_BYTES <= 57), np.isin(_BYTES, [32, 9, 10, 11, 12, 13])


def statistics(raw: bytes) -> list[float]:
    """The features of one text, over all of it. An empty text gives zeros."""
    words = raw.lower().split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    total = len(raw)
    p = byte[byte > 0] / total
    upper, lower, high = byte[_UPPER].sum(), byte[_LOWER].sum(), byte[128:].sum()
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    grams = n - 4
    repeated = 1 - len(set(zip(words, words[1:], words[2:], words[3:], words[4:]))) / grams if grams > 0 else 0.0
    sizes = [len(w) for w in words]
    return [float(np.log1p(n)), sum(sizes) / n, float(max(sizes)), byte[_SYMBOLS].sum() / total, byte[_MARKS].sum() / total,
            upper / max(1, upper + lower), byte[_DIGITS].sum() / total, byte[_SPACES].sum() / total, len(lines) / n,
            len(seen) / n, max(seen.values()) / n, 1 - len(set(lines)) / len(lines), repeated, high / total,
            float(-(p * np.log2(p)).sum()), sum(w.isalpha() for w in words) / n, (upper + lower + high) / total,
            total / len(lines)]


class Trees:
    """Complete binary trees of one depth in flat arrays: ``feature`` and ``cut`` (trees, inner nodes), ``leaf`` (trees, leaves)."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, depth: int):
        self.base, self.feature, self.cut, self.leaf, self.depth = base, feature, cut, leaf, depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of ``x``: all trees and rows go down level by level together."""
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
        margin = self.base + self.leaf[trees, node - (2**self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boost on logistic loss: per level, one histogram of gradients per (node, feature, bin); best gain splits.

    With no rows, or one class only, the score is a constant (½, or the smoothed share)."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    inner, feature, cut, leaf = 2**depth - 1, [], [], []
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])] if len(x) else []
    code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) if len(x) else None
    margin = np.full(len(y), base)
    for _ in range(trees if len(x) and 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feat, thr, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            best = np.full(width, 1e-9)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                k = len(e) + 1
                slot = at * k + code[:, f]
                hg = np.bincount(slot, g, width * k).reshape(width, k).cumsum(axis=1)
                hh = np.bincount(slot, h, width * k).reshape(width, k).cumsum(axis=1)
                hn = np.bincount(slot, minlength=width * k).reshape(width, k).cumsum(axis=1)
                gl, hl, nl = hg[:, :-1], hh[:, :-1], hn[:, :-1]
                gt, ht, nt = hg[:, -1:], hh[:, -1:], hn[:, -1:]
                gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
                gain[(nl < MIN_ROWS) | (nt - nl < MIN_ROWS)] = -1
                j = gain.argmax(axis=1)
                top = gain[np.arange(width), j]
                better = top > best
                best[better] = top[better]
                feat[first:first + width][better] = f
                thr[first:first + width][better] = e[j[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feat[node]] > thr[node])
        at = node - inner
        value = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + L2)
        margin += value[at]
        feature.append(feat), cut.append(thr), leaf.append(value)
    shape = (len(feature), inner)
    return Trees(base, np.array(feature, np.int64).reshape(shape), np.array(cut).reshape(shape),
                 np.array(leaf).reshape(len(leaf), inner + 1), depth)


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Trees:
    """Fit on the labelled rows of ``usable`` (a condition on the id), at most ``max_labelled`` of them.

    Which ones is decided by a hash of the id; ids with contradicting labels and null labels are
    left out, and an id that several documents share counts once (the smallest text). Only ids
    travel (a bounded broadcast) and only features reach the driver."""
    known = (labels.where(F.coalesce(usable, F.lit(False)) & F.col(label_col).isNotNull()).groupBy(id_col)
             .agg(F.min(label_col).alias("_lo"), F.max(label_col).alias("_hi")).where("_lo = _hi")
             .select(id_col, F.col("_lo").cast("int").alias("_y"))
             .orderBy(F.xxhash64(id_col), id_col).limit(max_labelled))
    rows = (docs.select(id_col, F.col(text_col).alias("_t")).join(F.broadcast(known), id_col)
            .groupBy(id_col).agg(F.min("_t").alias("_t"), F.first("_y").alias("_y")).select("_t", "_y"))

    def run(batches):
        for b in batches:
            x = pa.array([statistics(t) for t in raw_texts(b.column(0))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, b.column(1)], ["x", "y"])

    got = map_arrow(rows, run, "x array<double>, y int").toPandas()
    order = np.lexsort((got["y"], got["x"].map(lambda v: tuple(v)).rank(method="dense"))) if len(got) else []
    x = np.array([got["x"].iloc[i] for i in order], float).reshape(len(got), len(FEATURES))
    return fit(x, got["y"].to_numpy(float)[order] if len(got) else np.zeros(0))


def classify(docs: DataFrame, model: Trees, text_col: str = "text", cut: float = CUT,
             names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with a score (0 to 1) and a prediction (1 if score >= cut, else 0), row by row.

    Null texts score like empty ones; repeated rows and nulls in other columns do not matter; an
    empty table stays empty. Columns of the input called like ``names`` are replaced."""
    kept = [c for c in docs.columns if c not in names]
    picked = docs.select(*kept) if text_col in kept else docs.select(*kept, text_col)
    at, sent = picked.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            raw, scores = raw_texts(b.column(at)), []
            for i in range(0, len(raw), 512):
                scores.append(sent.value.score(np.array([statistics(t) for t in raw[i:i + 512]])))
            s = np.concatenate(scores or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], pa.array(s), pa.array((s >= cut).astype(np.int32))],
                                             [*kept, *names])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)
    return map_arrow(picked, run, f"{kinds}`{names[0]}` double, `{names[1]}` int")
