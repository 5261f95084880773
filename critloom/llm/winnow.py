"""Benchmark decontamination by winnowing: shared fingerprints are joined, extended and verified."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow, mix64, raw_texts, stage

WINDOW = 10        # words a shared span has at least
GRAM = 5           # words of a fingerprinted k-gram; WINDOW - GRAM + 1 k-grams share one minimum
MAP_BITS = 24      # the prefilter has 2**24 bits (2 MB), however many fingerprints there are
BASE = 0x9E3779B97F4A7C15 | 1
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of several texts, laid end to end: byte ranges, 64-bit hashes, first word of each text."""

    def __init__(self, raw: list[bytes]):
        joined = b"\n".join(raw)  # a line feed is no word character
        self.low = _LOWER[np.frombuffer(joined, np.uint8)]
        edge = np.diff(_WORD[self.low].astype(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.cumsum([0] + [len(x) + 1 for x in raw])
        self.first = np.searchsorted(self.starts, offsets)  # text r has words first[r] .. first[r+1]
        n = len(self.low)
        run = np.zeros(n + 1, np.uint64)
        np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n), out=run[1:])
        back = _powers(pow(BASE, -1, 1 << 64), n)
        self.hash = mix64((run[self.ends] - run[self.starts]) * back[self.starts] if n else np.zeros(0, np.uint64))
        self.last = np.repeat(self.first[1:], np.diff(self.first))  # end of its text, for each word

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k words from each word; NONE where the text ends before."""
        n = len(self.hash)
        out = np.full(n, NONE)
        if n >= k:
            h = np.zeros(n - k + 1, np.uint64)
            for j in range(k):
                h = h * np.uint64(BASE) + self.hash[j:n - k + 1 + j]
            h = np.minimum(mix64(h + np.uint64(k)), NONE - np.uint64(1))
            ok = np.arange(n - k + 1) + k <= self.last[:n - k + 1]
            out[:n - k + 1][ok] = h[ok]
        return out

    def minima(self, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Word positions and hashes of the smallest k-gram of every window of ``window`` words."""
        g, n, span = self.grams(k), len(self.hash), window - k + 1
        if n < window:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        m = n - window + 1
        at, low = np.arange(m), g[:m].copy()
        for j in range(1, span):
            less = g[j:m + j] < low
            low[less] = g[j:m + j][less]
            at[less] = (np.arange(m) + j)[less]
        at = np.unique(at[np.arange(m) + window <= self.last[:m]])
        return at, g[at]

    def text(self, i: int, n: int) -> str:
        return b" ".join(self.low[a:b].tobytes() for a, b in zip(self.starts[i:i + n], self.ends[i:i + n])).decode()


def _bit(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _held(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bit(h, len(bitmap).bit_length() + 2)  # the map has 8 bits a byte
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0


def _bitmap(marks: DataFrame, bits: int) -> np.ndarray:
    """The numbers in column ``b`` as a packed map of 2**bits bits (at most 2**(bits-6) rows come to the driver)."""
    words = (marks.groupBy(F.shiftright("b", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("m")).toPandas())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64)
    return out.view(np.uint8)


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int, k: int, bits: int = MAP_BITS) -> DataFrame:
    """(item, n, bit, mark, w) per word position of the items that starts a window or a fingerprint; staged.

    n, bit and w are the window's words in number, map bit and text (null where only a fingerprint
    starts); an item of fewer words is one window. mark is the fingerprint's map bit, if one starts."""
    def run(batches):
        for b in batches:
            raw = raw_texts(b.column(1))
            rows = {"item": [], "n": [], "bit": [], "mark": [], "w": []}
            for i, j in chunks(raw):
                t = Words(raw[i:j])
                g = {window: t.grams(window)}
                at, h = t.minima(window, k)
                for r in range(j - i):
                    a, z = int(t.first[r]), int(t.first[r + 1])
                    n = min(window, z - a)
                    if n == 0:
                        continue
                    marks = np.full(z - a, -1, np.int64)
                    own = (at >= a) & (at < z)
                    marks[at[own] - a] = _bit(h[own], bits)
                    hashes = g[window] if n == window else g.setdefault(n, t.grams(n))
                    item = b.column(0)[i + r].as_py()
                    for s in range(z - a):
                        whole = s <= z - a - n
                        if whole or marks[s] >= 0:  # the last fingerprints start behind the last window
                            rows["item"].append(item)
                            rows["n"].append(n if whole else None)
                            rows["bit"].append(int(_bit(hashes[a + s:a + s + 1], bits)[0]) if whole else None)
                            rows["mark"].append(int(marks[s]) if marks[s] >= 0 else None)
                            rows["w"].append(t.text(a + s, n) if whole else None)
            yield pa.RecordBatch.from_arrays([pa.array(rows["item"], b.column(0).type), pa.array(rows["n"], pa.int32()),
                                              pa.array(rows["bit"], pa.int64()), pa.array(rows["mark"], pa.int64()),
                                              pa.array(rows["w"], pa.string())], list(rows))

    kind = items.schema[id_col].dataType.simpleString()
    return stage(map_arrow(items.select(id_col, text_col), run, f"item {kind}, n int, bit bigint, mark bigint, w string"),
                 "bench_windows")


def candidates(docs: DataFrame, text_col: str, carried: list[str], fp_map, win_map, short: list[int], window: int,
               k: int) -> DataFrame:
    """The carried columns, n_words and the windows that may occur in the benchmark, per document.

    Winnowed fingerprints that the map holds are extended to every window around them; short
    item lengths are looked up at every word. Maps only drop sure misses."""
    maps = docs.sparkSession.sparkContext.broadcast((fp_map, win_map))
    picked = docs.select(*carried) if text_col in carried else docs.select(*carried, text_col)
    text_at = picked.columns.index(text_col)

    def run(batches):
        fps, wins = maps.value
        for b in batches:
            raw = raw_texts(b.column(text_at))
            n_words, found = [], []
            for i, j in chunks(raw):
                t = Words(raw[i:j])
                n_words.extend(np.diff(t.first).tolist())
                spans = []
                at, h = t.minima(window, k)
                at = at[_held(fps, h)]
                if len(at):
                    s = np.unique((at[:, None] - np.arange(window - k + 1)).ravel())
                    s = s[s >= 0]
                    g = t.grams(window)[s]
                    spans.extend((int(x), window) for x in s[(g != NONE) & _held(wins, g)])
                for n in short:
                    g = t.grams(n)
                    spans.extend((int(x), n) for x in np.flatnonzero((g != NONE) & _held(wins, g)))
                per = [[] for _ in range(j - i)]
                for s, n in spans:
                    r = int(np.searchsorted(t.first, s, side="right")) - 1
                    per[r].append({"s": s - int(t.first[r]), "n": n, "w": t.text(s, n)})
                found.extend(per)
            kind = pa.list_(pa.struct([("s", pa.int32()), ("n", pa.int32()), ("w", pa.string())]))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(carried)], pa.array(n_words, pa.int64()), pa.array(found, kind)],
                                             [*carried, "_n_words", "_found"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carried)
    return map_arrow(picked, run, kinds + "_n_words bigint, _found array<struct<s:int,n:int,w:string>>")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = GRAM,
                  carried: tuple[str, ...] = (), map_bits: int = MAP_BITS) -> DataFrame:
    """One row per document: ``(<id>, carried, n_words, n_hit, items array<string>, windows)``.

    Both sides keep the smallest k-gram hash of every ``window``-word window, so any shared span of
    that length shares a fingerprint; hits are extended to whole windows, which are joined on
    their words (exact); ``windows`` holds the occurrences (first word, words), n_hit their union.
    Items of fewer words are looked up whole. Null texts have no words; an empty document or
    benchmark table gives no rows or no hits; repeated ids and null ids are kept as separate
    rows (rows are tracked by a staged row number); an item with a null id hits words but is not
    listed in ``items``; only the named columns are read.

    At scale: the prefilter is a bitmap of fixed size, the join is on window text (documents side
    may be skewed: adaptive skew join), and what is gathered per document is bounded by its own
    words and the items it contains."""
    if not 1 <= k <= window:
        raise ValueError("k must be between 1 and the window")
    bench = benchmark_windows(items, item_id, item_text, window, k, map_bits)
    short = sorted(r.n for r in bench.where(F.col("n") < window).select("n").distinct().collect())  # fewer than `window` values
    fp_map = _bitmap(bench.where("mark is not null").select(F.col("mark").alias("b")), map_bits)
    win_map = _bitmap(bench.where("bit is not null").select(F.col("bit").alias("b")), map_bits)
    carried = tuple(c for c in carried if c != id_col)
    found = stage(candidates(docs, text_col, [id_col, *carried], fp_map, win_map, short, window, k)
                  .withColumn("_row", F.monotonically_increasing_id()), "contamination")
    owners = stage(bench.where("w is not null").groupBy("w").agg(F.collect_set(F.col("item").cast("string")).alias("items")),
                   "bench_owners")
    hits = (found.where(F.size("_found") > 0).select("_row", F.explode("_found").alias("f"))
            .select("_row", "f.s", "f.n", "f.w").join(owners, "w"))
    hits = (hits.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("s", "n"))).alias("at"),
                                     F.flatten(F.collect_set("items")).alias("items"))
            .select("_row", "at", F.array_sort(F.array_distinct("items")).alias("items")))
    start = F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).alias("end"))
    union = F.aggregate("at", start, lambda acc, x: F.struct(  # length of the union; windows come by start
        (acc.hit + F.greatest(F.lit(0), x.s + x.n - F.greatest(acc.end, x.s))).alias("hit"),
        F.greatest(acc.end, x.s + x.n).alias("end")), lambda acc: acc.hit)
    hits = stage(hits.select("_row", union.alias("n_hit"), "items", F.col("at").alias("windows")), "hits")  # read by column
    out = found.select("_row", id_col, *carried, F.col("_n_words").alias("n_words")).join(hits, "_row", "left")
    return out.select(id_col, *carried, "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.coalesce("windows", F.array().cast("array<struct<s:int,n:int>>")).alias("windows"))
