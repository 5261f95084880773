"""Language-model scoring by context-tree weighting over bytes, and a unigram baseline."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, map_arrow, raw_texts, stage

DEPTH = 6            # bytes of context (a code of 7 bytes)
MAX_NODES = 4096     # contexts per depth of the small tree in memory (fit)
CROWN = 2            # depth of the tree's top on the driver: at most 65,536 contexts
TOP = 3 << 20        # grams that are broadcast with their logs; all others are joined
HELD_GRAMS = 1 << 22  # distinct grams held by a counting task before it hands them on, and bytes sorted together
SPREAD = 0x9E3779B97F4A7C15  # odd: an id times it, modulo 2**64, is a key that begins with the id's bucket
GATHER = pow(SPREAD, -1, 1 << 64)  # leads from the key back to the id
BUCKET_BITS = 12     # grams and rows are shuffled in blocks, 2**BUCKET_BITS from a task, not one by one
SLOTS = 256          # texts whose grams are sorted together: what a byte tells apart
SUBTREES = 1 << 16   # grams weighted at once (a larger subtree stands alone)
FREQUENT = 1 << 17   # tokens with at least 1/FREQUENT of all training tokens are broadcast
FLUSH = 1 << 18      # distinct tokens held by a counting task before it hands them on
END = b"\n"          # the end of a text; no token can hold it


def tokens(raw: bytes) -> list[bytes]:
    """Lower-case A-Z, split at x20 and x09-x0D (what ``bytes`` methods do), then one end."""
    return [*raw.lower().split(), END]


def _pieces(raw: list[bytes], depth: int, limit: int = CHUNK_BYTES, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, code) of every byte, about ``limit`` bytes (and ``most`` parts of texts) at a time: the code
    packs the ``depth`` bytes before it (line feeds before the text) and the byte. Long texts come in parts."""
    parts, held = [], 0
    for r, x in enumerate(raw):
        for i in range(0, len(x), limit):
            before = x[max(0, i - depth):i]
            parts.append((r, b"\n" * (depth - len(before)) + before + x[i:i + limit]))
            held += min(limit, len(x) - i)
            if held >= limit or len(parts) == most:
                yield _codes(parts, depth)
                parts, held = [], 0
    if parts:
        yield _codes(parts, depth)


def _codes(parts: list[tuple[int, bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for _, x in parts])
    raw = b"".join(x for _, x in parts) + bytes(7 - depth)  # the last code is read as eight bytes, too
    code = np.ndarray(int(sizes.sum()) - depth, ">u8", raw, strides=(1,)).astype(np.uint64) >> np.uint64(8 * (7 - depth))
    own = np.ones(len(code) + depth, bool)  # the bytes that are not context
    for j in range(depth):
        own[np.cumsum(sizes) - sizes + j] = False
    return np.repeat([r for r, _ in parts], sizes - depth), code[own[depth:]]


def count_grams(docs: DataFrame, text_col: str, depth: int) -> DataFrame:
    """(code bigint, n bigint): how often each byte follows each context, over whole texts; staged."""
    def run(batches):
        for b in batches:
            raw = raw_texts(b.column(0))
            for _, codes in _pieces(raw, depth, 4 * CHUNK_BYTES):
                code, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], ["code", "n"])

    part = map_arrow(docs.select(F.col(text_col)), run, "code bigint, n bigint")
    return stage(part.groupBy("code").agg(F.sum("n").alias("n")), "grams")


def count_tokens(docs: DataFrame, text_col: str) -> DataFrame:
    """(token binary, c bigint) of all training tokens; tasks count before the shuffle; staged."""
    def run(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                              ["token", "c"])

        for b in batches:
            for x in raw_texts(b.column(0)):
                held.update(tokens(x))
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        if held:
            yield out()

    part = map_arrow(docs.select(F.col(text_col)), run, "token binary, c bigint")
    return stage(part.groupBy("token").agg(F.sum("c").alias("c")), "tokens")


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Γ by Stirling's series after shifting the argument by 8."""
    low = np.zeros_like(x)
    for i in range(8):
        low += np.log(x + i)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - low


def _kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability of n0 zeros and n1 ones."""
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1.0) - np.log(np.pi)


def _bits(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte counts (nodes, 256) → zeros and ones at the 255 decisions of the binary tree over bytes
    (decision 1 is the top bit; decision j leads to 2j and 2j + 1)."""
    full = np.zeros((len(counts), 512))
    full[:, 256:] = counts
    for level in range(7, -1, -1):
        lo, hi = 1 << level, 1 << (level + 1)
        full[:, lo:hi] = full[:, 2 * lo:2 * hi:2] + full[:, 2 * lo + 1:2 * hi:2]
    j = np.arange(1, 256)
    return full[:, 2 * j], full[:, 2 * j + 1]


def _byte_logs(ones: np.ndarray) -> np.ndarray:
    """P(1) at the 255 decisions → log10 of the probability of each byte, (nodes, 256)."""
    log1, log0 = np.log10(ones), np.log10(1 - ones)
    out = np.zeros((len(ones), 256))
    byte = np.arange(256)
    for level in range(8):
        at = (1 << level) + (byte >> (8 - level)) - 1
        out += np.where((byte >> (7 - level)) & 1, log1[:, at], log0[:, at])
    return out


class ContextTree:
    """A weighted context tree: ``child[node, byte]`` (−1: none) and ``logp[node, byte]``."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        """levels[d]: the contexts kept at depth d (d bytes, packed, ascending) and their byte counts."""
        depth, kt, weight, ones, rest = len(levels) - 1, [], [None] * len(levels), [], []
        parent = [None] + [np.searchsorted(levels[d - 1][0], levels[d][0] & ((1 << 8 * (d - 1)) - 1)) for d in range(1, depth + 1)]
        for d, (_, counts) in enumerate(levels):
            n0, n1 = _bits(counts)
            kt.append(_kt(n0, n1))
            ones.append((n1 + 0.5) / (n0 + n1 + 1))
            left = counts.astype(float)
            if d < depth:
                np.subtract.at(left, parent[d + 1], levels[d + 1][1])
            r0, r1 = _bits(np.maximum(left, 0))  # contexts that were not kept share one leaf
            rest.append(((r1 + 0.5) / (r0 + r1 + 1), _kt(r0, r1)))
        below = [None] * (depth + 1)
        for d in range(depth, -1, -1):  # log P_w = log(½ P_e + ½ Π children)
            if d == depth:
                weight[d] = kt[d]
            else:
                below[d] = rest[d][1].copy()
                np.add.at(below[d], parent[d + 1], weight[d + 1])
                weight[d] = np.logaddexp(kt[d], below[d]) - np.log(2)
        tables, mixed, remain = [], None, None
        for d in range(depth + 1):  # the predictive mixture along the path from the root
            stop = np.exp(np.minimum(kt[d] - np.log(2) - weight[d], 0)) if d < depth else np.ones_like(kt[d])
            held = np.ones_like(stop) if d == 0 else remain[parent[d]]
            so_far = (0 if d == 0 else mixed[parent[d]]) + held * stop * ones[d]
            mixed, remain = so_far, held * (1 - stop)
            tables.append(_byte_logs(so_far + (remain * rest[d][0] if d < depth else 0)).astype(np.float32))
        self.logp = np.concatenate(tables)
        starts = np.cumsum([0] + [len(x) for x, _ in levels])
        self.child = np.full((starts[-1], 256), -1, np.int32)
        for d in range(1, depth + 1):
            first = (levels[d][0] >> (8 * (d - 1))).astype(np.int64)
            self.child[starts[d - 1] + parent[d], first] = starts[d] + np.arange(len(first))
        self.depth = depth

    def score(self, raw: list[bytes]) -> np.ndarray:
        """log10 probability of each text."""
        out = np.zeros(len(raw))
        for who, code in _pieces(raw, self.depth):
            node = np.zeros(len(code), np.int32)
            on = np.ones(len(code), bool)  # still on a kept path
            for d in range(1, self.depth + 1):
                nxt = self.child[node, (code >> np.uint64(8 * d)).astype(np.uint8)]
                on &= nxt >= 0
                node = np.where(on, nxt, node)
            out += np.bincount(who, self.logp[node, code.astype(np.uint8)], len(raw))
        return out


def fit(docs: DataFrame, text_col: str = "text", depth: int = DEPTH, max_nodes: int = MAX_NODES) -> ContextTree:
    """A small tree in memory: the contexts with at least 1/max_nodes of the positions. ``score``
    does not use it (it keeps every context); with all contexts kept both give the same logs.

    The driver receives at most ``max_nodes`` contexts per depth with their byte counts, however
    large the corpus; the counts cover every byte of every text. A context that is not kept
    shares a leaf with its unkept siblings, so the tree stays a proper weighting."""
    grams = count_grams(docs, text_col, depth)
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    levels = [(np.zeros(1, np.int64), np.zeros((1, 256)))]
    kept = None
    for d in range(depth + 1):
        ctx = F.shiftrightunsigned("code", 8).bitwiseAND(F.lit((1 << 8 * d) - 1))
        at = grams.select(ctx.alias("ctx"), F.col("code").bitwiseAND(F.lit(255)).alias("byte"), "n")
        if d:
            if not len(kept):
                break
            often = at.groupBy("ctx").agg(F.sum("n").alias("m")).where(F.col("m") * max_nodes >= total).select("ctx")
            at = at.join(F.broadcast(often), "ctx")  # at most max_nodes rows
        rows = at.groupBy("ctx", "byte").agg(F.sum("n").alias("n")).toPandas()
        kept, inv = np.unique(rows["ctx"].to_numpy(np.int64), return_inverse=True)
        counts = np.zeros((len(kept), 256))
        counts[inv, rows["byte"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
        if d == 0:
            levels = [(kept, counts)] if len(kept) else levels
        elif len(kept):
            levels.append((kept, counts))
    return ContextTree(levels)


def _spread(ids: np.ndarray) -> np.ndarray:
    return ids.astype(np.uint64, copy=False) * np.uint64(SPREAD)


def _gather(keys: np.ndarray) -> np.ndarray:
    return keys * np.uint64(GATHER)


def _bucket(keys):
    return keys >> np.uint64(64 - BUCKET_BITS)


def _sum(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each of some ascending keys once, with the sums of its values."""
    if not len(key):
        return key, *values
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], *(np.add.reduceat(v, first) for v in values)


def _sorted(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One ascending list of keys with their values, of several, which are let go."""
    key, *values = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    order = np.argsort(key)
    return key[order], *(v[order] for v in values)


def _merge(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return _sum(*_sorted(parts))


def _blocks(key: np.ndarray, **values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(bucket int, key array, values arrays) of ascending keys: a row for each bucket that has any."""
    values = {"key": key.view(np.int64), **values}
    starts = np.searchsorted(_bucket(key), np.arange((1 << BUCKET_BITS) + 1, dtype=np.uint64))
    for i in range(0, 1 << BUCKET_BITS, 256):  # so many buckets a batch
        at = starts[i:i + 257]
        here = np.flatnonzero(at[1:] > at[:-1])
        if len(here):
            offsets = pa.array(np.append(at[here], at[-1]) - at[0], pa.int32())
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(x[at[0]:at[-1]])) for x in values.values()]
            yield pa.RecordBatch.from_arrays([pa.array(here + i, pa.int32()), *arrays], ["bucket", *values])


def _flat(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _sums(batches, value: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys ascending, sums of ``value``) of whole buckets, some at a time; blocks come sorted by bucket."""
    held, size, limit = [], 0, HELD_GRAMS
    for b in batches:
        held.append((_flat(b.column("key")).view(np.uint64), _flat(b.column(value))))
        size += len(held[-1][0])
        if size > limit:
            key, v = _merge(held)
            cut = int(np.searchsorted(_bucket(key), np.uint64(b.column("bucket")[-1].as_py())))  # the last bucket may go on
            yield key[:cut], v[:cut]
            held, size = [(key[cut:], v[cut:])], len(key) - cut
            limit = max(HELD_GRAMS, 2 * size)
    if size:
        yield _merge(held)


def _rows(**columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(next(iter(columns.values()))), FLUSH):
        yield pa.RecordBatch.from_arrays([pa.array(x[i:i + FLUSH]) for x in columns.values()], [*columns])


def gram_table(docs: DataFrame, train: Column, text_col: str, depth: int) -> DataFrame:
    """(code bigint, n bigint, m bigint): every gram of any text, how often training texts hold it
    (0: never) and all texts; staged.

    Tasks count before the shuffle and hand on their grams in blocks, so a shuffled row is an array of
    grams; the key's last byte is 1 for counts of training texts. A bucket's blocks meet in one task."""
    def run(batches):
        fresh, parts = [], []

        def count():
            parts.append(np.unique(np.concatenate(fresh), return_counts=True))
            fresh.clear()

        for b in batches:
            raw, flags = raw_texts(b.column(0)), b.column(1).to_pylist()
            for own in (True, False):
                for _, codes in _pieces([x for x, f in zip(raw, flags) if f == own], depth):
                    fresh.append(_spread(codes << np.uint64(8)) | np.uint64(own))
                    if sum(map(len, fresh)) <= HELD_GRAMS:
                        continue
                    count()
                    if sum(len(k) for k, _ in parts) > HELD_GRAMS:
                        parts[:] = [_merge(parts)]
                        if len(parts[0][0]) > HELD_GRAMS * 3 // 4:
                            yield from _blocks(parts[0][0], m=parts[0][1])
                            parts.clear()
        if fresh:
            count()
        if parts:
            key, m = _merge(parts)
            yield from _blocks(key, m=m)

    def add(batches):
        for key, m in _sums(batches, "m"):
            gram, n, m = _sum(key >> np.uint64(8), m * (key & np.uint64(1)).astype(np.int64), m)
            code = (_gather(gram << np.uint64(8)) >> np.uint64(8)).astype(np.int64)
            yield from _rows(code=code, n=n, m=m)

    part = map_arrow(docs.select(F.col(text_col).alias("_t"), train.alias("_own")), run,
                     "bucket int, key array<bigint>, m array<bigint>")
    return stage(map_arrow(_by_bucket(part), add, "code bigint, n bigint, m bigint"), "grams")


def _by_bucket(blocks: DataFrame, *then: Column) -> DataFrame:
    return blocks.repartition("bucket").sortWithinPartitions("bucket", *then)


def _decisions(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8, grams): the context and decision (context << 8 | decision) and the bit taken there."""
    level, byte = np.arange(8, dtype=np.uint64)[:, None], code & np.uint64(255)
    at = (np.uint64(1) << level) | (byte >> (np.uint64(8) - level))
    return (code >> np.uint64(8) << np.uint64(8)) | at, (byte >> (np.uint64(7) - level)) & np.uint64(1)


class _Climb:
    """The nodes (context, decision) above some counted ones from depth ``low`` up to ``high``, by depth:
    ``keys``, zeros ``n0``, ones ``n1``, ``up`` (place of the node one byte shorter) and, once weighted,
    ``kt``, ``below`` (log of the children's product) and ``weight``."""

    def __init__(self, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, low: int, high: int):
        self.low, self.high, self.keys, self.n0, self.n1, self.up = low, high, {low: keys}, {low: n0}, {low: n1}, {}
        self.kt, self.below, self.weight = {}, {}, {}
        for d in range(low - 1, high - 1, -1):
            short = self.keys[d + 1] & np.uint64((1 << (8 * d + 8)) - 1)
            self.keys[d], self.up[d + 1] = np.unique(short, return_inverse=True)
            size = len(self.keys[d])
            self.n0[d], self.n1[d] = (np.bincount(self.up[d + 1], n[d + 1], size) for n in (self.n0, self.n1))

    def weigh(self, depth: int, below: np.ndarray | None = None) -> None:
        """Bottom-up: log P_w = log(½ P_e + ½ Π children), at ``depth`` P_e alone; ``below`` is for the lowest nodes."""
        for d in range(self.low, self.high - 1, -1):
            self.kt[d] = _kt(self.n0[d], self.n1[d])
            self.below[d] = below if d == self.low else np.bincount(self.up[d + 1], self.weight[d + 1], len(self.keys[d]))
            self.weight[d] = self.kt[d] if d == depth else np.logaddexp(self.kt[d], self.below[d]) - np.log(2)

    def descend(self, depth: int, first: int, mixed: np.ndarray, remain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Top-down from the mixture so far and the share that remains above depth ``first``, both given at its nodes."""
        for d in range(first, self.low + 1):
            if d > first:
                mixed, remain = mixed[self.up[d]], remain[self.up[d]]
            stop = np.exp(np.minimum(self.kt[d] - np.log(2) - self.weight[d], 0)) if d < depth else np.ones(len(self.keys[d]))
            mixed = mixed + remain * stop * (self.n1[d] + 0.5) / (self.n0[d] + self.n1[d] + 1)
            remain = remain * (1 - stop)
        return mixed, remain


def _subtree_sets(batches, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code, n, m) of whole subtrees, as many as hold about SUBTREES grams together; rows come sorted by subtree."""
    held, size, limit = [], 0, SUBTREES
    for b in batches:
        held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        size += b.num_rows
        if size > limit:
            whole = [np.concatenate(x) for x in zip(*held)]
            tree = _context(whole[0], min(CROWN + 1, depth))
            cut = int(np.searchsorted(tree, tree[-1]))
            if cut:
                yield whole[0][:cut].astype(np.uint64), whole[1][:cut], whole[2][:cut]
            held, size = [[x[cut:] for x in whole]], size - cut
            limit = max(SUBTREES, 2 * size)
    if size:
        whole = [np.concatenate(x) for x in zip(*held)]
        yield whole[0].astype(np.uint64), whole[1], whole[2]


def _context(code, d: int):
    return (code >> 8) & ((1 << 8 * d) - 1)


def _rise(code: np.ndarray, n: np.ndarray, depth: int, high: int) -> tuple[_Climb, np.ndarray, np.ndarray]:
    node, bit = _decisions(code)
    keys, at = np.unique(node.ravel(), return_inverse=True)
    one = np.bincount(at, (bit * n.astype(np.uint64)).ravel(), len(keys))
    every = np.bincount(at, np.broadcast_to(n, node.shape).ravel(), len(keys))
    climb = _Climb(keys, every - one, one, depth, high)
    climb.weigh(depth, np.zeros(len(keys)))
    return climb, at.reshape(8, -1), bit


def gram_logs(docs: DataFrame, train: Column, text_col: str, depth: int) -> DataFrame:
    """(code bigint, logp float, m bigint): log10 probability of every gram of any text under the tree
    of all training contexts, and how often it occurs; staged.

    Every context of every text is a node; one that training texts lack has no counts. Subtrees
    below ``CROWN`` bytes are weighted where their grams meet (one shuffle on the context's last
    CROWN + 1 bytes, over distinct grams); their products are summed into the tree's top, which
    is weighted on the driver: at most 256**CROWN contexts of 255 decisions, whatever the input.
    The mixture then goes down the same subtrees."""
    spark, high = docs.sparkSession, min(CROWN, depth)
    grams = gram_table(docs, train, text_col, depth)
    code = F.shiftrightunsigned("code", 8).bitwiseAND(F.lit((1 << 8 * min(CROWN + 1, depth)) - 1))
    dealt = grams.select("code", "n", "m", code.alias("tree")).repartition("tree").sortWithinPartitions("tree")

    def rise(batches):
        for code, n, _ in _subtree_sets(batches, depth):
            climb, _, _ = _rise(code, n, depth, high)
            yield pa.RecordBatch.from_arrays([pa.array(climb.keys[high].astype(np.int64)),
                                              *(pa.array(x[high].astype(np.float64)) for x in (climb.n0, climb.n1, climb.below))],
                                             ["node", "n0", "n1", "below"])

    top = (map_arrow(dealt, rise, "node bigint, n0 double, n1 double, below double").groupBy("node")
           .agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "below")]).toPandas().sort_values("node"))
    crown = _Climb(top["node"].to_numpy(np.uint64), *(top[c].to_numpy(np.float64) for c in ("n0", "n1")), high, 0)
    crown.weigh(depth, top["below"].to_numpy(np.float64))
    roots = len(crown.keys[0])
    begin = (np.zeros(roots), np.ones(roots))
    sent = spark.sparkContext.broadcast((crown.keys[high], *crown.descend(depth, 0, *begin)))

    def fall(batches):
        keys, mixed, remain = sent.value
        for code, n, m in _subtree_sets(batches, depth):
            climb, at, bit = _rise(code, n, depth, high)
            here = np.searchsorted(keys, climb.keys[high])
            p = mixed[here]
            if depth > high:
                p, _ = climb.descend(depth, high + 1, p[climb.up[high + 1]], remain[here][climb.up[high + 1]])
            logs = np.where(bit == 1, np.log10(p)[at], np.log10(1 - p)[at]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(logs.astype(np.float32)), pa.array(m)],
                                             ["code", "logp", "m"])

    return stage(map_arrow(dealt, fall, "code bigint, logp float, m bigint"), "gram_logs")


def _lookup(raw: list[bytes], depth: int, codes: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """log10 probability of each text's grams among ``codes`` (ascending), and the counts of its others.

    Grams of at most SLOTS texts are sorted at once with the text in their free low byte, so equal grams of a
    text meet, and each distinct gram is looked up once, in ascending order."""
    out, far = np.zeros(len(raw)), []
    for who, code in _pieces(raw, depth, CHUNK_BYTES, SLOTS):
        begin = np.append(True, who[1:] != who[:-1])
        texts = who[begin]
        key = np.sort(code << np.uint64(8) | (np.cumsum(begin) - 1).astype(np.uint64))
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n, key = np.diff(np.append(first, len(key))), key[first]
        slot, gram = (key & np.uint64(255)).astype(np.int64), key >> np.uint64(8)
        new = np.append(True, gram[1:] != gram[:-1])
        known = gram[new]
        place = np.minimum(np.searchsorted(codes, known), max(0, len(codes) - 1))
        found = codes[place] == known if len(codes) else np.zeros(len(known), bool)
        at = np.cumsum(new) - 1
        value = np.where(found, logs[place] if len(codes) else 0.0, 0.0)[at]
        np.add.at(out, texts, np.bincount(slot, value * n, len(texts)))
        if not found.all():
            miss = ~found[at]
            order = np.argsort(slot[miss], kind="stable")
            far.append((texts[slot[miss][order]], gram[miss][order].astype(np.int64), n[miss][order]))
    who, code, n = (np.concatenate([x[i] for x in far]) if far else np.zeros(0, np.int64) for i in range(3))
    ends = np.searchsorted(who, np.arange(len(raw) + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])
    return out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


def _far_scores(scored: DataFrame, logs: DataFrame) -> DataFrame:
    """(_row bigint, l double): log10 probability of the grams in each row's ``far``, by ``logs`` (code, logp).

    Both sides are dealt out by gram in blocks, the logs of a bucket before the rows that look there;
    the sums of a task's rows are dealt out by row, in blocks again."""
    def ask(batches):
        for b in batches:
            far, row = b.column(1), b.column(0).to_numpy()
            pairs = far.flatten()
            key = _spread(pairs.field("code").to_numpy().astype(np.uint64) << np.uint64(8))
            key, row, n = _sorted([(key, np.repeat(row, far.value_lengths().to_numpy()), pairs.field("n").to_numpy())])
            for x in _blocks(key, row=row, n=n):
                yield x.append_column("logp", pa.nulls(x.num_rows, pa.list_(pa.float32())))

    def tell(batches):
        for b in batches:
            key, logp = _sorted([(_spread(b.column(0).to_numpy().astype(np.uint64) << np.uint64(8)), b.column(1).to_numpy())])
            for x in _blocks(key, logp=logp):
                none = pa.nulls(x.num_rows, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*x.columns[:2], none, none, x.column(2)], ["bucket", "key", "row", "n", "logp"])

    def meet(batches):
        known, values = np.zeros(0, np.uint64), np.zeros(0, np.float32)
        held, size = [], 0
        for b in batches:
            told = b.column("logp").is_valid()
            new, asked = b.filter(told), b.filter(pc.invert(told))
            on = np.searchsorted(_bucket(known), np.uint64(b.column("bucket")[0].as_py()))  # buckets before it are over
            known, values = _sorted([(known[on:], values[on:]), (_flat(new.column("key")).view(np.uint64), _flat(new.column("logp")))])
            key = _flat(asked.column("key")).view(np.uint64)
            at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
            hit = known[at] == key if len(known) else np.zeros(len(key), bool)
            held.append((_spread(_flat(asked.column("row"))[hit]), _flat(asked.column("n"))[hit] * values[at[hit]].astype(np.float64)))
            size += len(held[-1][0])
            if size > HELD_GRAMS:
                key, l = _merge(held)
                yield from _blocks(key, l=l)
                held, size = [], 0
        if size:
            key, l = _merge(held)
            yield from _blocks(key, l=l)

    def add(batches):
        for key, l in _sums(batches, "l"):
            yield from _rows(_row=_gather(key).astype(np.int64), l=l)

    kind = "bucket int, key array<bigint>, row array<bigint>, n array<bigint>, logp array<float>"
    asked = map_arrow(scored.where(F.size("far") > 0).select("_row", "far"), ask, kind)
    told = map_arrow(logs.select("code", "logp"), tell, kind)
    met = map_arrow(_by_bucket(asked.union(told), F.col("logp").isNull()), meet, "bucket int, key array<bigint>, l array<double>")
    return map_arrow(_by_bucket(met), add, "_row bigint, l double")


def _often(logs: DataFrame, top: int) -> Column:
    """The most frequent grams, at most ``top`` of them: those from some eighth of a power of two on."""
    eighth = F.floor(F.log2("m") * 8)
    least, held = None, 0
    for r in sorted(logs.groupBy(eighth.alias("b")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
        held += r.k
        if held > top:
            break
        least = r.b
    return F.lit(False) if least is None else eighth >= least


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
          top: int = TOP) -> DataFrame:
    """One row per document: ``(<id>, n_bytes, score, bits_per_byte, n_tokens, n_known, train_tokens, base_score)``.

    ``train`` marks the rows to learn from (null: no). score is the context tree's log10
    probability of the whole text and bits_per_byte its code length per byte (null for an empty
    text); base_score is the add-one unigram model over words and text ends. Null text is
    empty: score 0, one token (its end). Without training rows every bit has probability ½ and
    no token is known. Repeated rows and null ids are scored as they come; an empty table gives
    no rows.

    The tree holds every context of ``depth`` bytes (six at most) of every training text. The ``top``
    most frequent grams are broadcast with their logs and summed where the text is; the others,
    counted per text, meet their logs in blocks dealt out by gram (any of them is rarer than those
    broadcast, so none is hot).

    Tokens with at least 1/FREQUENT of all training tokens (at most FREQUENT of them) are
    broadcast and summed where the text is; the rest, counted per text, go through one join on
    the token, so no vocabulary is held whole anywhere: a task of the join has its partition's tokens."""
    if not 1 <= depth <= 6:
        raise ValueError("depth must be 1 to 6: a gram is packed into a bigint")
    spark = docs.sparkSession
    own = F.coalesce(train, F.lit(False))
    training = docs.where(own)
    logs = gram_logs(docs, own, text_col, depth)
    near = _often(logs, top)
    held = logs.where(near).select("code", "logp").toArrow().sort_by("code")
    codes, log_values = held["code"].to_numpy().astype(np.uint64), held["logp"].to_numpy()
    vocab = count_tokens(training, text_col)
    n_train, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    often = {bytes(r.token): r.c for r in vocab.where(F.col("c") * FREQUENT >= n_train).collect()}
    denominator = float(n_train + v + 1)
    model = spark.sparkContext.broadcast((codes, log_values, often))

    def run(batches):
        codes, log_values, often = model.value
        log_p = {t: float(np.log10((c + 1) / denominator)) for t, c in often.items()}
        unseen = -float(np.log10(denominator))
        for b in batches:
            raw = raw_texts(b.column(0))
            scores, far = _lookup(raw, depth, codes, log_values)
            n_tokens, known, base, rare, times, ends = [], [], [], [], [], [0]
            for x in raw:
                words = tokens(x)
                got = [*filter(None, map(log_p.get, words))]  # every log is below 0
                rest = Counter(w for w in words if w not in log_p) if len(got) < len(words) else {}
                n_tokens.append(len(words))
                known.append(len(got))
                base.append(float(sum(got)) + unseen * (len(words) - len(got)))
                rare.extend(rest)
                times.extend(rest.values())
                ends.append(len(rare))
            rest = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int64())], ["token", "n"])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([len(x) for x in raw], pa.int64()), pa.array(scores, pa.float64()),
                 pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest), far],
                [*b.schema.names[1:], "n_bytes", "score", "n_tokens", "known", "base", "rare", "far"])

    picked = docs.select(F.col(text_col).alias("_t"), F.col(id_col).alias("_id"))
    kind = picked.schema["_id"].dataType.simpleString()
    scored = stage(map_arrow(picked, run, f"_id {kind}, n_bytes bigint, score double, n_tokens bigint, known bigint, "
                                          "base double, rare array<struct<token:binary,n:bigint>>, "
                                          "far array<struct<code:bigint,n:bigint>>")
                   .withColumn("_row", F.monotonically_increasing_id()), "scored")
    rest = scored.where(F.size("rare") > 0).select("_row", F.explode("rare").alias("r")).select("_row", "r.token", "r.n")
    gain = vocab.where(F.col("c") * FREQUENT < n_train).select("token", F.log10(F.col("c") + 1).alias("g"))  # on top of an unseen token
    rest = (rest.join(gain.hint("shuffle_hash"), "token").groupBy("_row")  # the texts' tokens, many more, need no sort
            .agg(F.sum("n").alias("k"), F.sum(F.col("n") * F.col("g")).alias("s")))
    far = _far_scores(scored, logs.where(~near))
    total = scored.drop("rare", "far").join(far, "_row", "left").withColumn("score", F.col("score") + F.coalesce("l", F.lit(0.0)))
    return total.join(rest, "_row", "left").select(
        F.col("_id").alias(id_col), "n_bytes", "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") / F.lit(float(np.log10(2.0))) / F.col("n_bytes")).alias("bits_per_byte"),
        "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(int(n_train)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("s", F.lit(0.0))).alias("base_score"))
