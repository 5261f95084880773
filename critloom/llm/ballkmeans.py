"""Vector codes by ball k-means on the parts of integer vectors.

Every vector is cut into parts; each part position has its own codebook. After the first, exhaustive
assignment an entry with the parts assigned to it is a ball: its radius says which other entries can take
a part away (its neighbours), a part in the stable core around its entry stays without any comparison,
and the annular ring that a part lies in limits the neighbours it is compared with. All distances are
squared integers, so every assignment is exact."""

from __future__ import annotations

import hashlib
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stage
from .lattice import lattice, unpack

PARTS = 16
ENTRIES = 64
ROUNDS = 2
CELLS = 1 << 18          # distances held at once
LABELS_SENT = 100_000    # totals of labels that are broadcast; more are joined by their label
SMALL = 1 << 27          # entries below this have squared distances that 64 bits hold (up to 128 dimensions)

Codebook = list[list[list[int]]]  # part, entry, position


def bounds(dim: int, parts: int) -> list[int]:
    """First positions of the parts, and the end; parts are equal if ``dim`` is a multiple of ``parts``."""
    return [p * dim // parts for p in range(parts + 1)]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries."""
    return ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


class Balls:
    """The entries of one part position, with what the balls around them say.

    ``radii[i]`` bounds the squared distances of the parts assigned to entry i from it (null: unknown)."""

    def __init__(self, entries: np.ndarray, radii: list[int | None] | None):
        self.entries, self.radii = entries, radii
        apart = distances(entries, entries)
        self.near, self.rings = [], []
        for i in range(len(entries)):
            radius = None if radii is None else radii[i]
            others = [j for j in range(len(entries)) if j != i and (radius is None or apart[i, j] <= 4 * radius)]
            others.sort(key=lambda j: (apart[i, j], j))
            self.near.append(np.array(others, np.int64))
            self.rings.append(apart[i, others])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, the lowest of equals, and its squared distance: all are compared."""
        codes, best = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
        rows = max(1, CELLS // (len(self.entries) * max(1, x.shape[1])))
        for i in range(0, len(x), rows):
            d = distances(x[i:i + rows], self.entries)
            codes[i:i + rows] = d.argmin(axis=1)
            best[i:i + rows] = d[np.arange(len(d)), codes[i:i + rows]]
        return codes, best

    def move(self, x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """As ``nearest``, from the entries that the rows are assigned to; also the number of comparisons.

        An entry j can be as near as entry i, at distance d, only if i and j are at most 2d apart."""
        own = x - self.entries[codes]
        best, new, compared = (own * own).sum(axis=1), codes.copy(), 0
        order = np.argsort(codes, kind="stable")
        edges = np.searchsorted(codes[order], np.arange(len(self.entries) + 1))
        for i in range(len(self.entries)):
            ball = order[edges[i]:edges[i + 1]]
            if not len(ball) or not len(self.near[i]):
                continue
            within = np.searchsorted(self.rings[i], 4 * best[ball], side="right")  # 0: in the stable core
            ring = np.frexp(within.astype(float))[1]  # rings 1, 2-3, 4-7, … neighbours deep
            for k in np.unique(ring[within > 0]).tolist():
                rows = ball[(ring == k) & (within > 0)]
                near = self.near[i][:int(within[ring == k].max())]
                compared += len(rows) * len(near)
                step = max(1, CELLS // (len(near) * max(1, x.shape[1])))
                for at in (rows[a:a + step] for a in range(0, len(rows), step)):
                    d = distances(x[at], self.entries[near])
                    low = d.min(axis=1)
                    first = np.where(d == low[:, None], near, len(self.entries)).min(axis=1)
                    moved = (low < best[at]) | ((low == best[at]) & (first < i))
                    new[at[moved]] = first[moved]
                    best[at[moved]] = low[moved]
        return new, best, compared


def assign(rows: DataFrame, dim: int, wide: bool, books: Codebook, radii: list[list[int | None]] | None, first: bool) -> DataFrame:
    """``rows`` with ``codes`` (a byte a part) and ``error``, the sum of the squared distances (null if no
    long holds it); staged."""
    cuts, kind = bounds(dim, len(books)), object if wide else np.int64
    sent = rows.sparkSession.sparkContext.broadcast((books, radii))
    keep = [c for c in rows.columns if c not in ("codes", "error")]

    def run(batches):
        books, radii = sent.value
        balls = [Balls(np.array(b, kind).reshape(len(b), cuts[p + 1] - cuts[p]), radii and radii[p]) for p, b in enumerate(books)]
        for b in batches:
            x = unpack(b.column("x"), dim).astype(kind)
            before = None if first else np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(len(x), len(books))
            codes, error = np.zeros((len(x), len(books)), np.uint8), np.zeros(len(x), kind)
            for p, ball in enumerate(balls):
                part = x[:, cuts[p]:cuts[p + 1]]
                found = ball.nearest(part) if first else ball.move(part, before[:, p].astype(np.int64))[:2]
                codes[:, p] = found[0]
                error = error + found[1]
            packed = codes.tobytes()
            held = [packed[i:i + len(books)] for i in range(0, len(packed), len(books))]
            errors = [e if e < 1 << 63 else None for e in error.tolist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(held, pa.binary()), pa.array(errors, pa.int64())],
                                             [*keep, "codes", "error"])

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name in keep)
    return stage(map_arrow(rows, run, kinds + "codes binary, error bigint"), "codes")


def centre(coded: DataFrame, dim: int, wide: bool, books: Codebook) -> tuple[Codebook, list[list[int | None]]]:
    """New codebooks (the floor of the mean of each entry's parts; unused entries stay) and bounds of the
    squared radii around them: the old radius and the way that the entry moved, added up.

    Tasks add up before the shuffle, and the driver gets a row per part, entry and position."""
    cuts, kind, entries = bounds(dim, len(books)), object if wide else np.int64, len(books[0])
    sent = coded.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        width = [b - a for a, b in zip(cuts, cuts[1:])]
        old = [np.array(b, kind).reshape(entries, w) for b, w in zip(sent.value, width)]
        count = np.zeros((len(old), entries), np.int64)
        total = [np.zeros((entries, w), object) for w in width]
        far = np.zeros((len(old), entries), object)
        for b in batches:
            x = unpack(b.column("x"), dim).astype(kind)
            codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(len(x), len(old)).astype(np.int64)
            for p, book in enumerate(old):
                part, code = x[:, cuts[p]:cuts[p + 1]], codes[:, p]
                order = np.argsort(code, kind="stable")
                used, starts, n = np.unique(code[order], return_index=True, return_counts=True)
                if not len(used):
                    continue
                apart = part - book[code]
                count[p, used] += n
                if width[p]:
                    total[p][used] += np.add.reduceat(part[order], starts, axis=0).astype(object)
                    far[p, used] = np.maximum(far[p, used], np.maximum.reduceat((apart * apart).sum(axis=1)[order], starts).astype(object))
        out = [(p, e, i, int(count[p, e]), Decimal(int(total[p][e, i])), None if wide else int(far[p, e]))
               for p, w in enumerate(width) for e in range(entries) if count[p, e] for i in range(w)]
        if out:
            columns = list(zip(*out))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["p", "e", "i", "n", "total", "far"])

    parts = map_arrow(coded.select("x", "codes"), run, "p int, e int, i int, n bigint, total decimal(38,0), far bigint")
    sums = parts.groupBy("p", "e", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("far").alias("far")).collect()
    new = [[list(e) for e in b] for b in books]
    radii: list[list[int | None]] = [[0] * entries for _ in books]  # an unused entry has no part to lose
    for r in sums:
        new[r.p][r.e][r.i] = int(r.total) // r.n
        radii[r.p][r.e] = r.far
    for p, book in enumerate(books):
        for e, entry in enumerate(book):
            if radii[p][e]:
                way = sum((a - b) ** 2 for a, b in zip(entry, new[p][e]))
                radii[p][e] = (isqrt(radii[p][e]) + 1 + isqrt(way) + 1) ** 2
            elif radii[p][e] == 0 and new[p][e] != entry:
                radii[p][e] = sum((a - b) ** 2 for a, b in zip(entry, new[p][e]))
    return new, radii


def digest(books: Codebook) -> str:
    """SHA-256 of all entries' numbers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def quantise(df: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", carried: tuple[str, ...] = (),
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebook]:
    """``(<id>, carried, codes binary, error bigint)`` of every kept vector, and the codebooks.

    Entries c become floor(256 * c). A part position's codebook starts as that part of the vectors with the
    ``entries`` smallest ids (ties: by their bytes; null ids last; repeated ids count as often as they
    occur; with fewer vectors it has fewer entries). Each round assigns all parts to their nearest entries
    (ties: the lower) and moves the entries to the floor of their parts' mean. ``codes`` has a byte a part;
    ``error`` is null if no long holds it. Dropped are vectors that are null, hold an entry that is null, not
    finite or, scaled, beyond a long, or whose length is not that of most vectors (ties: the longer).
    Lengths that are no multiple of ``parts`` give parts that differ by one. Repeated rows are coded as they
    come; an empty table gives no rows; only the named columns are read; a carried column called codes or
    error is refused (ValueError)."""
    if clash := {"codes", "error"} & {id_col, *carried}:
        raise ValueError(f"columns cannot be carried: {sorted(clash)}")
    rows, dim, bound = lattice(df, vec_col, (id_col, *carried))
    wide, cuts = bound >= SMALL or dim > 128, bounds(dim, parts)
    first = rows.select("c0", "x").orderBy(F.col("c0").asc_nulls_last(), "x").limit(entries).collect()
    start = unpack(pa.array([bytes(r.x) for r in first], pa.binary()), dim).tolist()
    books: Codebook = [[v[a:b] for v in start] for a, b in zip(cuts, cuts[1:])]
    coded, radii = rows.withColumns({"codes": F.lit(b""), "error": F.lit(0)}), None
    for k in range(rounds + 1 if first else 0):
        coded = assign(coded, dim, wide, books, radii, k == 0)
        if k < rounds:
            books, radii = centre(coded, dim, wide, books)
    done = coded.drop("x").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate((id_col, *carried))],
                                  F.col("codes"), F.col("error").cast("bigint").alias("error"))
    return done, books


def label_errors(coded: DataFrame, label_col: str) -> DataFrame:
    """``coded`` with ``label_error``: the errors of all rows of its label added up, nulls together (null
    if no long holds it). A hot label is added up in every task before the shuffle."""
    total = F.try_sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    totals = stage(coded.groupBy(F.col(label_col).alias("_l")).agg(total.alias("label_error")), "label_errors")
    if totals.count() <= LABELS_SENT:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col(label_col).eqNullSafe(F.col("_l")), "left").drop("_l")
