"""Vectors of numbers as integer vectors in a compact binary form, for operators that compute exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stage

SCALE = 256
WIDTHS = (2, 4, 8)  # bytes of an entry; a vector is written in the narrowest that holds all its entries
LONG = 1 << 63


def integers(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries of all kept vectors, first entry of each, row of each) of an Arrow list column.

    An entry c becomes floor(256 * c). Dropped are null vectors and vectors that hold an entry that is
    null, not finite, or beyond a 64-bit integer once scaled."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    c = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(c * SCALE)
        good = (scaled >= -float(LONG)) & (scaled < float(LONG))  # false for NaN
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~good)])
    kept = (bad[ends] == bad[ends - sizes]) & pc.is_valid(column).to_numpy(zero_copy_only=False)
    x = scaled[np.repeat(kept, sizes)].astype(np.int64)
    rows = np.flatnonzero(kept)
    return x, np.concatenate([[0], np.cumsum(sizes[rows])]), rows


def pack(x: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], list[int], list[int]]:
    """(bytes, entries, largest magnitude) of each vector."""
    magnitude = np.where(x < 0, -(x + 1), x)  # the largest magnitude of a width is one less above zero
    sizes = np.diff(ends)
    top = np.zeros(len(sizes), np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        top[filled] = np.maximum.reduceat(magnitude, ends[:-1][filled])
    forms = [x.astype(f"<i{w}").tobytes() for w in WIDTHS]
    which = np.searchsorted([(1 << 15) - 1, (1 << 31) - 1], top)
    out = [forms[k][i * WIDTHS[k]:j * WIDTHS[k]] for k, i, j in zip(which.tolist(), ends[:-1].tolist(), ends[1:].tolist())]
    return out, sizes.tolist(), np.minimum(top, LONG - 2).tolist()


def unpack(column, dim: int) -> np.ndarray:
    """The vectors of a binary Arrow column as an int64 matrix."""
    raw = column.to_pylist()
    out = np.zeros((len(raw), dim), np.int64)
    sizes = np.array([len(r) for r in raw])
    for w in WIDTHS if dim else ():
        rows = np.flatnonzero(sizes == w * dim)
        if len(rows):
            out[rows] = np.frombuffer(b"".join([raw[i] for i in rows]), f"<i{w}").reshape(-1, dim)
    return out


def lattice(df: DataFrame, vec_col: str, carried: tuple[str, ...]) -> tuple[DataFrame, int, int]:
    """``(c0, c1, … (the carried columns), x binary)`` of all kept vectors, their length and a bound of the
    magnitude of their entries; staged.

    Kept are vectors as long as most are (ties: the longer) without an entry that is null, not finite or,
    as floor(256 * c), beyond a 64-bit integer. Equal vectors have equal bytes."""
    picked = df.select(F.col(vec_col).alias("_v"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)])

    def run(batches):
        for b in batches:
            x, ends, rows = integers(b.column(0))
            packed, sizes, tops = pack(x, ends)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [*[c.take(at) for c in b.columns[1:]], pa.array(packed, pa.binary()), pa.array(sizes, pa.int32()), pa.array(tops, pa.int64())],
                [*b.schema.names[1:], "x", "dim", "top"])

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in picked.schema.fields[1:])
    done = stage(map_arrow(picked, run, kinds + "x binary, dim int, top bigint"), "lattice")
    most = (done.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("top").alias("top"))
            .orderBy(F.col("n").desc(), F.col("dim").desc()).first())
    if most is None:
        return done.drop("dim", "top"), 0, 0
    return done.where(F.col("dim") == most.dim).drop("dim", "top"), most.dim, most.top + 1
