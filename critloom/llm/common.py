"""Helpers shared by the operators: bounded text chunks, hashing, connected components."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import row_numbers  # noqa: F401 - numbering without a global window
from ..session import ship_package
from ..session import stage_table as stage

BATCH_BYTES = 4 << 20  # of an Arrow batch (a longer single row stands alone)
CHUNK_BYTES = 1 << 20  # text handled at once by a vectorised step (a longer single text stands alone)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the executors and batches bounded by their
    bytes: the session's limit of an Arrow batch is set to ``BATCH_BYTES``, as rows are whole texts."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def raw_texts(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null is empty."""
    return [b"" if x is None else x for x in column.cast("binary").to_pylist()]


def chunks(raw: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) whose texts hold at most ``limit`` bytes together, one row at least."""
    i, held = 0, 0
    for j, x in enumerate(raw):
        if j > i and held + len(x) > limit:
            yield i, j
            i, held = j, 0
        held += len(x)
    if i < len(raw):
        yield i, len(raw)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift) for uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def crc_mod(col: str, m: int) -> Column:
    """crc32 of a column's text form modulo ``m`` (null for null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u bigint, v bigint) → (node, root), root = smallest node.

    Alternating large-star and small-star steps: every round replaces the edges by at most as
    many edges towards smaller nodes until they form stars. Minima aggregate on the map side;
    hot nodes meet only in plain joins, which the adaptive skew join splits. Each round is
    staged. Nodes without an edge to another node are not returned; empty edges give no rows."""
    cur = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "edges")
    seen = None
    while True:
        sign = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if sign.n == 0 or sign == seen:
            break
        seen = sign
        both = cur.union(cur.select("v", "u"))
        low = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "large_min")
        big = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .where("u <> v").distinct())
        big = stage(big, "large_star")  # every edge points from the larger node to a smaller one
        low = stage(big.groupBy("u").agg(F.min("v").alias("m")), "small_min")
        small = (big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        cur = stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small_star")
    pairs = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(cur.select(F.col("v"), F.col("v")).distinct())
