"""Exact positions in a total order without a global sort (S2, L1, O2) and skew-safe ranks.

A global ``row_number()`` or ``orderBy().limit()`` funnels rows into one task. Three ways
around it:

* ``value_at`` finds the value at a position by narrowing an integer range: each pass counts
  at most 65,536 sub-ranges and keeps the one that holds the position, however the values are
  spread, so the final selection is a plain filter that Spark can push into the scan;
* ``exact_split`` does the same over hash prefixes, then over the few keys of one prefix;
* ``row_numbers`` numbers all rows: a range partitioning (bounds sampled from the data, so
  outliers do not crowd the rest), a sort inside each partition and one offset per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table

HASH_BUCKET_CHARS = 4  # 16^4 = 65,536 buckets at most: the count table's size bound
NARROW_BITS = 16       # sub-ranges per pass of ``value_at``: at most 2^16 counts


# ---- numbering all rows ---------------------------------------------------------------------

def _sorted_parts(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``_mid``: partition of the range-partitioned order (high bits) and place in it; staged."""
    return stage_table(df.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("_mid", F.monotonically_increasing_id()), "numbered")


def row_numbers(df: DataFrame, order: Sequence[Column], column: str) -> DataFrame:
    """Number the rows 0, 1, 2, … in ``order``. Equal rows are numbered in any order.

    The sorted partitions are written before they are counted: a second evaluation could draw
    other range bounds, and a lost executor must not change the numbers.
    """
    part = _sorted_parts(df, order).withColumn("_part", F.shiftright("_mid", 33))
    sizes = part.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (part.join(F.broadcast(offsets), "_part")  # one row per partition of the sort
            .withColumn(column, F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_part", "_mid", "_off"))


# ---- one position of an integer order -------------------------------------------------------

def value_at(df: DataFrame, col: str, position: int) -> int | None:
    """The value at 1-based ``position`` of the ascending non-null integers of ``col`` (repeats counted).

    Every pass counts the values by their leading bits inside the range found so far and keeps
    the sub-range that holds the position: four passes at most for 64-bit values, two for
    ordinary ids. Nothing is sorted and no data row leaves its task.
    """
    v = F.col(col).cast("bigint")
    df = df.filter(v.isNotNull())
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    if lo is None or position < 1:
        return None
    while lo < hi:
        shift = max(0, (hi - lo).bit_length() - NARROW_BITS)
        counts = (df.filter((F.col(col) >= F.lit(lo)) & (F.col(col) <= F.lit(hi)))
                  .groupBy(F.shiftright(v, shift).alias("b")).agg(F.count(F.lit(1)).alias("n")))
        upto = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))  # counts only
        hit = counts.withColumn("upto", upto).filter(F.col("upto") >= F.lit(position)).orderBy("b").first()
        if hit is None:
            return None
        position -= hit["upto"] - hit["n"]
        lo, hi = max(lo, hit["b"] << shift), min(hi, ((hit["b"] + 1) << shift) - 1)
    return lo if df.filter(F.col(col) == F.lit(lo)).limit(position).count() == position else None


# ---- L1 exact seeded split ----------------------------------------------------------------

def _key_string(key_cols: Sequence[str]) -> Column:
    return F.concat_ws("\x1f", *[F.col(k).cast("string") for k in key_cols])


def split_hash(seed: int | str, key_cols: Sequence[str]) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), _key_string(key_cols)))


def split_boundary(df: DataFrame, key_cols: Sequence[str], test_size: float | int = 0.1,
                   seed: int | str = 42) -> tuple[str, str, int | None] | None:
    """The last ``(hash, key, row hash)`` of the test part, or None if it is empty.

    The row hash only matters where the last key has several rows and not all of them fit
    (None: all do).
    """
    h, k = split_hash(seed, key_cols), _key_string(key_cols)
    prefix = F.substring(h, 1, HASH_BUCKET_CHARS)
    counts = df.groupBy(prefix.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))  # at most 65,536 counts
    total = F.sum("n").over(Window.partitionBy())
    if isinstance(test_size, int) and not isinstance(test_size, bool) and test_size >= 1:
        wanted = F.least(total, F.lit(int(test_size)))
    else:
        wanted = F.ceil(total * F.lit(float(test_size)))
    hit = (counts.select("b", "n", upto.alias("upto"), wanted.cast("bigint").alias("p"))
           .filter((F.col("upto") >= F.col("p")) & (F.col("p") > 0)).orderBy("b").first())
    if hit is None:
        return None
    left = hit["p"] - (hit["upto"] - hit["n"])
    keys = df.filter(prefix == F.lit(hit["b"])).groupBy(h.alias("h"), k.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("h", "k").rowsBetween(Window.unboundedPreceding, 0)  # the keys of one prefix
    at = keys.withColumn("upto", F.sum("n").over(order)).filter(F.col("upto") >= F.lit(left)).orderBy("h", "k").first()
    left -= at["upto"] - at["n"]
    if left == at["n"]:
        return at["h"], at["k"], None
    rows = df.filter((h == F.lit(at["h"])) & (k == F.lit(at["k"]))).select(F.xxhash64(*df.columns).alias("x"))
    x = value_at(rows, "x", left)
    if rows.filter(F.col("x") <= F.lit(x)).count() != left:
        raise ValueError("the split cannot be exact: identical rows share the boundary key")
    return at["h"], at["k"], x


def exact_split(df: DataFrame, key_cols: Sequence[str], test_size: float | int = 0.1,
                seed: int | str = 42, column: str = "split") -> DataFrame:
    """L1: seeded, disjoint, complete, exact-size split (``ceil(test_size·n)`` test rows).

    Rows are ordered by ``md5(seed:key)``, the key, and, where a key has several rows, a hash of
    the whole row; the first part is ``test``. Rows that are equal in every column cannot be
    told apart: if the boundary falls between such rows, ValueError is raised. The test flag is
    a comparison with one boundary, so no row is shuffled. ``test_size`` ≥ 1 (an int) is a row
    count, otherwise a fraction rounded up.
    """
    b = split_boundary(df, key_cols, test_size, seed)
    if b is None:
        return df.withColumn(column, F.lit("train"))
    h, k = split_hash(seed, key_cols), _key_string(key_cols)
    last = (h == F.lit(b[0])) & (k == F.lit(b[1]))
    if b[2] is not None:
        last = last & (F.xxhash64(*df.columns) <= F.lit(b[2]))
    is_test = (h < F.lit(b[0])) | ((h == F.lit(b[0])) & (k < F.lit(b[1]))) | last
    return df.withColumn(column, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


# ---- S2 positional slice and job ranges --------------------------------------------------

def slice_rows(df: DataFrame, order_col: str, start: int, length: int) -> DataFrame:
    """Rows ``[start, start+length)`` of the ascending order of a unique integer key.

    A short table yields fewer rows (no error past the end); null keys are never selected.
    """
    if length <= 0:
        return df.limit(0)
    first = value_at(df, order_col, start + 1)
    if first is None:
        return df.limit(0)
    c = F.col(order_col) >= F.lit(first)
    last = value_at(df, order_col, start + length)
    if last is not None:
        c = c & (F.col(order_col) <= F.lit(last))
    return df.filter(c)


def assign_jobs(df: DataFrame, order_col: str, rows_per_job: int, column: str = "job_id",
                offset: int = 0) -> DataFrame:
    """Job ``j`` gets rows ``[offset + j·w, offset + (j+1)·w)`` of the key order; earlier rows
    are dropped (already generated), every later row gets a job (null keys get none).

    Only the keys are numbered; the job is arithmetic on a key's number, so neither the plan
    nor the driver grows with the number of jobs. Rows that share a key share its job.
    """
    keys = df.select(F.col(order_col).alias("_key"), F.monotonically_increasing_id().alias("_tie")).filter("_key IS NOT NULL")
    keys = row_numbers(keys, [F.col("_key"), F.col("_tie")], "_pos")  # a key of very many rows is cut like any range
    job = F.floor((F.col("_pos") - F.lit(offset)) / F.lit(rows_per_job)).cast("int")
    jobs = (keys.groupBy("_key").agg(F.min("_pos").alias("_pos")).filter(F.col("_pos") >= F.lit(offset))
            .select("_key", job.alias(column)))
    return df.join(jobs, F.col(order_col) == F.col("_key")).drop("_key")


# ---- skew-safe rank within groups -------------------------------------------------------

def group_rank(df: DataFrame, group_cols: Sequence[str], order_col: str, column: str = "rank",
               seed: int | str | None = None) -> DataFrame:
    """``row_number()`` over ``(partition by group order by …)`` that survives a hot group.

    All rows are numbered in (group, order) and each group's first number is taken off, so a
    group holding a third of all rows is spread over many tasks like any other range. With
    ``seed`` the order is ``md5(seed:key)`` then the key. ``df`` is staged: keep it narrow.
    """
    order = [F.col(order_col)]
    if seed is not None:
        order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col(order_col).cast("string"))), *order]
    named = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    numbered = row_numbers(df.select("*", *named), [*[F.col(g) for g in group_cols], *[F.col(f"_o{i}") for i in range(len(order))]],
                           "_pos").drop(*[f"_o{i}" for i in range(len(order))])
    first = numbered.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)]).agg(F.min("_pos").alias("_first"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group_cols)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return (numbered.join(first, cond).withColumn(column, F.col("_pos") - F.col("_first") + 1)
            .drop("_pos", "_first", *[f"_g{i}" for i in range(len(group_cols))]))
