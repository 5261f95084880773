"""SimHash near-duplicates: multi-index hashing over 64-bit fingerprints and connected components."""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, map_arrow, raw_texts, stage

SEED = 42
BLOCK = 1 << 14  # shingle hashes held at once
HALF = 32  # two segments of 32 bits
HOT = 1000  # fingerprints of a bucket above which it is searched by its other bits too


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit SimHash of one text: bit set if set in over half of the shingle hashes; no word: 0."""
    words = text.lower().split()  # bytes: A-Z only, and splits at x20 and x09-x0D only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    grams, n, ones = iter(grams), 0, np.zeros(64, np.int64)
    while part := [xxhash.xxh64_intdigest(g, SEED) for g in islice(grams, BLOCK)]:
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 *carried: str) -> DataFrame:
    """(_id, carried columns, _fp bigint) per row: the fingerprint's 64 bits as a signed long."""
    names = ["_id", *carried, "_fp"]

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(x, shingle) for x in raw_texts(b.column(0))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fps.view(np.int64))], names)

    picked = docs.select(F.col(text_col).alias("_t"), F.col(id_col).alias("_id"), *carried)
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in picked.schema.fields[1:])
    return map_arrow(picked, run, f"{kinds}_fp bigint")


def _ball(value: Column, radius: int) -> Column:
    """The 32-bit values within ``radius`` (0 or 1) of ``value`` that it asks the table for: itself,
    and itself with one unset bit set (of two values that differ in one bit, one has it unset)."""
    if radius == 0:
        return F.array(value)
    bits = F.array(*[F.lit(1 << i).cast("bigint") for i in range(HALF)])
    unset = F.filter(bits, lambda b: value.bitwiseAND(b) == 0)
    return F.concat(F.array(value), F.transform(unset, lambda b: value.bitwiseOR(b)))


def _flipped(value: Column, flips: Column) -> Column:
    return F.transform(flips, lambda f: value.bitwiseXOR(f))


def links(fps: DataFrame, max_bits: int = 3, hot: int = HOT) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints within ``max_bits`` (at most 3) differing bits.

    Two fingerprints within 3 bits differ by at most one bit in one of their 32-bit halves, so
    the ball of radius 1 around each half meets the partner's half in an exact-match table.
    Buckets of the table with more than ``hot`` fingerprints are searched the same way once
    more: the other half splits into two 16-bit parts, one of which differs by at most one bit,
    so only fingerprints that agree on 48 bits up to two flips meet. Matches are verified on all
    64 bits. ``fps`` has distinct ``_fp``."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two 32-bit segments with balls of radius 1 cover at most 3 bits")
    radius = 1 if max_bits > 1 else 0
    hi = F.shiftrightunsigned("_fp", HALF)
    lo = F.col("_fp").bitwiseAND(F.lit((1 << HALF) - 1))
    tag = 1 << HALF  # marks keys of the lower half
    table = fps.select(F.explode(F.array(hi, lo.bitwiseOR(F.lit(tag)))).alias("_key"), F.col("_fp").alias("v"))
    halves = fps.select("_fp", hi.alias("_hi"), lo.alias("_lo"))
    probes = halves.select(F.col("_fp").alias("u"), F.explode(F.concat(
        _ball(F.col("_hi"), radius),
        F.transform(_ball(F.col("_lo"), radius), lambda x: x.bitwiseOR(F.lit(tag))))).alias("_key"))
    crowded = stage(table.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("_key"), "simhash_crowded")
    met = probes.join(table, "_key")
    if crowded.limit(1).count():
        met = probes.join(crowded, "_key", "left_anti").join(table, "_key")
        parts = [F.shiftrightunsigned(F.col("_other"), 16), F.col("_other").bitwiseAND(F.lit(0xFFFF)).bitwiseOR(F.lit(1 << 16))]
        flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << i).cast("bigint") for i in range(16)])

        def other(fp: str):  # the half that the key is not made of
            return F.when(F.col("_key").bitwiseAND(F.lit(tag)) == 0, F.col(fp).bitwiseAND(F.lit(tag - 1))).otherwise(F.shiftrightunsigned(fp, HALF))

        fine = table.join(crowded, "_key").withColumn("_other", other("v")).select("_key", "v", F.explode(F.array(*parts)).alias("_part"))
        ask = probes.join(crowded, "_key").withColumn("_other", other("u")).select(
            "_key", "u", F.explode(F.concat(*[_flipped(p, flips) for p in parts])).alias("_part"))
        met = met.select("u", "v").union(ask.join(fine, ["_key", "_part"]).select("u", "v"))
    bits = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    return met.where((F.col("u") != F.col("v")) & (bits <= max_bits)).select("u", "v")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``(<id>, fingerprint, component_id)``.

    Equal fingerprints are collapsed first, so groups of copies cost one entry of the search.
    component_id is the smallest id in the component of linked fingerprints (null only if every
    id in it is null). Null or empty texts have fingerprint zero and link like any other; an
    empty table gives no rows; repeated rows are all returned; other columns are not read."""
    fps = stage(fingerprints(docs, id_col, text_col, shingle), "simhash")
    return _labelled(fps, max_bits).select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def _labelled(fps: DataFrame, max_bits: int) -> DataFrame:
    uniq = stage(fps.groupBy("_fp").agg(F.min("_id").alias("_first")), "simhash_classes")
    comp = stage(components(links(uniq.select("_fp"), max_bits)), "simhash_components")
    rooted = (uniq.join(comp, uniq["_fp"] == comp["node"], "left")
              .select("_fp", "_first", F.coalesce("root", "_fp").alias("_root")))
    least = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    classes = stage(rooted.join(least, "_root").select("_fp", "component_id"), "simhash_labels")
    return fps.join(classes, "_fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` (all columns) with one row kept of every component.

    The row with the smallest id stays; of rows that share it, the one with the smallest text
    digest, and of rows with equal ids and texts any one, even if other columns differ. Only ids, digests and fingerprints are searched; the texts are
    shuffled once, for the final semi-join."""
    key = F.md5(F.concat_ws("\x1f", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(id_col).isNull().cast("string"),
                            F.coalesce(text_col, F.lit(""))))
    keyed = docs.withColumn("_key", key)
    fps = stage(fingerprints(keyed, id_col, text_col, shingle, "_key"), "simhash")
    kept = (_labelled(fps, max_bits).groupBy("component_id")
            .agg(F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_key").alias("k"))).alias("m"))
            .select(F.col("m.k").alias("_key")))
    return keyed.join(stage(kept, "simhash_kept"), "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)
