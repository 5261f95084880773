"""Seeded principle sampling (F16) and stage selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import texts as X
from ..schemas import PRINCIPLES


def principles(stage: str = "sl", kit: X.PromptKit = X.DEFAULT_KIT) -> list[tuple[str, str]]:
    """``rl`` selects the preference principles, anything else the critique/revision pairs."""
    if stage == "rl":
        return [(p, p) for p in kit.preferences]
    return list(kit.principles)


def principles_table(spark: SparkSession, kit: X.PromptKit = X.DEFAULT_KIT) -> DataFrame:
    """Both principle lists as one small table ``(stage, idx, critique, revision)``."""
    rows = [(stage, i, c, r) for stage in ("sl", "rl") for i, (c, r) in enumerate(principles(stage, kit))]
    return spark.createDataFrame(rows, PRINCIPLES)


def pick_index(n: int, seed: int | str, *keys: Column | str) -> Column:
    """A uniform index in ``[0, n)`` from md5 of ``seed:key1:key2…`` (first 8 hex digits).

    Deterministic per row, so a retried task picks the same principle.
    """
    parts = [F.lit(str(seed))] + [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    h = F.md5(F.concat_ws(":", *parts))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(n))


def sample_principle(seed: int | str, *keys: Column | str, stage: str = "sl",
                     kit: X.PromptKit = X.DEFAULT_KIT) -> Column:
    """F16: ``struct<critique, revision>`` picked with replacement per row and key."""
    ps = principles(stage, kit)
    arr = F.array(*[F.struct(F.lit(c).alias("critique"), F.lit(r).alias("revision")) for c, r in ps])
    return F.element_at(arr, (pick_index(len(ps), seed, *keys) + 1).cast("int"))
