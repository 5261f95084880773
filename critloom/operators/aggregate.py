"""Score aggregates (A1–A3), the long metrics table (K4 shape) and the best step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import texts as X

ROUND = 6


def has_category(category: str = "category"):
    """A category enters the per-category means only when present and non-empty."""
    c = F.col(category)
    return c.isNotNull() & (c != "")


def eval_metrics(details: DataFrame, step: str = "step", category: str = "category",
                 score: str = "score") -> DataFrame:
    """A3: the metrics record of every step as a long table ``(step, category, metric, value)``.

    One pass with grouping sets ``(step, category)`` and ``(step)``: overall rows carry
    ``teaching_quality_{score,std,min,max}`` with a null category (every row counts, whatever
    its category); category rows carry ``teaching_quality_<category>`` for non-empty
    categories only. Partial aggregation makes a hot step or category harmless.
    """
    s = F.col(score)
    g = (details.groupingSets([[step, category], [step]], step, category)
         .agg(F.avg(s).alias("_mean"), F.stddev_pop(s).alias("_std"), F.min(s).alias("_min"),
              F.max(s).alias("_max"), F.grouping_id().alias("_gid")))
    return _long_metrics(g, step, category)


def _long_metrics(g: DataFrame, step: str, category: str) -> DataFrame:
    """Metric rows of aggregated steps (``_gid`` 1) and categories (0)."""
    overall = F.array(*[
        F.struct(F.lit(None).cast("string").alias("category"), F.lit(X.METRIC_PREFIX + name).alias("metric"),
                 F.col(c).cast("double").alias("value"))
        for name, c in (("score", "_mean"), ("std", "_std"), ("min", "_min"), ("max", "_max"))])
    per_cat = F.array(F.struct(F.col(category).alias("category"),
                               F.concat(F.lit(X.METRIC_PREFIX), F.col(category)).alias("metric"),
                               F.col("_mean").cast("double").alias("value")))
    # One pass over the aggregate: overall rows expand to four metrics, category rows to one.
    keep = (F.col("_gid") == 1) | has_category(category)
    return (g.filter(keep)
            .select(F.col(step).cast("bigint").alias("step"),
                    F.explode(F.when(F.col("_gid") == 1, overall).otherwise(per_cat)).alias("_m"))
            .select("step", "_m.category", "_m.metric", "_m.value"))


def score_counts(details: DataFrame, *by: str, category: str = "category", score: str = "score") -> DataFrame:
    """How often each score occurs per category (and ``by``): a histogram that adds up, so the metrics of
    parts of a step follow from those of the parts. Rows without a score are counted under null."""
    return details.groupBy(*by, category, score).agg(F.count(F.lit(1)).alias("n"))


def metrics_of_counts(counts: DataFrame, step: str = "step", category: str = "category", score: str = "score") -> DataFrame:
    """``eval_metrics`` from histograms (``score_counts`` by step, several per step if they were counted in
    parts): no graded row is read. Deviations are taken from the mean, not from sums of squares."""
    both = F.array(F.struct(F.col(category).alias("_c"), F.lit(0).alias("_gid")),
                   F.struct(F.lit(None).cast("string").alias("_c"), F.lit(1).alias("_gid")))
    rows = counts.select(F.col(step).alias("_s"), F.explode(both).alias("_g"), F.col(score).alias("_x"), "n").select("_s", "_g.*", "_x", "n")
    rows = rows.groupBy("_s", "_c", "_gid", "_x").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)
    n = F.when(F.col("_x").isNotNull(), F.col("n"))
    mean = rows.groupBy("_s", "_c", "_gid").agg((F.sum(F.col("_x") * n) / F.sum(n)).alias("_mean"), F.min("_x").alias("_min"),
                                                F.max("_x").alias("_max"))
    same = F.col("_s").eqNullSafe(F.col("_s2")) & F.col("_c").eqNullSafe(F.col("_c2")) & (F.col("_gid") == F.col("_gid2"))
    apart = rows.join(mean.select(F.col("_s").alias("_s2"), F.col("_c").alias("_c2"), F.col("_gid").alias("_gid2"), "_mean"), same)
    away = F.col("_x") - F.col("_mean")
    std = apart.groupBy("_s2", "_c2", "_gid2").agg(F.sqrt(F.sum(away * away * n) / F.sum(n)).alias("_std"))
    g = mean.join(std, same).select(F.col("_s").alias(step), F.col("_c").alias(category), "_gid", "_mean", "_std", "_min", "_max")
    return _long_metrics(g, step, category)


def metrics_record(metrics: DataFrame) -> DataFrame:
    """The flat record of each step, ``(step, metrics map<string,double>)``, for the edge only.

    Names can collide (a category called ``score``); as in the flat record this replaces,
    the category value wins in the map while the long table keeps both. A step holds a
    handful of metrics, so its map is small.
    """
    one = (metrics.groupBy("step", "metric")
           .agg(F.max_by("value", F.col("category").isNotNull().cast("int")).alias("value")))
    return one.groupBy("step").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value")))).alias("metrics"))


def best_step(metrics: DataFrame, metric: str = X.METRIC_PREFIX + "score", mode: str = "max",
              by: list[str] | None = None) -> DataFrame:
    """The step with the best value of ``metric``; ties go to the lowest step.

    ``max_by`` over ``(value, -step)`` aggregates partially: no global sort, no window.
    """
    m = metrics.filter((F.col("metric") == metric) & F.col("category").isNull() & F.col("value").isNotNull())
    v = F.col("value") if mode == "max" else -F.col("value")
    key = F.struct(v.alias("v"), (-F.col("step")).alias("s"))
    return m.groupBy(*(by or [])).agg(
        F.lit(metric).alias("metric"),
        F.max_by(F.col("step"), key).alias("best_step"),
        F.max_by(F.col("value"), key).alias("best_value"),
        F.count(F.lit(1)).alias("n_steps"),
    )


def rounded(df: DataFrame, cols: list[str], digits: int = ROUND) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])

