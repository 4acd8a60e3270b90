"""Quantiles of any filter from stored sketches (A8), with a bound on their rank error.

A KLL sketch of a group's values has a bounded size and merges with others, so one
row for each keyword and day answers quartiles of any span of days or set of
keywords without reading the rows again. ``certify`` counts, in one pass over the
rows, where an answer really stands, and says whether that is inside the bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 2000


def rank_error(k: int = K) -> float:
    """Twice the error (as a share of the rows) that a KLL sketch of size ``k`` keeps to 99 times in 100."""
    return 2 * 2.296 / k ** 0.9021


def sketch(df: DataFrame, value: str, group: Sequence[str], k: int = K) -> DataFrame:
    """group..., n, sketch of the whole-number column ``value``; NULLs have no place in it."""
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("long").alias("_v"))
    return rows.groupBy(*group).agg(F.count("_v").alias("n"), F.kll_sketch_agg_bigint("_v", k).alias("sketch"))


def merged(sketches: DataFrame, group: Sequence[str] = (), k: int = K) -> DataFrame:
    """group..., n, sketch of whatever rows of a stored sketch table are given."""
    out = sketches.groupBy(*group).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))
    return out.where("n > 0")


def quantiles(sketches: DataFrame, probs: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """group..., n, p, q: one row a group and probability."""
    answers = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))).alias("q"))
                        for p in probs])
    return sketches.select(*group, "n", F.explode(answers).alias("_a")).select(*group, "n", "_a.p", "_a.q")


def certify(answers: DataFrame, rows: DataFrame, value: str, group: Sequence[str] = (), k: int = K) -> DataFrame:
    """Adds ``rank_low`` and ``rank_high``, the shares of rows below and up to ``q``, and ``inside``: whether p is
    within ``rank_error`` of that range. One counting pass; the answers, few a group, meet the rows by group."""
    keyed = F.struct(*[F.col(g) for g in group]) if group else F.lit(0)
    points = (answers.select(keyed.alias("_g"), F.struct("p", "q").alias("_a")).groupBy("_g").agg(F.collect_list("_a").alias("_a")))
    values = (rows.where(F.col(value).isNotNull()).select(keyed.alias("_g"), F.col(value).cast("long").alias("_v"))
              .groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_n")))
    met = values.join(points, "_g").select("_g", "_v", "_n", F.explode("_a").alias("_a"))
    ranks = met.groupBy("_g", F.col("_a.p").alias("p")).agg(
        F.sum("_n").alias("_all"), F.sum(F.when(F.col("_v") < F.col("_a.q"), F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("_v") <= F.col("_a.q"), F.col("_n")).otherwise(0)).alias("_upto"))
    out = answers.withColumn("_g", keyed).join(ranks, ["_g", "p"])
    low, high = F.col("_below") / F.col("_all"), F.col("_upto") / F.col("_all")
    off = F.greatest(low - F.col("p"), F.col("p") - high, F.lit(0.0))
    return out.select(*group, "n", "p", "q", low.alias("rank_low"), high.alias("rank_high"), (off <= rank_error(k)).alias("inside"))
