"""Statistics of the gold stage: quartiles, IQR outliers, correlations, summary.

Nothing returns to the driver: quartile bounds are one row that re-enters the
plan as a scalar subquery, and the many statistics the reference
computes in separate jobs are folded into single aggregations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens.operators.ordered import (approx_quantiles, bucket_of, buckets_for, exact_quantiles,
                                       select_quantiles, split_points)
from vidlens.operators.rollups import fixed_avg

IQR_MULTIPLIER = 1.5  # fixed value of the reference
SUMMARY_METRICS = ("view_count", "like_count", "comment_count", "engagement_rate", "duration_seconds")


def quartiles(df: DataFrame, col: str = "view_count", exact: bool = True,
              relative_error: float = 0.01, group: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """One row per group (``q1``, ``q3``). Exact = ``percentile_disc``;
    ``buckets`` sizes the exact selection (from the data unless given)."""
    if exact:
        return exact_quantiles(df, col, [0.25, 0.75], ["q1", "q3"], group, buckets)
    return approx_quantiles(df, col, [0.25, 0.75], ["q1", "q3"], group, relative_error)


def iqr_bounds(df: DataFrame, col: str = "view_count", multiplier: float = IQR_MULTIPLIER,
               exact: bool = True, relative_error: float = 0.01, group: Sequence[str] = (),
               buckets: int | None = None) -> DataFrame:
    q = quartiles(df, col, exact, relative_error, group, buckets)
    iqr = F.col("q3") - F.col("q1")
    return q.select(*group, "q1", "q3",
                    (F.col("q1") - multiplier * iqr).alias("lower_bound"),
                    (F.col("q3") + multiplier * iqr).alias("upper_bound"))


def flag_outliers(df: DataFrame, col: str = "view_count", multiplier: float = IQR_MULTIPLIER,
                  exact: bool = True, relative_error: float = 0.01, group: Sequence[str] = (),
                  flag: str = "is_outlier_views", buckets: int | None = None) -> DataFrame:
    """F4 + J2: ``flag`` = value strictly outside the IQR fences.

    Bounds are global by default (as the reference); ``group`` computes them
    per group. An empty input gets no bounds and every flag is False.
    """
    b = iqr_bounds(df, col, multiplier, exact, relative_error, group, buckets).select(
        *group, F.col("lower_bound").alias("_lo"), F.col("upper_bound").alias("_hi"))
    if group:
        j = df.join(b, list(group), "left")      # one row per group; AQE broadcasts when small
    else:
        # one global row: two scalar subqueries, merged and computed once by Spark
        j = df.withColumn("_lo", b.select("_lo").scalar()).withColumn("_hi", b.select("_hi").scalar())
    v = F.col(col)
    out = j.withColumn(flag, F.when(F.col("_lo").isNull() | F.col("_hi").isNull(), F.lit(False))
                              .otherwise((v < F.col("_lo")) | (v > F.col("_hi"))))
    return out.drop("_lo", "_hi")


def outlier_rate(flagged: DataFrame, flag: str = "is_outlier_views") -> DataFrame:
    """Outlier count, total and percent (2 dp), in one aggregation."""
    return flagged.agg(F.count_if(F.col(flag)).alias("outlier_count"),
                       F.count(F.lit(1)).alias("total_count")).select(
        "outlier_count", "total_count",
        F.when(F.col("total_count") > 0,
               F.round(F.col("outlier_count") / F.col("total_count") * 100, 2))
         .otherwise(F.lit(0.0)).alias("outlier_pct"))


def top_outliers(flagged: DataFrame, n: int = 10, flag: str = "is_outlier_views") -> DataFrame:
    """P11 + O4: the ``n`` largest outliers by views (video_id breaks ties)."""
    return (flagged.filter(F.col(flag))
                   .select("video_id", "keyword", "view_count", "like_count", "comment_count")
                   .orderBy(F.desc("view_count"), F.asc("video_id")).limit(n))


def safe_corr(x: str, y: str):
    """Pearson correlation, NULL when undefined (zero variance or no rows)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def metric_correlations(df: DataFrame, digits: int = 6) -> DataFrame:
    """A9 + A10 in one aggregation."""
    return df.agg(
        F.round(safe_corr("view_count", "engagement_rate"), digits).alias("corr_views_engagement"),
        F.round(safe_corr("like_count", "comment_count"), digits).alias("corr_likes_comments"),
        F.round(safe_corr("duration_seconds", "view_count"), digits).alias("corr_duration_views"),
        F.round(F.covar_samp("view_count", "like_count"), 2).alias("cov_views_likes"))


def metric_summary(df: DataFrame, metrics: Sequence[str] = SUMMARY_METRICS, exact: bool = True,
                   buckets: int | None = None) -> DataFrame:
    """A7, typed: one row per metric with count, mean, stddev, min, quartiles, max.

    The metrics are unpivoted (a projection, no shuffle) so one grouped
    aggregation and one grouped quantile pass serve all of them.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])).alias("_m")).select("_m.metric", "_m.value")
    basic = long.groupBy("metric").agg(
        F.count("value").alias("count"),
        fixed_avg("value", 6).alias("mean"),
        F.round(F.stddev_samp("value"), 6).alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"))
    if exact:
        # The split points of all metrics are one row, attached as a scalar: the
        # unpivoted rows are counted before they are shuffled, and no join by
        # metric brings all of a metric's rows to one task.
        if buckets is None:
            buckets = buckets_for(max(df.agg(*[F.approx_count_distinct(m).alias(m) for m in metrics]).first()))
        typed = df.select(*[F.col(m).cast("double").alias(m) for m in metrics])
        splits = typed.agg(*[split_points(m, buckets).alias(f"_s{i}") for i, m in enumerate(metrics)])
        split_row = splits.select(F.struct("*").alias("_splits")).scalar()
        with_splits = df.select(*metrics).withColumn("_splits", split_row)
        unpivoted = with_splits.select(F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.col(f"_splits._s{i}").alias("_s"))
            for i, m in enumerate(metrics)])).alias("_m")).select("_m.*").where(F.col("value").isNotNull())
        bucketed = unpivoted.select("metric", "value", bucket_of(F.col("value"), F.col("_s"), buckets - 1, False).alias("_b"))
        bucketed = bucketed.withColumn("_gk", F.struct("metric"))
        qs = select_quantiles(bucketed, "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], ["metric"])
    else:
        qs = approx_quantiles(long, "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], ["metric"])
    # both sides have one row per metric: a bounded broadcast
    return basic.join(F.broadcast(qs), "metric", "left").select(
        "metric", "count", "mean", "stddev", "min", "p25", "p50", "p75", "max")
