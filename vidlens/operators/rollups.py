"""Grouped summaries and ordered reports.

All are hash aggregations with partial (map-side) aggregation, so a hot
keyword is pre-reduced in every map task before the shuffle; every report
limit is a bounded top-k (TakeOrderedAndProject) with a deterministic
tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens.functions import features as feat

# Averages are taken on an exact decimal image of the input, then rounded: the
# inputs are fixed-point (counts, or ratios already rounded), so exact ties at
# the rounding digit are common, and a floating-point sum would let the
# summation order (partitioning, task timing) decide them.
AVG_SCALE = 12


def fixed_avg(col: str, digits: int):
    """``round(avg(col), digits)`` computed exactly (HALF_UP), as double."""
    return F.round(F.avg(F.col(col).cast(f"decimal(38,{AVG_SCALE})")), digits).cast("double")


def keyword_engagement(df: DataFrame) -> DataFrame:
    """A1: mean engagement and video count per keyword."""
    return df.groupBy("keyword").agg(
        fixed_avg("engagement_rate", 4).alias("avg_engagement_rate"),
        F.count(F.lit(1)).alias("video_count"))


def top_keywords_by_engagement(df: DataFrame, n: int = 10) -> DataFrame:
    """O1: top ``n`` keywords by mean engagement (keyword breaks ties)."""
    return keyword_engagement(df).orderBy(F.desc_nulls_last("avg_engagement_rate"),
                                          F.asc_nulls_last("keyword")).limit(n)


def duration_category_counts(df: DataFrame) -> DataFrame:
    """A2 + O2: rows per duration category, largest first."""
    return (df.groupBy("duration_category").agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc_nulls_last("duration_category")))


def keyword_category_summary(df: DataFrame, outlier_col: str | None = "is_outlier_views") -> DataFrame:
    """A3 + A4 + A5 + O3: the gold keyword x category summary.

    ``outlier_video_count`` is always emitted: counted from ``outlier_col``
    when that column exists, NULL otherwise (a stable schema for the tables).
    """
    aggs = [
        F.count(F.lit(1)).alias("total_videos"),
        F.sum("view_count").alias("total_views"),
        fixed_avg("view_count", 2).alias("avg_views"),
        fixed_avg("engagement_rate", 6).alias("avg_engagement_rate"),
        fixed_avg("duration_seconds", 1).alias("avg_duration_sec"),
        F.count_if(F.col("performance_tier") == "Viral").alias("viral_video_count"),
    ]
    if outlier_col and outlier_col in df.columns:
        aggs.append(F.count_if(F.col(outlier_col)).alias("outlier_video_count"))
    else:
        aggs.append(F.lit(None).cast("long").alias("outlier_video_count"))
    return df.groupBy("keyword", "category_name").agg(*aggs)


def summary_report(summary: DataFrame, n: int | None = None) -> DataFrame:
    """O3: the summary by total views, largest first; the first ``n`` rows if given."""
    out = summary.orderBy(F.desc("total_views"), F.asc_nulls_last("keyword"), F.asc_nulls_last("category_name"))
    return out.limit(n) if n else out


def distinct_keywords(df: DataFrame, n: int | None = None) -> DataFrame:
    """All distinct keywords, in no order; with ``n`` (O5) the first ``n`` in order."""
    out = df.select("keyword").distinct()
    return out.orderBy(F.asc_nulls_last("keyword")).limit(n) if n else out


def keyword_popularity(df: DataFrame, primary_keyword: str | None = None) -> DataFrame:
    """A6 + F13: live keyword totals over feature rows."""
    return (df.groupBy("search_keyword").agg(
                F.sum("views").alias("total_views"),
                F.sum("likes").alias("total_likes"),
                F.sum("comments").alias("total_comments"),
                fixed_avg("daily_view_velocity", 2).alias("avg_daily_view_velocity"),
                fixed_avg("engagement_rate_%", 2).alias("avg_engagement_rate_%"),
                fixed_avg("duration_seconds", 0).alias("avg_duration_seconds"))
              .withColumn("keyword_type", feat.keyword_type("search_keyword", primary_keyword)))
