"""Registered queries: one per operator group of the survey inventory.

Every query reads the shared test tables (through the ``videos`` fixture
mapping or directly) so its work grows with them; each has a DuckDB twin in
``ORACLE`` unless it is not expressible in SQL.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vidlens import schemas
from vidlens.operators import clean, filters, live, rollups, stats, windows
from vidlens.plans import medallion
from vidlens.plans import oracle as O
from vidlens.session import apply_plan_defaults, materialize, scratch_path
from vidlens.sinks import tables
from vidlens.sources import fixtures

# Fixed run clock for reproducible registered queries.
AS_OF = "2002-01-01"
RUN_TS = "2002-01-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_plan_defaults(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture videos -> silver rows with a fixed run clock and total dedup order."""
    return clean.clean_videos(fixtures.videos(spark, sf_dir), dedup_order=fixtures.VIDEOS_DEDUP_ORDER,
                              etl_date=AS_OF, processed_at=RUN_TS)


def partitioned_silver(spark, sf_dir, columns=None):
    """Silver as the gold stage finds it: a written table, partitioned by keyword. Every row of it; of its
    columns those that the query reads (all unless given)."""
    path = scratch_path(spark, f"vidlens-silver-{uuid.uuid4().hex}")
    schema = StructType([f for f in medallion.SILVER_SCHEMA if columns is None or f.name in columns])
    tables.overwrite(tables.align(silver(spark, sf_dir), schema), path)
    return tables.read_table(spark, path, schema)


SILVER_OUT = ["video_id", "title", "channel", "published_at", "keyword", "platform", "view_count",
              "like_count", "comment_count", "description", "duration_seconds", "duration_category",
              "category_id", "category_name", "tags", "tag_count", "has_captions", "definition",
              "licensed_content", "published_year", "published_month", "engagement_rate",
              "like_to_comment_ratio", "performance_tier"]


@register("clean_videos", O.with_silver(
    f"SELECT {', '.join(SILVER_OUT)}, CAST(published_at_ts AS VARCHAR) AS published_at_ts FROM silver"))
def q_clean_videos(spark, sf_dir):
    s = silver(spark, sf_dir)
    return s.select(*SILVER_OUT, F.col("published_at_ts").cast("string").alias("published_at_ts"))


@register("keyword_category_summary", None)
def q_keyword_category_summary(spark, sf_dir):
    """Gold: silver -> IQR outlier flag -> keyword x category summary (A3-A5, O3)."""
    return rollups.keyword_category_summary(flagged(spark, sf_dir))


# ---- batch features, rollups, filters ----------------------------------------

@register("batch_features", O.with_silver(
    "SELECT video_id, keyword, view_count, engagement_rate, like_to_comment_ratio, performance_tier FROM silver"))
def q_batch_features(spark, sf_dir):
    return silver(spark, sf_dir).select("video_id", "keyword", "view_count", "engagement_rate",
                                        "like_to_comment_ratio", "performance_tier")


@register("keyword_engagement_top10", O.with_silver(f"""
SELECT keyword, {O.ravg('engagement_rate', 4)} AS avg_engagement_rate, count(*) AS video_count
FROM silver GROUP BY keyword
ORDER BY avg_engagement_rate DESC NULLS LAST, keyword ASC NULLS LAST LIMIT 10"""))
def q_keyword_engagement_top10(spark, sf_dir):
    return rollups.top_keywords_by_engagement(silver(spark, sf_dir), 10)


@register("duration_category_counts", O.with_silver(
    'SELECT duration_category, count(*) AS "count" FROM silver GROUP BY duration_category'))
def q_duration_category_counts(spark, sf_dir):
    return rollups.duration_category_counts(silver(spark, sf_dir))


@register("distinct_keywords", O.with_silver(
    "SELECT DISTINCT keyword FROM silver"))
def q_distinct_keywords(spark, sf_dir):
    return rollups.distinct_keywords(silver(spark, sf_dir))


@register("first_keywords", O.with_silver(
    "SELECT DISTINCT keyword FROM silver ORDER BY keyword ASC NULLS LAST LIMIT 5"))
def q_first_keywords(spark, sf_dir):
    """The limit bites on the fixture's 12 clean keywords."""
    return rollups.distinct_keywords(silver(spark, sf_dir), 5)


# Gold read parameters used by the registered filter queries.
FILTER_MIN_VIEWS = 100
FILTER_EXACT = "Economy, STANDARD’s cut ,, small"
FILTER_CONTAINS = "cut,LARGE"
FILTER_OUT = ("video_id", "keyword", "view_count")


@register("keyword_filter_exact", O.with_silver(f"""
SELECT video_id, keyword, view_count FROM silver
WHERE keyword IN ('economy', 'standard''s cut', 'small') AND view_count >= {FILTER_MIN_VIEWS}"""))
def q_keyword_filter_exact(spark, sf_dir):
    return filters.read_gold_input(partitioned_silver(spark, sf_dir, FILTER_OUT), FILTER_MIN_VIEWS, FILTER_EXACT, "exact") \
                  .select(*FILTER_OUT)


@register("keyword_filter_contains", O.with_silver(f"""
SELECT video_id, keyword, view_count FROM silver
WHERE (contains(keyword, 'cut') OR contains(keyword, 'large')) AND view_count >= {FILTER_MIN_VIEWS}"""))
def q_keyword_filter_contains(spark, sf_dir):
    return filters.read_gold_input(partitioned_silver(spark, sf_dir, FILTER_OUT), FILTER_MIN_VIEWS, FILTER_CONTAINS, "contains") \
                  .select(*FILTER_OUT)


# ---- statistics ----------------------------------------------------------------

FLAGGED_SQL = """
bounds AS (SELECT quantile_disc(view_count, 0.25) AS q1, quantile_disc(view_count, 0.75) AS q3 FROM silver),
flagged AS (
  SELECT s.*, CASE WHEN b.q1 IS NULL OR b.q3 IS NULL THEN false
                   ELSE (s.view_count < b.q1 - 1.5 * (b.q3 - b.q1) OR s.view_count > b.q3 + 1.5 * (b.q3 - b.q1))
              END AS is_outlier_views
  FROM silver s CROSS JOIN bounds b)
"""


def with_flagged(body: str, ctes: tuple[str, ...] = (), order: str = O.DEDUP_ORDER_SQL) -> str:
    return O.with_silver(body, order, (FLAGGED_SQL,) + tuple(ctes))


def silver_table(spark, sf_dir, columns):
    """Silver written once, for queries that read it several times (as the
    gold stage reads the silver table): every row, and of the columns those
    that the query reads, so that no others are shuffled and written for it."""
    return materialize(silver(spark, sf_dir).select(*columns), "silver")


#: What the keyword x category summary reads.
SUMMARY_IN = ("keyword", "category_name", "view_count", "engagement_rate", "duration_seconds", "performance_tier")


def flagged(spark, sf_dir, columns=SUMMARY_IN):
    return stats.flag_outliers(silver_table(spark, sf_dir, columns))


@register("views_quartiles", O.with_silver("""
SELECT q1, q3, CAST(q1 - 1.5 * (q3 - q1) AS DOUBLE) AS lower_bound, CAST(q3 + 1.5 * (q3 - q1) AS DOUBLE) AS upper_bound
FROM (SELECT quantile_disc(view_count, 0.25) AS q1, quantile_disc(view_count, 0.75) AS q3 FROM silver)"""))
def q_views_quartiles(spark, sf_dir):
    return stats.iqr_bounds(silver_table(spark, sf_dir, ["view_count"]))


@register("outlier_flags", with_flagged(
    "SELECT video_id, keyword, view_count, is_outlier_views FROM flagged"))
def q_outlier_flags(spark, sf_dir):
    return flagged(spark, sf_dir, FILTER_OUT).select(*FILTER_OUT, "is_outlier_views")


@register("outlier_rate", with_flagged(f"""
SELECT outlier_count, total_count,
       CASE WHEN total_count > 0 THEN {O.rnd('outlier_count / total_count * 100', 2)} ELSE 0.0 END AS outlier_pct
FROM (SELECT count(*) FILTER (WHERE is_outlier_views) AS outlier_count, count(*) AS total_count FROM flagged)"""))
def q_outlier_rate(spark, sf_dir):
    return stats.outlier_rate(flagged(spark, sf_dir, ["view_count"]))


@register("outlier_top10", with_flagged("""
SELECT video_id, keyword, view_count, like_count, comment_count FROM flagged WHERE is_outlier_views
ORDER BY view_count DESC, video_id ASC LIMIT 10"""))
def q_outlier_top10(spark, sf_dir):
    return stats.top_outliers(flagged(spark, sf_dir, (*FILTER_OUT, "like_count", "comment_count")), 10)


def _corr_sql(x, y):
    return O.rnd(f"CASE WHEN stddev_pop({x}) * stddev_pop({y}) = 0 THEN NULL "
                 f"ELSE covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END", 6)


@register("metric_correlations", O.with_silver(f"""
SELECT {_corr_sql('view_count', 'engagement_rate')} AS corr_views_engagement,
       {_corr_sql('like_count', 'comment_count')} AS corr_likes_comments,
       {_corr_sql('duration_seconds', 'view_count')} AS corr_duration_views,
       {O.rnd('covar_samp(view_count, like_count)', 2)} AS cov_views_likes
FROM silver"""))
def q_metric_correlations(spark, sf_dir):
    return stats.metric_correlations(silver(spark, sf_dir))


_METRICS_UNION = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM silver" for m in stats.SUMMARY_METRICS)


@register("metric_summary", O.with_silver(f"""
SELECT metric, count(value) AS "count", {O.ravg('value', 6)} AS mean,
       {O.rnd('stddev_samp(value)', 6)} AS stddev, min(value) AS "min",
       quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS p50,
       quantile_disc(value, 0.75) AS p75, max(value) AS "max"
FROM long GROUP BY metric""", ctes=(f"long AS ({_METRICS_UNION})",)))
def q_metric_summary(spark, sf_dir):
    return stats.metric_summary(silver_table(spark, sf_dir, stats.SUMMARY_METRICS))


# ---- live path -----------------------------------------------------------------

PRIMARY_KEYWORD = "STANDARD"

LIVE_FEATURES_SQL = f"""
raw AS (
  SELECT video_id, keyword AS search_keyword, 'General' AS keyword_type, title, channel AS channel_title,
         published_at, view_count AS views, like_count AS likes, comment_count AS comments,
         duration_seconds, category_id, platform AS default_audio_language, tags,
         category_name AS topic_categories
  FROM videos WHERE video_id IS NOT NULL),
feat0 AS (
  SELECT *, greatest(1, COALESCE(date_diff('day', CAST(TRY_CAST(published_at AS TIMESTAMP) AS DATE),
                                          DATE '{AS_OF}'), 1)) AS days_since_published
  FROM raw),
feat AS (
  SELECT *, {O.rnd('views / days_since_published', 2)} AS daily_view_velocity,
         CASE WHEN views > 0 THEN {O.rnd('(likes + comments) / views * 100', 2)} ELSE 0.0 END AS "engagement_rate_%",
         CASE WHEN comments > 0 THEN {O.rnd('likes / comments', 2)} ELSE CAST(likes AS DOUBLE) END
              AS like_to_comment_ratio,
         CASE WHEN duration_seconds <= 60 THEN 'Shorts' ELSE 'Long-Form' END AS format,
         CAST(length(title) AS INTEGER) AS title_char_length,
         CASE WHEN tags IS NOT NULL AND tags <> '' THEN CAST(len(string_split(tags, '|')) AS INTEGER) ELSE 0 END
              AS tag_count
  FROM feat0)"""

LIVE_FEATURE_OUT = ["video_id", "search_keyword", "views", "days_since_published", "daily_view_velocity",
                    "engagement_rate_%", "like_to_comment_ratio", "format", "title_char_length", "tag_count"]


def live_frame(spark, sf_dir):
    raw = live.raw_output(fixtures.video_messages(spark, sf_dir).filter(F.col("video_id").isNotNull()))
    return live.live_features(raw, AS_OF)


def _q(cols):
    return ", ".join(f'"{c}"' for c in cols)


@register("live_features", O.with_videos(f", {LIVE_FEATURES_SQL}\nSELECT {_q(LIVE_FEATURE_OUT)} FROM feat"))
def q_live_features(spark, sf_dir):
    return live_frame(spark, sf_dir).select(*LIVE_FEATURE_OUT)


WINDOWS_SQL = f"""{LIVE_FEATURES_SQL},
win0 AS (
  SELECT *, CAST(sum(views) OVER (PARTITION BY search_keyword) AS BIGINT) AS total_kw_views,
         rank() OVER (PARTITION BY search_keyword ORDER BY views DESC NULLS LAST) AS rank_in_keyword,
         avg(daily_view_velocity) OVER (PARTITION BY search_keyword) AS avg_kw_velocity,
         stddev_samp(daily_view_velocity) OVER (PARTITION BY search_keyword) AS std_kw_velocity
  FROM feat),
win AS (
  SELECT *, CASE WHEN total_kw_views > 0 THEN {O.rnd('views / total_kw_views * 100', 2)} ELSE 0.0 END
              AS "view_share_%_in_keyword",
         CASE WHEN std_kw_velocity IS NOT NULL AND std_kw_velocity > 0
              THEN {O.rnd('(daily_view_velocity - avg_kw_velocity) / std_kw_velocity', 2)} ELSE 0.0 END
              AS velocity_z_score
  FROM win0),
staged AS (
  SELECT *, CASE WHEN velocity_z_score > 1.0 AND "engagement_rate_%" > 3.0 THEN 'Viral Trend'
                 WHEN velocity_z_score <= 1.0 AND "engagement_rate_%" > 3.0 THEN 'Emerging Niche'
                 WHEN velocity_z_score > 1.0 AND "engagement_rate_%" <= 3.0 THEN 'Mass Peak'
                 ELSE 'Declining / Baseline' END AS trend_lifecycle_stage
  FROM win)"""

WINDOW_OUT = ["video_id", "search_keyword", "views", "total_kw_views", "view_share_%_in_keyword",
              "rank_in_keyword", "velocity_z_score"]


def live_table(spark, sf_dir, columns=None):
    """The live rows written once, for the windows, which read them several times. Every row of them; of
    their columns those that the query reads (all unless given)."""
    rows = live_frame(spark, sf_dir)
    return materialize(rows.select(*columns) if columns else rows, "live-rows")


WINDOW_IN = ["video_id", "search_keyword", "views", "daily_view_velocity"]


@register("keyword_windows", O.with_videos(f""", {WINDOWS_SQL}
SELECT {_q(WINDOW_OUT)}, {O.rnd('avg_kw_velocity', 4)} AS avg_kw_velocity,
       {O.rnd('std_kw_velocity', 4)} AS std_kw_velocity FROM staged"""))
def q_keyword_windows(spark, sf_dir):
    w = windows.keyword_windows(live_table(spark, sf_dir, WINDOW_IN))
    return w.select(*WINDOW_OUT, *[F.round(c, 4).alias(c) for c in ("avg_kw_velocity", "std_kw_velocity")])


@register("trend_lifecycle", O.with_videos(f""", {WINDOWS_SQL}
SELECT search_keyword, trend_lifecycle_stage, count(*) AS videos FROM staged
GROUP BY search_keyword, trend_lifecycle_stage"""))
def q_trend_lifecycle(spark, sf_dir):
    a = windows.with_lifecycle(windows.keyword_windows(live_table(spark, sf_dir, [*WINDOW_IN[1:], "engagement_rate_%"])))
    return a.groupBy("search_keyword", "trend_lifecycle_stage").agg(F.count(F.lit(1)).alias("videos"))


@register("live_analytics", O.with_videos(f""", {WINDOWS_SQL}
SELECT {_q(schemas.LIVE_ANALYTICS_COLUMNS)} FROM staged"""))
def q_live_analytics(spark, sf_dir):
    return live.live_analytics(live_table(spark, sf_dir))


@register("keyword_popularity", O.with_videos(f""", {LIVE_FEATURES_SQL}
SELECT search_keyword, CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
       CAST(sum(comments) AS BIGINT) AS total_comments,
       {O.ravg('daily_view_velocity', 2)} AS avg_daily_view_velocity,
       {O.ravg('"engagement_rate_%"', 2)} AS "avg_engagement_rate_%",
       {O.ravg('duration_seconds', 0)} AS avg_duration_seconds,
       CASE WHEN search_keyword = '{PRIMARY_KEYWORD}' THEN 'Primary' ELSE 'General' END AS keyword_type
FROM feat GROUP BY search_keyword"""))
def q_keyword_popularity(spark, sf_dir):
    return rollups.keyword_popularity(live_frame(spark, sf_dir), PRIMARY_KEYWORD)


ORACLE["keyword_category_summary"] = with_flagged(f"""
SELECT keyword, category_name, count(*) AS total_videos, CAST(sum(view_count) AS BIGINT) AS total_views,
       {O.ravg('view_count', 2)} AS avg_views,
       {O.ravg('engagement_rate', 6)} AS avg_engagement_rate,
       {O.ravg('duration_seconds', 1)} AS avg_duration_sec,
       count(*) FILTER (WHERE performance_tier = 'Viral') AS viral_video_count,
       count(*) FILTER (WHERE is_outlier_views) AS outlier_video_count
FROM flagged GROUP BY keyword, category_name""")


from vidlens.plans import queries_io  # noqa: E402,F401  (registers the storage queries)
from vidlens.plans import queries_stream  # noqa: E402,F401  (registers quality and streaming queries)
from vidlens.plans import queries_harvest  # noqa: E402,F401  (registers the producer-side queries)
from vidlens.plans import queries_runs  # noqa: E402,F401  (registers the queries over several runs)
