"""Declared schemas of every layer. Names and types are fixed values that must
equal the reference's for the tables to line up."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# The 19-column raw video CSV, in file order.
CSV_SCHEMA = _s(
    ("video_id", StringType()),
    ("title", StringType()),
    ("channel", StringType()),
    ("published_at", StringType()),
    ("keyword", StringType()),
    ("platform", StringType()),
    ("view_count", LongType()),
    ("like_count", LongType()),
    ("comment_count", LongType()),
    ("description", StringType()),
    ("duration_seconds", IntegerType()),
    ("duration_category", StringType()),
    ("category_id", StringType()),
    ("category_name", StringType()),
    ("tags", StringType()),
    ("tag_count", IntegerType()),
    ("has_captions", StringType()),
    ("definition", StringType()),
    ("licensed_content", StringType()),
)

# Bronze = CSV + audit columns.
BRONZE_SCHEMA = StructType(CSV_SCHEMA.fields + _s(
    ("_ingested_at", TimestampType()),
    ("_source_file", StringType()),
).fields)

# The 24-field live message, in producer order.
MESSAGE_SCHEMA = _s(
    ("video_id", StringType()),
    ("keyword", StringType()),
    ("keyword_type", StringType()),
    ("title", StringType()),
    ("channelTitle", StringType()),
    ("description", StringType()),
    ("publishedAt", StringType()),
    ("viewCount", LongType()),
    ("likeCount", LongType()),
    ("commentCount", LongType()),
    ("duration_seconds", IntegerType()),
    ("dimension", StringType()),
    ("definition", StringType()),
    ("caption", StringType()),
    ("licensedContent", BooleanType()),
    ("projection", StringType()),
    ("categoryId", StringType()),
    ("tags", StringType()),
    ("defaultAudioLanguage", StringType()),
    ("uploadStatus", StringType()),
    ("privacyStatus", StringType()),
    ("madeForKids", BooleanType()),
    ("embeddable", BooleanType()),
    ("topicCategories", StringType()),
)
MESSAGE_FIELDS = [f.name for f in MESSAGE_SCHEMA.fields]

# Gold keyword x category summary.
SUMMARY_SCHEMA = _s(
    ("keyword", StringType()),
    ("category_name", StringType()),
    ("total_videos", LongType()),
    ("total_views", LongType()),
    ("avg_views", DoubleType()),
    ("avg_engagement_rate", DoubleType()),
    ("avg_duration_sec", DoubleType()),
    ("viral_video_count", LongType()),
    ("outlier_video_count", LongType()),
)

HISTORY_SCHEMA = StructType(SUMMARY_SCHEMA.fields + _s(
    ("run_timestamp", TimestampType()),
    ("run_date", StringType()),
).fields)

# Nested API responses (one JSON document per page).
SEARCH_RESPONSE_SCHEMA = StructType([
    StructField("items", ArrayType(StructType([
        StructField("id", _s(("videoId", StringType()))),
        StructField("snippet", _s(
            ("title", StringType()),
            ("channelTitle", StringType()),
            ("description", StringType()),
            ("publishedAt", StringType()),
        )),
    ]))),
    StructField("nextPageToken", StringType()),
])

# Counts arrive as text in the API; they are decoded with a safe cast.
DETAILS_RESPONSE_SCHEMA = StructType([
    StructField("items", ArrayType(StructType([
        StructField("id", StringType()),
        StructField("statistics", _s(
            ("viewCount", StringType()),
            ("likeCount", StringType()),
            ("commentCount", StringType()),
        )),
        StructField("contentDetails", _s(
            ("duration", StringType()),
            ("dimension", StringType()),
            ("definition", StringType()),
            ("caption", StringType()),
            ("licensedContent", BooleanType()),
            ("projection", StringType()),
        )),
        StructField("snippet", _s(
            ("categoryId", StringType()),
            ("defaultAudioLanguage", StringType()),
            ("tags", ArrayType(StringType())),
        )),
        StructField("status", _s(
            ("uploadStatus", StringType()),
            ("privacyStatus", StringType()),
            ("madeForKids", BooleanType()),
            ("embeddable", BooleanType()),
        )),
        StructField("topicDetails", _s(
            ("topicCategories", ArrayType(StringType())),
        )),
    ]))),
])

# Column lists of the three live outputs, in output order.
LIVE_RAW_COLUMNS = [
    "video_id", "search_keyword", "keyword_type", "title", "channel_title",
    "published_at", "views", "likes", "comments", "duration_seconds",
    "category_id", "default_audio_language", "tags", "topic_categories",
]
LIVE_SUMMARY_COLUMNS = [
    "search_keyword", "total_views", "total_likes", "total_comments",
    "avg_daily_view_velocity", "avg_engagement_rate_%", "avg_duration_seconds",
    "keyword_type",
]
LIVE_ANALYTICS_COLUMNS = [
    "video_id", "search_keyword", "keyword_type", "rank_in_keyword", "title",
    "channel_title", "published_at", "days_since_published", "views", "likes",
    "comments", "duration_seconds", "format", "daily_view_velocity",
    "velocity_z_score", "engagement_rate_%", "like_to_comment_ratio",
    "view_share_%_in_keyword", "trend_lifecycle_stage", "title_char_length",
    "tag_count", "default_audio_language", "tags", "topic_categories",
]

# The live tables as written, so that reading back never infers partition values.
_LIVE_COUNTS = {"total_views", "total_likes", "total_comments", "rank_in_keyword", "views", "likes", "comments"}
_LIVE_INTS = {"days_since_published", "duration_seconds", "title_char_length", "tag_count"}
_LIVE_DOUBLES = {"avg_daily_view_velocity", "avg_engagement_rate_%", "avg_duration_seconds", "daily_view_velocity",
                 "velocity_z_score", "engagement_rate_%", "like_to_comment_ratio", "view_share_%_in_keyword"}


def _live_type(column):
    if column in _LIVE_COUNTS:
        return LongType()
    if column in _LIVE_INTS:
        return IntegerType()
    return DoubleType() if column in _LIVE_DOUBLES else StringType()


LIVE_SUMMARY_SCHEMA = _s(*[(c, _live_type(c)) for c in LIVE_SUMMARY_COLUMNS])
LIVE_ANALYTICS_SCHEMA = _s(*[(c, _live_type(c)) for c in LIVE_ANALYTICS_COLUMNS])
