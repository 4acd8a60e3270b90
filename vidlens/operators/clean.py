"""Silver cleaning: filters, null rules, de-duplication, per-group caps.

De-duplication and caps are ``row_number()`` filters, which Spark plans with a
partial group limit before the shuffle: every map task forwards at most the
kept rows of each key, so a hot ``video_id`` holding a large share of all rows
never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlens.functions import features as feat
from vidlens.functions.casts import safe_bool, safe_timestamp
from vidlens.functions.text import normalize_keyword
from vidlens.schemas import CSV_SCHEMA

OrderSpec = Sequence[tuple[str, bool]]  # (column, ascending); NULLs always sort last

# Metrics whose NULL means "no stats" and is filled with 0.
ZERO_FILL = ("view_count", "like_count", "comment_count", "tag_count", "duration_seconds")

# Default survivor of a duplicate video id: the newest ingest, then the newest
# publish time, then every raw column -- a total order, so duplicates landed
# by one run (same ingest time) still resolve the same way every time.
DEFAULT_DEDUP_ORDER = (("_ingested_at", False), ("published_at_ts", False)) + tuple(
    (c, True) for c in CSV_SCHEMA.fieldNames() if c != "video_id")


# ---- filters ----------------------------------------------------------------

def drop_blank_ids(df: DataFrame, key: str = "video_id") -> DataFrame:
    """Drop rows whose id is NULL or blank."""
    return df.filter(F.col(key).isNotNull() & (F.trim(F.col(key)) != ""))


def drop_negative_views(df: DataFrame, col: str = "view_count") -> DataFrame:
    """P2."""
    return df.filter(F.col(col) >= 0)


def fill_zero_metrics(df: DataFrame, cols: Sequence[str] = ZERO_FILL) -> DataFrame:
    """NULL metrics -> 0, keeping each column's integral type."""
    present = [c for c in cols if c in df.columns]
    return df.fillna(0, subset=present) if present else df


# ---- de-duplication ---------------------------------------------------------

def _sort(order: OrderSpec):
    return [F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in order]


def dedup(df: DataFrame, keys: str | Sequence[str], order: OrderSpec | None = None) -> DataFrame:
    """One row per key; the first row in ``order`` wins.

    ``order=None`` keeps an arbitrary row (the reference's ``dropDuplicates``);
    a total ``order`` makes the survivor deterministic. ``row_number() = 1``
    is planned with a partial group limit of one row per key in every map
    task, below the shuffle, so duplicates are dropped map-side.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order is None:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*_sort(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def cap_per_group(df: DataFrame, group: str | Sequence[str], order: OrderSpec, cap: int) -> DataFrame:
    """D3: the first ``cap`` rows of each group in ``order`` (exact).

    ``row_number() <= cap`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each map task sends at most ``cap`` rows per group.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*_sort(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap).drop("_rn")


# ---- silver transform -------------------------------------------------------

def clean_videos(df: DataFrame, dedup_order: OrderSpec | None = DEFAULT_DEDUP_ORDER,
                 etl_date: str | None = None, processed_at: str | None = None,
                 blank_category_as_null: bool = False) -> DataFrame:
    """Bronze -> silver rows: P1, D1, safe casts, P12, keyword and text
    normalising, category default, P2, then F1-F3 and the audit columns.

    ``etl_date`` / ``processed_at`` default to the run clock; pass fixed values
    for reproducible output. The 'Unknown' category replaces NULL only (as the
    reference); ``blank_category_as_null`` also treats a blank name as missing.
    """
    if blank_category_as_null:
        df = df.withColumn("category_name", F.nullif(F.trim("category_name"), F.lit("")))
    df = df.withColumn("published_at_ts", safe_timestamp("published_at"))
    df = drop_blank_ids(df)
    if dedup_order is DEFAULT_DEDUP_ORDER:      # the default applies to the columns present
        dedup_order = tuple(o for o in dedup_order if o[0] in df.columns)
    df = dedup(df, "video_id", dedup_order)
    df = (df
          .withColumn("has_captions", safe_bool("has_captions"))
          .withColumn("licensed_content", safe_bool("licensed_content"))
          .withColumn("published_year", F.year("published_at_ts"))
          .withColumn("published_month", F.month("published_at_ts"))
          .withColumn("etl_date", F.lit(etl_date) if etl_date else F.current_date().cast("string")))
    df = fill_zero_metrics(df)
    df = (df
          .withColumn("keyword", normalize_keyword("keyword"))
          .withColumn("title", F.trim("title"))
          .withColumn("channel", F.trim("channel"))
          .withColumn("category_name", F.coalesce(F.col("category_name"), F.lit("Unknown"))))
    df = drop_negative_views(df)
    return (df
            .withColumn("engagement_rate", feat.engagement_rate())
            .withColumn("like_to_comment_ratio", feat.like_to_comment_ratio())
            .withColumn("performance_tier", feat.performance_tier())
            .withColumn("etl_processed_at",
                        F.lit(processed_at).cast("timestamp") if processed_at else F.current_timestamp()))
