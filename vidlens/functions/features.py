"""Derived business columns as Spark column expressions (JVM-side, codegen'd).

The batch and live pipelines use different scales and null rules for
engagement and like/comment ratio on purpose; both are kept, named apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Performance tier thresholds (views) and labels.
TIER_THRESHOLDS = ((1_000_000, "Viral"), (100_000, "High"), (10_000, "Medium"))
TIER_DEFAULT = "Low"
# Live thresholds.
SHORTS_MAX_SECONDS = 60
LIFECYCLE_Z = 1.0
LIFECYCLE_ENGAGEMENT_PCT = 3.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- batch (silver) -------------------------------------------------------

def engagement_rate(views="view_count", likes="like_count", comments="comment_count") -> Column:
    """F1: (likes+comments)/views rounded to 6 dp; 0.0 when views <= 0."""
    v, l, c = _c(views), _c(likes), _c(comments)
    return F.when(v > 0, F.round((l + c) / v, 6)).otherwise(F.lit(0.0))


def like_to_comment_ratio(likes="like_count", comments="comment_count") -> Column:
    """likes/comments to 2 dp; NULL when there are no comments."""
    return F.round(F.try_divide(_c(likes), _c(comments)), 2)


def performance_tier(views="view_count", thresholds=TIER_THRESHOLDS, default=TIER_DEFAULT) -> Column:
    """first threshold the views reach, checked from the highest."""
    v = _c(views)
    expr = None
    for limit, label in thresholds:
        expr = F.when(v >= limit, label) if expr is None else expr.when(v >= limit, label)
    return expr.otherwise(default)


# ---- live -----------------------------------------------------------------

def days_since_published(published_ts="published_at_ts", as_of: Column | str | None = None) -> Column:
    """whole days from publish to ``as_of`` (default now), at least 1; NULL date -> 1."""
    ref = F.current_timestamp() if as_of is None else (F.lit(as_of) if isinstance(as_of, str) else as_of)
    return F.greatest(F.lit(1), F.datediff(ref, _c(published_ts)))


def daily_view_velocity(views="views", days="days_since_published") -> Column:
    """F6."""
    return F.round(_c(views) / _c(days), 2)


def engagement_rate_pct(views="views", likes="likes", comments="comments") -> Column:
    """percent, 2 dp, 0.0 when views <= 0 (NULL when views > 0 and a count is NULL)."""
    v = _c(views)
    return F.when(v > 0, F.round((_c(likes) + _c(comments)) / v * 100, 2)).otherwise(F.lit(0.0))


def live_like_to_comment_ratio(likes="likes", comments="comments") -> Column:
    """F8: likes/comments to 2 dp; likes itself (as double) when comments is not positive."""
    l, c = _c(likes), _c(comments)
    return F.when(c > 0, F.round(l / c, 2)).otherwise(l.cast("double"))


def video_format(duration="duration_seconds", shorts_max=SHORTS_MAX_SECONDS) -> Column:
    """Shorts up to ``shorts_max`` seconds; longer and unknown -> Long-Form."""
    return F.when(_c(duration) <= shorts_max, "Shorts").otherwise("Long-Form")


def title_char_length(title="title") -> Column:
    """length in characters (code points)."""
    return F.length(_c(title))


def tag_count(tags="tags") -> Column:
    """parts of the '|' list (empty parts count); 0 when NULL or ''."""
    t = _c(tags)
    return F.when(t.isNotNull() & (t != ""), F.size(F.split(t, r"\|"))).otherwise(F.lit(0))


def trend_lifecycle_stage(z="velocity_z_score", eng="engagement_rate_%",
                          z_cut=LIFECYCLE_Z, eng_cut=LIFECYCLE_ENGAGEMENT_PCT) -> Column:
    """velocity z-score x engagement quadrant."""
    zc, ec = _c(z), _c(eng)
    return (F.when((zc > z_cut) & (ec > eng_cut), "Viral Trend")
             .when((zc <= z_cut) & (ec > eng_cut), "Emerging Niche")
             .when((zc > z_cut) & (ec <= eng_cut), "Mass Peak")
             .otherwise("Declining / Baseline"))


def keyword_type(keyword="search_keyword", primary: str | None = None) -> Column:
    """Primary for the primary keyword, General otherwise."""
    return F.when(_c(keyword) == F.lit(primary), "Primary").otherwise("General")
