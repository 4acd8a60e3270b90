"""Thresholds and NULL rules of every derived column."""

import pytest
from pyspark.sql import functions as F

from vidlens.functions import features as feat
from vidlens.functions.casts import coerce_numeric, iso_duration_seconds, safe_bool
from vidlens.functions.text import normalize_keyword, parse_keyword_list


def one(spark, expr, schema, *rows):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expr).collect()]


def test_engagement_rate_batch(spark):
    got = one(spark, feat.engagement_rate(), "view_count long, like_count long, comment_count long",
              (1000, 10, 5), (0, 10, 5), (3, 1, 0), (-1, 1, 1))
    assert got == [0.015, 0.0, 0.333333, 0.0]


def test_like_to_comment_ratio_batch_null_without_comments(spark):
    got = one(spark, feat.like_to_comment_ratio(), "like_count long, comment_count long", (10, 3), (10, 0))
    assert got == [3.33, None]


@pytest.mark.parametrize("views,tier", [(1_000_000, "Viral"), (999_999, "High"), (100_000, "High"),
                                        (99_999, "Medium"), (10_000, "Medium"), (9_999, "Low"), (0, "Low")])
def test_performance_tier_edges(spark, views, tier):
    assert one(spark, feat.performance_tier(), "view_count long", (views,)) == [tier]


def test_days_since_published_floor_and_null(spark):
    df = spark.createDataFrame([("2001-12-31 10:00:00",), ("2002-01-05 00:00:00",), (None,), ("1999-01-01 00:00:00",)],
                               "p string").select(F.try_to_timestamp("p").alias("published_at_ts"))
    got = [r[0] for r in df.select(feat.days_since_published(as_of="2002-01-01")).collect()]
    assert got == [1, 1, 1, 1096]


def test_live_engagement_and_null_rules(spark):
    rows = [(1000, 10, 5), (0, 10, 5), (None, 1, 1), (100, None, 1)]
    got = one(spark, feat.engagement_rate_pct(), "views long, likes long, comments long", *rows)
    assert got == [1.5, 0.0, 0.0, None]


def test_live_like_to_comment_ratio(spark):
    got = one(spark, feat.live_like_to_comment_ratio(), "likes long, comments long", (10, 3), (10, 0), (7, None))
    assert got == [3.33, 10.0, 7.0]


def test_format_and_title_length_and_tags(spark):
    assert one(spark, feat.video_format(), "duration_seconds int", (60,), (61,), (None,)) == \
        ["Shorts", "Long-Form", "Long-Form"]
    assert one(spark, feat.title_char_length(), "title string", ("héllo",), (None,)) == [5, None]
    assert one(spark, feat.tag_count(), "tags string", ("a|b",), ("",), (None,), ("a||",)) == [2, 0, 0, 3]


@pytest.mark.parametrize("z,eng,stage", [(1.5, 3.5, "Viral Trend"), (1.0, 3.5, "Emerging Niche"),
                                         (1.5, 3.0, "Mass Peak"), (0.0, 1.0, "Declining / Baseline"),
                                         (None, 5.0, "Declining / Baseline")])
def test_trend_lifecycle(spark, z, eng, stage):
    got = one(spark, feat.trend_lifecycle_stage("z", "e"), "z double, e double", (z, eng))
    assert got == [stage]


def test_keyword_type(spark):
    assert one(spark, feat.keyword_type("k", "ai"), "k string", ("ai",), ("ml",), (None,)) == \
        ["Primary", "General", "General"]


def test_keyword_normaliser(spark):
    got = one(spark, normalize_keyword("k"), "k string", ("  Director’s Cut ",), ("a`b",), ("   ",), (None,))
    assert got == ["director's cut", "a'b", None, None]
    assert parse_keyword_list(" AI, ,Director’s cut,") == ["ai", "director's cut"]
    assert parse_keyword_list(None) == []


def test_safe_bool(spark):
    got = one(spark, safe_bool("b"), "b string", ("true",), ("no",), ("maybe",), ("TRUE",), ("1",), (None,))
    assert got == [True, False, None, True, True, None]


@pytest.mark.parametrize("text,seconds", [("PT1H2M3S", 3723), ("PT15M", 900), ("PT45S", 45), ("PT", 0),
                                          ("P1DT2H", 0), ("PT1.5S", 0), ("", 0), (None, 0), ("PT90M", 5400),
                                          ("xPT1S", 0)])
def test_iso_duration(spark, text, seconds):
    assert one(spark, iso_duration_seconds("d"), "d string", (text,)) == [seconds]


def test_coerce_numeric(spark):
    got = one(spark, coerce_numeric("x"), "x string", ("1.5",), ("abc",), ("inf",), ("-Infinity",), ("NaN",), ("",))
    assert got == [1.5, None, None, None, None, None]


@pytest.mark.parametrize("text,seconds", [("P1DT2H", 93600), ("P2D", 172800), ("PT1H", 3600), ("PT1.5S", 0),
                                          ("P1DT", 86400), ("", 0), (None, 0)])
def test_iso_duration_with_days(spark, text, seconds):
    assert one(spark, iso_duration_seconds("d", allow_days=True), "d string", (text,)) == [seconds]
