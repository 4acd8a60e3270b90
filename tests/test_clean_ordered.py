"""De-duplication, caps, rank positions and exact quantiles against brute force."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import Window

from vidlens.operators import clean, ordered, stats, windows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-5, 5)),
              st.integers(0, 3)),
    min_size=0, max_size=40)


@SETTINGS
@given(rows_strategy)
def test_value_positions_equal_rank(spark, rows):
    df = spark.createDataFrame(rows, "k string, v long, x int")
    pos = ordered.value_positions(df, "v", ["k"], descending=True, buckets=4)
    got = {(r["k"], r["v"]): (r["_before"] + 1, r["_n"]) for r in pos.collect()}
    for k, v, _ in rows:
        same = [r for r in rows if r[0] == k]
        if v is None:
            expect = sum(1 for r in same if r[1] is not None) + 1
        else:
            expect = sum(1 for r in same if r[1] is not None and r[1] > v) + 1
        assert got[(k, v)][0] == expect
        assert got[(k, v)][1] == sum(1 for r in same if r[1] == v)


@SETTINGS
@given(st.lists(st.integers(-1000, 1000), min_size=0, max_size=60))
def test_exact_quantiles_match_percentile_disc(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = ordered.exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["a", "b", "c"], buckets=3).collect()
    assert len(got) == 1
    s = sorted(values)
    for p, name in zip([0.25, 0.5, 0.75], "abc"):
        expect = s[max(1, math.ceil(p * len(s))) - 1] if s else None
        assert got[0][name] == expect


def test_quantiles_agree_with_spark_percentile_disc(spark):
    df = spark.range(0, 997).select(((F.col("id") * 7919) % 1000).alias("v"))
    mine = ordered.exact_quantiles(df, "v", [0.25, 0.75], ["q1", "q3"]).first()
    ref = df.selectExpr("percentile_disc(0.25) WITHIN GROUP (ORDER BY v) AS q1",
                        "percentile_disc(0.75) WITHIN GROUP (ORDER BY v) AS q3").first()
    assert (mine.q1, mine.q3) == (ref.q1, ref.q3)


def test_hot_key_rank_matches_window(spark):
    # one keyword holds most rows, with a huge tie block
    df = (spark.range(0, 5000)
          .select(F.when(F.col("id") % 10 < 7, "hot").otherwise((F.col("id") % 10).cast("string")).alias("search_keyword"),
                  F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id") % 997).cast("long").alias("views"),
                  (F.col("id") % 13).cast("double").alias("daily_view_velocity")))
    mine = windows.keyword_windows(df, buckets=8)
    w = Window.partitionBy("search_keyword")
    ref = (df.withColumn("r", F.rank().over(w.orderBy(F.desc("views"))))
             .withColumn("t", F.sum("views").over(w)))
    a = sorted((r["search_keyword"], r["views"], r["rank_in_keyword"], r["total_kw_views"]) for r in mine.collect())
    b = sorted((r["search_keyword"], r["views"], r["r"], r["t"]) for r in ref.collect())
    assert a == b


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(0, 50), st.integers(0, 3)),
                min_size=1, max_size=40))
def test_dedup_unique_and_order_independent(spark, rows):
    df = spark.createDataFrame(rows, "id string, ts long, v int")
    out = clean.dedup(df, "id", (("ts", False), ("v", True)))
    got = sorted(tuple(r) for r in out.collect())
    assert len({r[0] for r in got}) == len(got) == len({r[0] for r in rows})
    for rid in {r[0] for r in rows}:
        best = sorted([r for r in rows if r[0] == rid], key=lambda r: (-r[1], r[2]))[0]
        assert (rid, best[1], best[2]) in got
    shuffled = spark.createDataFrame(list(reversed(rows)), "id string, ts long, v int").repartition(3)
    assert sorted(tuple(r) for r in clean.dedup(shuffled, "id", (("ts", False), ("v", True))).collect()) == got


def test_dedup_nulls_sort_last_and_timestamp_desc(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "2020-01-01 00:00:00", 2), ("a", "2021-01-01 00:00:00", 3)],
                               "id string, t string, v int").withColumn("t", F.col("t").cast("timestamp"))
    assert clean.dedup(df, "id", (("t", False),)).first()["v"] == 3


def test_cap_per_group_exact(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    out = clean.cap_per_group(df, "g", (("o", True),), 7)
    got = sorted((r.g, r.o) for r in out.collect())
    assert got == sorted((g, o) for g in range(3) for o in [x for x in range(1000) if x % 3 == g][:7])


def test_clean_rules(spark):
    rows = [("v1", "Director’s Cut ", 10, None, 2, "true", " t ", None, "2020-01-01 00:00:00"),
            ("v1", "x", 99, 1, 1, "no", "t", "Cat", "2019-01-01 00:00:00"),
            (" ", "kw", 5, 1, 1, "yes", "t", "Cat", "2019-01-01 00:00:00"),
            ("v2", "kw", -3, 1, 1, "maybe", "t", "Cat", "bad"),
            ("v3", "kw", None, 1, 1, "maybe", "t", "", "bad")]
    df = spark.createDataFrame(rows, "video_id string, keyword string, view_count long, like_count long, "
                               "comment_count long, has_captions string, title string, category_name string, "
                               "published_at string")
    for c in ("channel", "tag_count", "duration_seconds", "licensed_content"):
        df = df.withColumn(c, F.lit(None).cast("int" if c in ("tag_count", "duration_seconds") else "string"))
    df = df.withColumn("_ingested_at", F.current_timestamp())
    out = {r.video_id: r for r in clean.clean_videos(df, (("published_at_ts", False),)).collect()}
    assert set(out) == {"v1", "v3"}          # blank id dropped, negative views dropped
    assert out["v1"].keyword == "director's cut" and out["v1"].view_count == 10
    assert out["v1"].like_count == 0 and out["v1"].category_name == "Unknown" and out["v1"].title == "t"
    assert out["v3"].view_count == 0 and out["v3"].has_captions is None and out["v3"].published_at_ts is None
    assert out["v3"].category_name == ""     # only NULL takes the default
    assert out["v1"].performance_tier == "Low" and out["v1"].engagement_rate == 0.2


def test_outliers_empty_and_zero_variance(spark):
    empty = spark.createDataFrame([], "video_id string, keyword string, view_count long, like_count long, "
                                      "comment_count long")
    assert stats.flag_outliers(empty).count() == 0
    assert stats.outlier_rate(stats.flag_outliers(empty)).first().outlier_pct == 0.0
    const = spark.createDataFrame([(1, 5, 2.0, 3, 0.1)] * 4, "view_count long, like_count long, "
                                  "engagement_rate double, comment_count long, duration_seconds double")
    r = stats.metric_correlations(const).first()
    assert r.corr_views_engagement is None and r.cov_views_likes == 0.0
    flagged = stats.flag_outliers(const.withColumn("video_id", F.lit("a")).withColumn("keyword", F.lit("k")))
    assert [x.is_outlier_views for x in flagged.collect()] == [False] * 4


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-20, 20))),
                min_size=0, max_size=60))
def test_grouped_exact_quantiles_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: (r.p10, r.p50, r.p90) for r in
           ordered.exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["p10", "p50", "p90"], ["g"], buckets=4).collect()}
    for g in {r[0] for r in rows}:
        vals = sorted(r[1] for r in rows if r[0] == g and r[1] is not None)
        if not vals:
            assert g not in got
            continue
        expect = tuple(vals[max(1, math.ceil(p * len(vals))) - 1] for p in (0.1, 0.5, 0.9))
        assert got[g] == expect


def test_blank_category_option(spark):
    df = spark.createDataFrame([("v1", "  ", 1)], "video_id string, category_name string, view_count long")
    for c, t in (("keyword", "string"), ("published_at", "string"), ("has_captions", "string"),
                 ("licensed_content", "string"), ("title", "string"), ("channel", "string"),
                 ("like_count", "long"), ("comment_count", "long"), ("tag_count", "int"),
                 ("duration_seconds", "int")):
        df = df.withColumn(c, F.lit(None).cast(t))
    df = df.withColumn("_ingested_at", F.current_timestamp())
    assert clean.clean_videos(df).first().category_name == "  "
    assert clean.clean_videos(df, blank_category_as_null=True).first().category_name == "Unknown"
