"""Run-time guards, the gold stage's refresh modes, and plan shapes that the
scale design depends on."""

import os
import re

import pytest
from pyspark.sql import functions as F

from vidlens import schemas
from vidlens.operators import clean, filters, ordered, quality, stats, windows
from vidlens.plans import medallion
from vidlens.session import apply_plan_defaults
from vidlens.sinks import tables
from vidlens.streaming import live as stream


def test_zero_match_guard_names_existing_keywords(spark):
    df = spark.createDataFrame([("ai", 5), ("ml", 7)], "keyword string, view_count long")
    assert filters.read_gold_input(df, 0, "AI").count() == 1
    with pytest.raises(filters.NoKeywordMatch, match="ai"):
        filters.read_gold_input(df, 0, "nothing here")
    # no keyword filter: an empty result is allowed
    assert filters.read_gold_input(df, 100).count() == 0


def test_contains_mode_and_bad_mode(spark):
    df = spark.createDataFrame([("data engineering",), ("ml",)], "keyword string").withColumn("view_count", F.lit(1))
    assert filters.read_gold_input(df, 0, "engineer", "contains").count() == 1
    with pytest.raises(ValueError):
        filters.keyword_filter(df, "x", "fuzzy")


def test_enforce_refuses_bad_batch(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v long")
    checks = {"v_non_negative": F.col("v") >= 0}
    report = {r.constraint: (r.violations, r.checked) for r in quality.constraint_report(df, checks).collect()}
    assert report == {"v_non_negative": (1, 3)}          # NULL passes, as in SQL CHECK
    with pytest.raises(ValueError, match="v_non_negative=1"):
        quality.enforce(df, checks)
    assert quality.enforce(df.filter("v >= 0"), checks).count() == 1


def test_approx_quartiles_within_error(spark):
    df = spark.range(0, 10000).select(F.col("id").alias("view_count"))
    r = stats.quartiles(df, exact=False, relative_error=0.01).first()
    assert abs(r.q1 - 2500) <= 100 and abs(r.q3 - 7500) <= 100
    e = stats.quartiles(df).first()
    assert (e.q1, e.q3) == (2499, 7499)


def _silver_rows(spark, rows):
    df = spark.createDataFrame(rows, "keyword string, category_name string, view_count long")
    df = (df.withColumn("engagement_rate", F.lit(0.5)).withColumn("duration_seconds", F.lit(10))
            .withColumn("performance_tier", F.lit("Low")).withColumn("video_id", F.lit("x")))
    return tables.align(df, medallion.SILVER_SCHEMA)


def test_gold_scoped_vs_full_refresh(spark, tmp_dir):
    layout = medallion.Layout(tmp_dir)
    tables.overwrite(_silver_rows(spark, [("a", "c", 10), ("b", "c", 20)]), layout.silver)
    medallion.gold(spark, layout, "2002-01-01", export=False)
    # keyword b vanishes above min_views: a scoped run keeps its old summary row
    medallion.gold(spark, layout, "2002-01-02", min_views=15, export=False)
    kws = sorted(r.keyword for r in tables.read_table(spark, layout.summary, schemas.SUMMARY_SCHEMA).collect())
    assert kws == ["a", "b"]
    medallion.gold(spark, layout, "2002-01-03", min_views=15, full_refresh=True)
    kws = sorted(r.keyword for r in tables.read_table(spark, layout.summary, schemas.SUMMARY_SCHEMA).collect())
    assert kws == ["b"]
    runs = sorted(r.run_date for r in tables.read_table(spark, layout.history, schemas.HISTORY_SCHEMA)
                  .select("run_date").distinct().collect())
    assert runs == ["2002-01-01", "2002-01-02", "2002-01-03"]
    assert len([f for f in os.listdir(layout.export) if f.endswith(".csv")]) == 1


def test_run_for_stops_processing_time_queries(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    spark.createDataFrame([('{"video_id": "v1", "keyword": "k", "viewCount": 5}',)], "value string") \
        .write.text(src)
    layout = stream.LiveLayout(f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    qs = stream.start_live(stream.file_source(spark, src), layout, "k", trigger="1 second", as_of="2002-01-01")
    stream.run_for(qs, seconds=6, poll=1)
    assert all(not q.isActive for q in qs)
    assert spark.read.parquet(layout.summary).first().total_views == 5


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_dedup_combines_before_shuffle(spark):
    apply_plan_defaults(spark)
    df = spark.range(0, 1000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("t"))
    plan = _plan(clean.dedup(df, "k", (("t", False),)))
    # printed top-down: the partial limit (one row per key) sits below the shuffle
    assert re.search(r"WindowGroupLimit \[k#\d+\].*row_number\(\), 1, Partial", plan)
    assert plan.index(", 1, Partial") > plan.index("Exchange hashpartitioning(k")


def test_plan_cap_limits_before_shuffle(spark):
    apply_plan_defaults(spark)
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("o"))
    plan = _plan(clean.cap_per_group(df, "g", (("o", True),), 5))
    assert plan.count("WindowGroupLimit") == 2      # partial (map side) and final


def test_plan_bucket_window_is_not_keyed_by_keyword_alone(spark):
    apply_plan_defaults(spark)
    df = spark.range(0, 1000).select((F.col("id") % 3).cast("string").alias("search_keyword"),
                                     (F.col("id") % 50).alias("views"),
                                     F.lit(1.0).alias("daily_view_velocity"))
    plan = _plan(windows.keyword_windows(df))
    # the in-bucket window is fed by a shuffle on (keyword group, bucket)
    assert re.search(r"hashpartitioning\(_gk#\d+, _b#\d+", plan)


def test_keyword_terms_keep_commas_of_lists_and_refuse_blanks():
    assert filters.keyword_terms(["Rock, Paper", " "]) == ["rock, paper"]
    assert filters.keyword_terms("a, b") == ["a", "b"] and filters.keyword_terms(None) == []
    for blank in (" , ", [" "]):
        with pytest.raises(ValueError):
            filters.keyword_terms(blank)


def test_keyword_filter_prunes_partitions_and_pushes_views(spark):
    from vidlens.plans import registry
    table = registry.partitioned_silver(spark, "/root/testdata/sf0.001")
    plan = filters.read_gold_input(table, 100, "economy")._jdf.queryExecution().executedPlan().toString()
    part = plan[plan.index("PartitionFilters"):]
    assert "economy" in part[:part.index("PushedFilters")] and "GreaterThanOrEqual(view_count,100)" in part


def test_metric_summary_counts_before_it_shuffles(spark):
    df = spark.range(500).select(*[(F.col("id") * i).cast("double").alias(m) for i, m in enumerate(stats.SUMMARY_METRICS)])
    plan = stats.metric_summary(df)._jdf.queryExecution().sparkPlan().toString()
    lines = [x.strip(" :+-*") for x in plan.splitlines()]
    assert not any(a.startswith("Exchange") and b.startswith("Generate") for a, b in zip(lines, lines[1:]))


def test_zero_error_quantiles_are_exact_beyond_any_sketch(spark):
    df = spark.range(0, 1_200_000).select((F.col("id") * 7919 % 1_200_007).alias("view_count"))
    e, a = stats.quartiles(df).first(), stats.quartiles(df, exact=False, relative_error=0).first()
    assert (e.q1, e.q3) == (a.q1, a.q3)


def test_bucket_count_grows_with_the_data_and_changes_no_result(spark, monkeypatch):
    df = spark.range(0, 6000).select((F.col("id") * 7919 % 3001).alias("v"))
    few = ordered.bucket_count(df, "v")
    expected = {(r.v, r["_before"]) for r in ordered.value_positions(df, "v").collect()}
    monkeypatch.setattr(ordered, "VALUES_PER_BUCKET", 8)
    many = ordered.bucket_count(df, "v")
    assert few == ordered.DEFAULT_BUCKETS and many > ordered.UNROLLED_SPLITS
    assert {(r.v, r["_before"]) for r in ordered.value_positions(df, "v").collect()} == expected


def test_deviation_of_huge_velocities_and_of_equal_ones(spark):
    rows = [("hot", 1, 4e16), ("hot", 2, 4e16), ("hot", 3, 7e16), ("even", 1, 0.1), ("even", 1, 0.1), ("even", 2, 0.1)]
    df = spark.createDataFrame(rows, "search_keyword string, views long, daily_view_velocity double")
    out = {(r.search_keyword, r.views): r for r in windows.keyword_windows(df).collect()}
    assert out["hot", 1].std_kw_velocity == pytest.approx(3e16 / 3 ** 0.5)
    assert out["even", 1].std_kw_velocity == 0.0 and out["even", 2].velocity_z_score == 0.0
