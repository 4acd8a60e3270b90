"""The driver contract: entry runs, every query is registered with its twin,
and a sample of queries agree with DuckDB at the smallest scale."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from vidlens.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["keyword", "category_name", "total_videos", "total_views", "avg_views",
                          "avg_engagement_rate", "avg_duration_sec", "viral_video_count", "outlier_video_count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from vidlens.plans import registry
    assert set(registry.QUERIES) == set(registry.ORACLE) <= set(E.queries())
    assert len(E.queries()) >= 37


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if v is not None and type(v).__name__ == "Decimal":
        return repr(float(v))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["clean_videos", "keyword_category_summary", "metric_summary",
                                  "live_analytics", "per_keyword_cap", "enrich_left_join",
                                  "constraint_report", "keyword_filter_contains"])
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    theirs = Counter(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert mine == theirs


def test_registered_queries_apply_plan_settings(spark):
    spark.conf.set("spark.sql.requireAllClusterKeysForDistribution", "false")
    E.queries()["distinct_keywords"](spark, SF)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForDistribution") == "true"
