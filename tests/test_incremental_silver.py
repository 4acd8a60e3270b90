"""Silver by increments (L2, D1) equals a full refresh and leaves old bronze unread."""

import os

import pytest

from vidlens import schemas
from vidlens.operators import clean
from vidlens.plans import medallion
from vidlens.sinks import versioned

CLOCK = {"etl_date": "2002-01-01", "processed_at": "2002-01-01 00:00:00"}


def video(video_id, keyword, views, title="t", published="2001-05-05"):
    values = {"video_id": video_id, "title": title, "channel": "c", "published_at": published, "keyword": keyword, "view_count": views,
              "like_count": 1, "comment_count": 1, "duration_seconds": 5, "has_captions": "yes", "licensed_content": "no"}
    return tuple(values.get(f.name) for f in schemas.CSV_SCHEMA.fields)


RUNS = [
    [video("a", "AI", 10), video("b", "ai ", 20), video("c", "ml", 30), video("d", "ml", 40), video("", "ml", 1), video(None, "ai", 1),
     video("e", "alone", 5), video("x", None, 5)],
    # a moves, b changes, e leaves its keyword empty, a repeated id, a row that is dropped takes c away
    [video("a", "ml", 11), video("b", "ai", 21), video("e", "ai", 6), video("f", "new", 7), video("f", "new", 9, title="z"), video("c", "ml", -1)],
    [video("c", "AI", 33), video("g", "", 8), video("x", "ai", 6), video("a", "ml", 12, published="bad")],
]


def silver_rows(spark, layout):
    return sorted(map(tuple, versioned.read(spark, layout.silver, medallion.SILVER_SCHEMA).drop("_source_file").collect()), key=repr)


def land(spark, tmp_dir, layout, i, rows, at):
    path = os.path.join(tmp_dir, f"in{i}")
    spark.createDataFrame(rows, schemas.CSV_SCHEMA).write.mode("overwrite").option("header", "true").csv(path)
    from vidlens.sinks import tables
    medallion.land_run(tables.read_video_csv(spark, path), layout, f"r{i}", at)


def test_three_runs_equal_a_full_refresh(spark, tmp_dir):
    layout, whole = medallion.Layout(f"{tmp_dir}/step"), medallion.Layout(f"{tmp_dir}/whole")
    for i, rows in enumerate(RUNS):
        land(spark, tmp_dir, layout, i, rows, f"2002-01-0{i + 1} 00:00:00")
        medallion.merge_silver(spark, layout, f"r{i}", **CLOCK)
        medallion.silver(spark, medallion.bronze_all(spark, layout), whole, **CLOCK)
        assert silver_rows(spark, layout) == silver_rows(spark, whole)
    # The last one again, and an older one: both refresh in full.
    for i, at in ((2, "2002-01-03 00:00:00"), (3, "2001-12-31 00:00:00")):
        land(spark, tmp_dir, layout, i, RUNS[1] if i == 3 else RUNS[i], at)
        medallion.merge_silver(spark, layout, f"r{i}", **CLOCK)
        medallion.silver(spark, medallion.bronze_all(spark, layout), whole, **CLOCK)
        assert silver_rows(spark, layout) == silver_rows(spark, whole)


def test_old_bronze_and_untouched_keywords_are_left_alone(spark, tmp_dir, monkeypatch):
    layout = medallion.Layout(f"{tmp_dir}/t")
    for i in (0, 1):
        land(spark, tmp_dir, layout, i, RUNS[i], f"2002-01-0{i + 1} 00:00:00")
        medallion.merge_silver(spark, layout, f"r{i}", **CLOCK)
    before = versioned.current(spark, layout.silver)
    land(spark, tmp_dir, layout, 2, [video("h", "new", 3)], "2002-01-03 00:00:00")
    # Bronze of the earlier runs cannot be read any more, and need not be.
    monkeypatch.setattr(medallion, "bronze_all", lambda *a: pytest.fail("read all of bronze"))
    for run in ("r0", "r1"):
        versioned.remove(spark, os.path.join(layout.bronze, f"run={run}"))
    out = medallion.merge_silver(spark, layout, "r2", **CLOCK)
    assert out.count() == 7
    after = versioned.current(spark, layout.silver)
    assert {p for p in after.parts if after.parts[p] != before.parts.get(p)} == {"keyword=new"}


def test_an_empty_run_changes_nothing(spark, tmp_dir):
    layout = medallion.Layout(f"{tmp_dir}/t")
    land(spark, tmp_dir, layout, 0, RUNS[0], "2002-01-01 00:00:00")
    medallion.merge_silver(spark, layout, "r0", **CLOCK)
    was = silver_rows(spark, layout)
    land(spark, tmp_dir, layout, 1, [], "2002-01-02 00:00:00")
    medallion.merge_silver(spark, layout, "r1", **CLOCK)
    assert silver_rows(spark, layout) == was and clean.DEFAULT_DEDUP_ORDER[0] == ("_ingested_at", False)
