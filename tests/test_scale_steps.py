"""Steps that write and shuffle no more than their queries need."""

import json
import os
import re

from pyspark.sql import functions as F

from vidlens.operators import windows
from vidlens.plans import registry
from vidlens.session import apply_plan_defaults, materialize
from vidlens.sinks import tables
from vidlens.sources import fixtures, responses

queries_io = registry.queries_io

SF = "/root/testdata/sf0.001"

VIDEO = ("keyword string, video_id string, title string, channel string, description string, published_at string, "
         "view_count long, src_part long, src_supp long, duration_seconds int")


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_search_rows_are_brought_together_once(spark):
    plan = plan_of(responses.search_pages(fixtures.videos(spark, SF)))
    assert "Window" not in plan and plan.count("collect_list") <= 2


def test_search_pages_sort_each_order_with_nulls_last(spark):
    rows = [("k", f"v{i % 40:02d}" if i % 9 else None, "t", "c", None, [None, "2001-01-02", "2001-01", "bad", "é"][i % 5],
             None if i % 4 == 0 else (i * 37) % 11 - 3, i % 6 if i % 7 else None, i % 3, i) for i in range(130)]
    rows = [r for r in rows if r[7] is not None] + [(None, "lost", "t", "c", None, None, 1, 1, 1, 1)]
    pages = responses.search_pages(spark.createDataFrame(rows, VIDEO)).collect()
    kept = [r for r in rows if r[0] is not None]
    n, met = -(-len(kept) // responses.PAGE_SIZE), 0

    def last(v):
        return (v is None, v)

    def down(text):      # ascending byte order of the result is descending order of the text
        return (True, ()) if text is None else (False, tuple(-b for b in text.encode()) + (1,))

    keys = [lambda r: (last(r[8]), last(r[7]), last(r[1]), last(r[5])),
            lambda r: (last(None if r[6] is None else -r[6]), last(r[1]), last(r[7]), last(r[8]), last(r[5])),
            lambda r: (down(r[5]), last(r[1]), last(r[7]), last(r[8]))]
    for o in range(3):
        for page in range(n):
            mine = sorted((r for r in kept if (r[7] * 7 + r[8] * 13 + r[9] + o) % n == page), key=keys[o])
            got = [json.loads(p.response)["items"] for p in pages if (p.order_idx, p.page) == (o, page)]
            assert [[(i["id"].get("videoId"), i["snippet"].get("publishedAt")) for i in g] for g in got] == [[(r[1], r[5]) for r in mine]][:len(mine)]
            met += bool(mine)
    assert len(pages) == met


def test_detail_items_are_made_on_their_page(spark):
    plan = plan_of(responses.detail_pages(fixtures.videos(spark, SF)))
    for line in plan.splitlines():
        assert not ("collect_list" in line and "rectangular" in line)


def test_written_silver_has_the_columns_its_query_reads(spark):
    apply_plan_defaults(spark)
    narrow = registry.silver_table(spark, SF, ["view_count"])
    assert narrow.columns == ["view_count"] and narrow.count() == registry.silver(spark, SF).count()
    table = registry.partitioned_silver(spark, SF, registry.FILTER_OUT)
    assert set(table.columns) == set(registry.FILTER_OUT) and table.count() == narrow.count()


def test_scoped_batch_is_not_made_from_the_input_again(spark, monkeypatch):
    made = []
    monkeypatch.setattr(queries_io.tables, "overwrite_partitions", lambda df, path: made.append((df.inputFiles(), path)))
    apply_plan_defaults(spark)
    queries_io.q_scoped_overwrite(spark, SF)
    (files, path), = made
    assert files and all(path in f for f in files)


def test_messages_and_landing_files_are_compressed_and_bounded(spark, tmp_dir):
    messages = spark.range(25).select(F.concat(F.lit("mé"), "id").alias("value"))
    n = tables.land_messages(messages.coalesce(1), f"{tmp_dir}/m", 10)
    names = [f for f in os.listdir(f"{tmp_dir}/m") if re.fullmatch(r"part-.*\.txt\.gz", f)]
    assert n == len(names) == 3
    assert {r.value for r in spark.read.text(f"{tmp_dir}/m").collect()} == {f"mé{i}" for i in range(25)}
    tables.landing_csv(spark.createDataFrame([('a "q"\nb', 1)], "video_id string, n int"), f"{tmp_dir}/c")
    assert all(f.endswith(".gz") for f in os.listdir(f"{tmp_dir}/c") if f.startswith("part-"))


def test_windows_write_and_add_up_only_what_they_need(spark, monkeypatch):
    written = {}

    def note(module):
        write = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name: written.update({name: df.columns}) or write(df, name))

    note(registry)
    note(windows)
    registry.QUERIES["keyword_windows"](spark, SF)
    assert written["live-rows"] == ["video_id", "search_keyword", "views", "daily_view_velocity"]
    assert written["keyword-values"] == ["search_keyword", "views", "_n"]
    registry.QUERIES["trend_lifecycle"](spark, SF)
    assert set(written["live-rows"]) == {"search_keyword", "views", "daily_view_velocity", "engagement_rate_%"}


def test_windows_from_rows_equal_those_from_counts(spark):
    rows = [(["a", "b", None][i % 3], None if i % 7 == 0 else i % 11 - 2, None if i % 5 == 0 else i / 8) for i in range(200)]
    df = spark.createDataFrame(rows + [("one", 1, 2.5), ("none", None, None)],
                               "search_keyword string, views long, daily_view_velocity double")
    counts = materialize(windows.value_counts(df), "test-counts")
    mine, merged = windows.keyword_windows(df), windows.keyword_windows(df, per_value=counts)
    ref = df.withColumns({
        "total_kw_views": F.expr("sum(views) over (partition by search_keyword)"),
        "rank_in_keyword": F.expr("rank() over (partition by search_keyword order by views desc nulls last)")})
    shown = lambda d, *c: sorted(str(tuple(r)) for r in d.select("search_keyword", "views", *c).collect())
    every = [c for c in mine.columns if c not in ("search_keyword", "views")]
    assert shown(mine, *every) == shown(merged, *every)
    assert shown(mine, "total_kw_views", "rank_in_keyword") == shown(ref, "total_kw_views", "rank_in_keyword")
