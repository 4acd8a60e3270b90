"""Steps that leave nothing behind that no later step reads, and read nothing twice."""

import gzip
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from test_csv_records import as_set, rows_of, written
from test_scale_steps import plan_of
from vidlens import schemas
from vidlens.operators import live
from vidlens.plans import medallion, queries_harvest, registry
from vidlens.session import materialize
from vidlens.sinks import tables, versioned
from vidlens.sources import csv_records
from vidlens.streaming import live as stream

queries_runs, queries_stream, queries_io = registry.queries_runs, registry.queries_stream, registry.queries_io

SF = "/root/testdata/sf0.001"


def shuffle_files(spark):
    jvm = spark._jvm
    files = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in jvm.scala.jdk.javaapi.CollectionConverters.asJava(files) if f.getName().startswith("shuffle_")}


def test_written_steps_leave_no_shuffle_files(spark, tmp_dir):
    rows = spark.range(1000).select((F.col("id") % 7).cast("string").alias("keyword"), F.col("id").cast("string").alias("value"))
    shuffled = rows.repartition(5, "value")
    before = shuffle_files(spark)
    kept = materialize(shuffled, "test-cleanup")
    tables.overwrite(shuffled, f"{tmp_dir}/t")
    tables.overwrite_partitions(shuffled, f"{tmp_dir}/p")
    tables.landing_csv(shuffled, f"{tmp_dir}/c")
    tables.land_messages(shuffled, f"{tmp_dir}/m")
    until = time.monotonic() + 20
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert kept.count() == spark.read.text(f"{tmp_dir}/m").count() == 1000


def test_a_message_is_decoded_once(spark):
    messages = spark.createDataFrame([('{"video_id": "a", "viewCount": 3}',), ("{not",), (None,), ('{"video_id": null}',)], "value string")
    decoded = live.raw_output(live.decode_messages(messages, "value"))
    assert decoded._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    assert [(r.video_id, r.views) for r in decoded.collect()] == [("a", 3)]


@pytest.fixture
def staged(monkeypatch):
    """The plans of the rows that tables are written from."""
    plans, stage = [], versioned.stage

    def note(df, path, partition_by, *a, **k):
        plans.append((os.path.basename(path), plan_of(df)))
        return stage(df, path, partition_by, *a, **k)

    monkeypatch.setattr(versioned, "stage", note)
    return plans


def test_analytics_rows_are_written_before_they_are_dealt_by_keyword(spark, staged, tmp_dir):
    layout = stream.LiveLayout(out=f"{tmp_dir}/out", checkpoints=f"{tmp_dir}/ck")
    registry.apply_plan_defaults(spark)
    tables.land_messages(spark.range(40).select(F.to_json(F.struct(
        F.concat(F.lit("v"), "id").alias("video_id"), F.concat(F.lit("k"), F.col("id") % 3).alias("keyword"),
        F.col("id").alias("viewCount"))).alias("value")), f"{tmp_dir}/m")
    stream.await_all(stream.start_live(stream.file_source(spark, f"{tmp_dir}/m"), layout, trigger=None, as_of="2002-01-01"))
    stream.refresh_analytics(spark, layout, "2002-01-01")
    plan, = [p for name, p in staged if name == "ranked_videos"]
    assert "Join" not in plan
    # The features that are made behind the windows' join are those made before it.
    rows = live.live_features(stream.landed_rows(spark, layout), "2002-01-01")
    want = live.live_analytics(materialize(rows, "test-rows"))
    assert sorted(map(str, stream.read_analytics(spark, layout).collect())) == sorted(map(str, want.collect()))


def test_messages_go_when_all_streams_have_read_them(spark):
    layout = queries_stream.run_stream(spark, SF)
    root = os.path.dirname(layout.out).removeprefix("file:")
    assert os.path.isdir(f"{root}/out") and not os.path.exists(f"{root}/messages")


@pytest.mark.parametrize("name", ["enrich_left_join", "repeated_details"])
def test_details_are_written_before_they_meet(spark, name):
    plan = plan_of(registry.QUERIES[name](spark, SF))
    assert "collect_list" not in plan and "lineitem" not in plan


def test_detail_rows_are_made_once(spark):
    plan = plan_of(queries_harvest.details(spark, SF))
    assert "lineitem" not in plan and "vidlens-detail-rows-" in plan


def test_silver_rows_are_written_before_they_are_dealt_by_keyword(spark, staged, monkeypatch):
    left = []
    monkeypatch.setattr(medallion, "discard", lambda *written: left.extend(f for df in written for f in df.inputFiles()))
    removed = []
    monkeypatch.setattr(versioned, "remove", lambda spark, path, remove=versioned.remove: removed.append(path) or remove(spark, path))
    registry.QUERIES["medallion_end_to_end"](spark, SF)
    plan, = [p for name, p in staged if name == "videos_clean"]
    assert "Window" not in plan and "vidlens-silver-rows-" in plan
    assert any("vidlens-silver-rows-" in f for f in left)
    assert [os.path.basename(p) for p in removed] == ["landing"]


def test_compressed_files_are_cut_in_one_pass(spark, tmp_dir, monkeypatch):
    rng = random.Random(5)
    path = tmp_dir.removeprefix("file:")
    for i, n in enumerate((0, 1, 400, 30)):
        rows = rows_of(rng, n) + ([f'plain{k},"t, {k}",""' for k in range(600)] if n else [])
        written(f"{path}/{i}.csv", rows + (['open,"never closed\nto the end'] if n == 30 else []), last=n != 30)
        with open(f"{path}/{i}.csv", "rb") as f, gzip.open(f"{path}/{i}.csv.gz", "wb") as g:
            g.write(f.read())
        os.remove(f"{path}/{i}.csv")
    want = as_set(tables.read_video_csv(spark, tmp_dir))
    monkeypatch.setattr(csv_records, "starts", lambda functions: pytest.fail("a pass over blocks' states"))
    got = tables.read_video_csv(spark, tmp_dir, multi_line="parallel")
    assert as_set(got) == want and len(want) > 2000
    assert got.select("_source_file").distinct().count() == 3
    assert got.columns == [*schemas.CSV_SCHEMA.fieldNames(), "_source_file"]


def test_compaction_writes_few_files_without_a_shuffle(spark, staged, tmp_dir, monkeypatch):
    registry.apply_plan_defaults(spark)
    layout = stream.LiveLayout(out=f"{tmp_dir}/out", checkpoints=f"{tmp_dir}/ck")
    for i in range(6):
        rows = spark.range(i * 10, i * 10 + 10).select(F.to_json(F.struct(
            F.concat(F.lit("v"), "id").alias("video_id"), F.lit("k").alias("keyword"), F.col("id").alias("viewCount"))).alias("value"))
        tables.land_messages(rows, f"{tmp_dir}/m")
        stream.await_all(stream.start_live(stream.file_source(spark, f"{tmp_dir}/m", None), layout, trigger=None, as_of="2002-01-01"))
    stream.refresh_analytics(spark, layout, "2002-01-01")
    assert stream.compact(spark, layout, at_least=6) == 6
    plan, = [p for name, p in staged if name == "_landed_archive"]
    assert "Rebalance" not in plan and "Exchange" not in plan and "Coalesce 1" in plan
    assert stream.landed_rows(spark, layout).count() == 60


def test_both_parts_of_the_stream_are_made_in_one_pass(spark, monkeypatch):
    made = []
    land = tables.land_messages
    monkeypatch.setattr(tables, "land_messages", lambda df, *a, **k: made.append(a) or land(df, *a, **k))
    got = registry.QUERIES["stream_incremental_windows"](spark, SF)
    assert len(made) == 1
    assert got.count() == registry.QUERIES["live_features"](spark, SF).count()
    assert got.select("video_id").distinct().count() > 1
