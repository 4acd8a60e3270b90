"""Storage semantics (scoped overwrite, schema alignment) and the live stream."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schemas
from vidlens.operators import live, rollups
from vidlens.sinks import tables
from vidlens.sources import fixtures
from vidlens.streaming import live as stream

SCHEMA = T.StructType([T.StructField("v", T.LongType()), T.StructField("keyword", T.StringType())])


def read(spark, path):
    return sorted(((r.keyword, r.v) for r in tables.read_table(spark, path, SCHEMA).collect()), key=str)


def test_scoped_overwrite_keeps_other_keywords(spark, tmp_dir):
    tables.overwrite(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], SCHEMA), tmp_dir)
    tables.overwrite_partitions(spark.createDataFrame([(10, "a")], SCHEMA), tmp_dir)
    assert read(spark, tmp_dir) == sorted([("a", 10), ("b", 2), (None, 3)], key=str)
    # an empty batch changes nothing
    tables.overwrite_partitions(spark.createDataFrame([], SCHEMA), tmp_dir)
    assert read(spark, tmp_dir) == sorted([("a", 10), ("b", 2), (None, 3)], key=str)
    # a NULL keyword replaces only the NULL partition
    tables.overwrite_partitions(spark.createDataFrame([(30, None)], SCHEMA), tmp_dir)
    assert read(spark, tmp_dir) == sorted([("a", 10), ("b", 2), (None, 30)], key=str)


def test_digit_keywords_stay_strings(spark, tmp_dir):
    tables.overwrite(spark.createDataFrame([(1, "007"), (2, "42")], SCHEMA), tmp_dir)
    assert read(spark, tmp_dir) == sorted([("007", 1), ("42", 2)], key=str)


def test_schema_align_widens_table(spark, tmp_dir):
    old = T.StructType([T.StructField("a", T.LongType()), T.StructField("keyword", T.StringType())])
    tables.overwrite(spark.createDataFrame([(1, "x")], old), tmp_dir)
    new = spark.createDataFrame([("y", 5, 2)], "keyword string, extra long, a long")
    wide = tables.merged_schema(old, new.schema)
    assert wide.fieldNames() == ["a", "keyword", "extra"]
    tables.overwrite_partitions(tables.align(new, wide), tmp_dir)
    got = sorted(tuple(r) for r in tables.read_table(spark, tmp_dir, wide).select("keyword", "a", "extra").collect())
    assert got == [("x", 1, None), ("y", 2, 5)]


def test_read_missing_table_names_it(spark, tmp_dir):
    import pytest
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, os.path.join(tmp_dir, "nope"))


def _write_message_files(spark, path, sf_dir, files=4):
    msgs = tables.to_messages(fixtures.video_messages(spark, sf_dir)).select("value")
    msgs.repartition(files, "value").write.mode("overwrite").text(path)


def test_stream_equals_batch_and_restart_adds_nothing_twice(spark, tmp_dir):
    sf = "/root/testdata/sf0.001"
    src = f"{tmp_dir}/src"
    _write_message_files(spark, f"{tmp_dir}/all", sf, files=4)
    files = sorted(f for f in os.listdir(f"{tmp_dir}/all") if f.endswith(".txt"))
    os.makedirs(src)
    layout = stream.LiveLayout(f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    # first run sees two files, second run (same checkpoints) sees all four
    for f in files[:2]:
        os.link(f"{tmp_dir}/all/{f}", f"{src}/{f}")
    stream.await_all(stream.start_live(stream.file_source(spark, src), layout, "STANDARD", None, "2002-01-01"))
    for f in files[2:]:
        os.link(f"{tmp_dir}/all/{f}", f"{src}/{f}")
    stream.await_all(stream.start_live(stream.file_source(spark, src), layout, "STANDARD", None, "2002-01-01"))
    stream.refresh_analytics(spark, layout, "2002-01-01")

    raw = live.raw_output(fixtures.video_messages(spark, sf))
    feats = live.live_features(raw, "2002-01-01")
    expect_sum = sorted(tuple(r) for r in rollups.keyword_popularity(feats, "STANDARD").collect())
    got_sum = sorted(tuple(r) for r in stream.read_summary(spark, layout).collect())
    assert got_sum == expect_sum
    analytics = live.live_analytics(feats)
    assert analytics.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.LIVE_ANALYTICS_SCHEMA]
    expect_an = sorted(map(tuple, analytics.collect()), key=repr)
    got_an = sorted(map(tuple, stream.read_analytics(spark, layout).collect()), key=repr)
    assert got_an == expect_an
    assert stream.read_raw_output(spark, layout).count() == raw.count()


def test_read_video_csv_permissive(spark, tmp_dir):
    header = ",".join(schemas.CSV_SCHEMA.fieldNames())
    good = ('v1,"Director\'s ""Cut""",ch,2024-01-01T00:00:00Z,ai,yt,10,2,1,"line one\nline two",61,long,'
            '22,Music,a|b,2,true,hd,false')
    bad_number = "v2,t,ch,2024-01-01,ai,yt,lots,2,1,d,30,short,22,Music,,0,no,hd,true"
    short_row = "v3,t,ch"
    os.makedirs(tmp_dir)
    with open(f"{tmp_dir}/videos.csv", "w", encoding="utf-8") as f:
        f.write("\n".join([header, good, bad_number, short_row]) + "\n")
    rows = {r.video_id: r for r in tables.read_video_csv(spark, f"{tmp_dir}/videos.csv").collect()}
    assert set(rows) == {"v1", "v2", "v3"}
    assert rows["v1"].title == 'Director\'s "Cut"' and rows["v1"].description == "line one\nline two"
    assert rows["v1"].view_count == 10 and rows["v1"].duration_seconds == 61
    assert rows["v2"].view_count is None and rows["v2"].like_count == 2      # bad cell -> NULL, row kept
    assert rows["v3"].channel == "ch" and rows["v3"].keyword is None          # short row -> NULL tail
    audited = tables.with_audit(tables.read_video_csv(spark, f"{tmp_dir}/videos.csv"), "2002-01-01 00:00:00")
    assert {r._source_file.endswith("videos.csv") for r in audited.collect()} == {True}


def test_a_new_checkpoint_keeps_earlier_runs_and_a_replay_overwrites_itself(spark, tmp_dir):
    sf = "/root/testdata/sf0.001"
    _write_message_files(spark, f"{tmp_dir}/src", sf, files=2)
    layout = stream.LiveLayout(f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    rows = live.raw_output(fixtures.video_messages(spark, sf)).count()
    stream.await_all(stream.start_live(stream.file_source(spark, f"{tmp_dir}/src"), layout, None, None))
    assert stream.landed_rows(spark, layout).count() == rows
    # failure between landing and rebuild: the same batch lands again under the same ids
    batch = stream.landed_rows(spark, layout).limit(10)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "replayed")
    try:
        stream.land(layout)(batch, 3)
        stream.land(layout)(batch, 3)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert stream.landed_rows(spark, layout).count() == rows + 10
    other = stream.LiveLayout(f"{tmp_dir}/out", f"{tmp_dir}/ckpt2")
    stream.await_all(stream.start_live(stream.file_source(spark, f"{tmp_dir}/src"), other, None, None))
    assert stream.landed_rows(spark, layout).count() == 2 * rows + 10


def test_partitioned_write_makes_few_files_and_history_is_retry_safe(spark, tmp_dir):
    df = spark.range(0, 4000, 1, 16).select(F.col("id").alias("v"), (F.col("id") % 5).cast("string").alias("keyword"))
    tables.overwrite(df, f"{tmp_dir}/t")
    files = [f for _, _, names in os.walk(f"{tmp_dir}/t") for f in names if f.endswith(".parquet")]
    assert len(files) <= 10
    for _ in range(2):
        tables.write_history(df, f"{tmp_dir}/h", "2002-01-01", "2002-01-01 00:00:00")
    assert spark.read.parquet(f"{tmp_dir}/h").count() == 4000


def test_missing_topic_starts_nothing(spark):
    assert stream.kafka_source(spark, "host:1", "t", topic_exists=lambda t: False) is None


def test_scratch_needs_a_shared_folder_off_local():
    import pytest

    from vidlens.session import local_scratch
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        local_scratch("spark://host:7077", "app")
    with pytest.raises(RuntimeError):
        local_scratch("local-cluster[3,2,1000]", "app")
    assert local_scratch("local[4]", "app") == local_scratch("local[4]", "app")
