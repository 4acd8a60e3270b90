"""Mergeable states (A7-A10), sketches (A8), schema growth (S3, S7), time zone, run log and the stream watch."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens.operators import moments, sketches
from vidlens.plans import medallion, registry
from vidlens.sinks import tables
from vidlens.streaming import live as stream


@pytest.mark.parametrize("base", [0.0, 1e15])
def test_merged_states_equal_one_pass(spark, base):
    rows = spark.range(5000).select(F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 7).alias("g"), (F.col("id") % 11).alias("run"),
                                    (F.lit(base) + F.col("id") % 97).alias("x"), (F.lit(base) + (F.col("id") * 3) % 101).alias("y"),
                                    F.when(F.col("id") % 13 != 0, F.col("id") % 5).cast("double").alias("z"))
    cols = ["x", "y", "z"]
    for group in ([], ["g"]):
        m = moments.merge(moments.state(rows, cols, [*group, "run"]), cols, group)
        got = {tuple(r[:len(group)]): r for r in m.select(*group, "n", moments.mean("x"), moments.stddev_samp("x"), moments.corr("x", "y"), moments.covar_samp("y", "z")).collect()}
        # The same from values moved near zero, where one pass has all its digits.
        near = rows.where("z is not null").select(*group, (F.col("x") - base).alias("x"), (F.col("y") - base).alias("y"), "z")
        want = near.groupBy(*group).agg(F.count("*"), F.avg("x"), F.stddev_samp("x"), F.corr("x", "y"), F.covar_samp("y", "z")).collect()
        assert len(want) == len(got)
        for w in want:
            g = got[tuple(w[:len(group)])][len(group):]
            w = w[len(group):]
            assert g[0] == w[0] and g[1] == pytest.approx(base + w[1], rel=1e-15)
            assert list(g[2:]) == pytest.approx(list(w[2:]), rel=1e-9, abs=1e-9)


def test_states_of_little(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    r = moments.merge(moments.state(one, ["x", "y"]), ["x", "y"]).select("n", moments.stddev_samp("x"), moments.corr("x", "y")).first()
    assert tuple(r) == (1, None, None)
    assert moments.merge(moments.state(one.where("false"), ["x", "y"]), ["x", "y"]).collect() == []


def test_sketches_merge_for_any_filter(spark):
    rows = spark.range(40_000).select((F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 20).alias("day"),
                                      F.when(F.col("id") % 17 == 0, None).otherwise((F.col("id") * 7919) % 10_007).alias("v"))
    stored = sketches.sketch(rows, "v", ["k", "day"], k=200)
    for keep in ("true", "day < 5", "k = '1'"):
        answers = sketches.quantiles(sketches.merged(stored.where(keep), ["k"], 200), [0.0, 0.25, 0.5, 0.9, 1.0], ["k"])
        out = sketches.certify(answers, rows.where(keep), "v", ["k"], 200).collect()
        assert out and all(r["inside"] and r["rank_low"] <= r["rank_high"] for r in out)
    # An answer that is wrong is said to be.
    wrong = sketches.quantiles(sketches.merged(stored, ["k"], 200), [0.5], ["k"]).withColumn("q", F.col("q") + 3000)
    assert not any(r["inside"] for r in sketches.certify(wrong, rows, "v", ["k"], 200).collect())


def test_schemas_grow_and_refuse(spark, tmp_dir):
    def append(rows, schema):
        return tables.append_evolving(spark.createDataFrame(rows, schema), tmp_dir, "keyword")

    append([(1, 1.5, "a")], "n int, f float, keyword string")
    append([(2**40, 2.5, "a", "new")], "n long, f double, keyword string, extra string")
    append([(3, "b")], "n short, keyword string")
    for schema, row in (("n string, keyword string", ("x", "a")), ("f int, keyword string", (1, "a")), ("extra long, keyword string", (1, "a"))):
        with pytest.raises(tables.SchemaConflict):
            append([row], schema)
    got = tables.read_evolving(spark, tmp_dir)
    assert got.dtypes == [("n", "bigint"), ("f", "double"), ("keyword", "string"), ("extra", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 1.5, "a", None), (2**40, 2.5, "a", "new"), (3, None, "b", None)], key=str)
    assert tables.wider_type(T.DecimalType(10, 2), T.DecimalType(12, 2)) == T.DecimalType(12, 2)
    assert tables.wider_type(T.LongType(), T.DoubleType()) is None


def test_years_do_not_follow_the_callers_zone(spark):
    sf = "/root/testdata/sf0.001"
    want = sorted(map(tuple, registry.QUERIES["clean_videos"](spark, sf).select("video_id", "published_year").collect()), key=str)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = sorted(map(tuple, registry.QUERIES["clean_videos"](spark, sf).select("video_id", "published_year").collect()), key=str)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_the_run_log_counts_what_was_written(spark, tmp_dir):
    layout = medallion.Layout(tmp_dir)
    from vidlens import schemas
    blank = [None] * len(schemas.CSV_SCHEMA.fields)
    rows = [tuple(["v1", *blank[1:]]), tuple(["", *blank[1:]]), tuple([None, *blank[1:]])]
    spark.createDataFrame(rows, schemas.CSV_SCHEMA).coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/in")
    for _ in range(2):      # a rerun replaces its own entries
        medallion.land_run(tables.read_video_csv(spark, f"{tmp_dir}/in"), layout, "r", "2002-01-01 00:00:00")
    log = {(r["metric"], r["source_file"] is not None): r["value"] for r in medallion.read_run_log(spark, layout).collect()}
    assert log[("rows", False)] == log[("rows", True)] == medallion.bronze_all(spark, layout).count()
    assert log[("violations:video_id_present", False)] == log[("rows", False)] - 1


def test_a_failing_query_ends_its_siblings_at_once(spark, tmp_dir):
    good = spark.readStream.format("rate").option("rowsPerSecond", 5).load().writeStream.format("noop").queryName("good").start()
    bad = (spark.readStream.format("rate").option("rowsPerSecond", 5).load()
           .select(F.when(F.col("value") >= 3, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")).alias("v"))
           .writeStream.format("noop").queryName("bad").start())
    start = time.monotonic()
    with pytest.raises(RuntimeError, match="bad failed"):
        stream.run_for([good, bad], poll=600, progress_path=f"{tmp_dir}/progress")
    assert time.monotonic() - start < 120 and not good.isActive and good.exception() is None
    seen = spark.read.parquet(f"{tmp_dir}/progress").groupBy("name").count().collect()
    assert {r["name"] for r in seen} >= {"good"}


def test_a_run_stops_after_its_seconds(spark):
    q = spark.readStream.format("rate").load().writeStream.format("noop").queryName("endless").start()
    out = stream.run_for([q], seconds=3, poll=600)
    assert not q.isActive and out[0]["id"] == str(q.id)


def test_a_byte_limit_cuts_the_triggers(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/in")
    for i in range(6):
        with open(f"{tmp_dir}/in/{i}.txt", "w") as f:
            f.write("x" * 999 + "\n")
    sizes = []
    for limit in (2500, 100):
        q = (stream.file_source(spark, f"{tmp_dir}/in", max_bytes_per_trigger=limit).writeStream
             .foreachBatch(lambda df, i: sizes.append(df.count())).option("checkpointLocation", f"{tmp_dir}/c{limit}")
             .trigger(availableNow=True).start())
        stream.await_all([q])
        assert sum(sizes) == 6 and max(sizes) <= (3 if limit == 2500 else 1)
        sizes.clear()
