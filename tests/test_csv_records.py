"""Multi-line CSV in many tasks (S1) equals Spark's own multi-line reader."""

import os
import random

import pytest
from pyspark.sql import functions as F

from vidlens import schemas
from vidlens.plans import medallion
from vidlens.sinks import tables
from vidlens.sources import csv_records


def cell(rng):
    kind = rng.random()
    if kind < 0.35:
        return "".join(rng.choice("abc é") for _ in range(rng.randint(0, 8)))
    if kind < 0.45:
        return f'5" by {rng.randint(1, 9)}"'                       # quotes inside an unquoted field
    body = "".join(rng.choice(['a', ',', '\n', '""', ' ', 'x, "" y', '\n\n', 'line\n']) for _ in range(rng.randint(0, 6)))
    return f'"{body}"'


def written(path, rows, sep="\n", last=True):
    names = schemas.CSV_SCHEMA.fieldNames()
    text = sep.join([",".join(names), *rows]) + (sep if last else "")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def rows_of(rng, n):
    out = []
    for i in range(n):
        cells = [f"id{i}", cell(rng), cell(rng), "2024-01-01", cell(rng), "yt", rng.choice(["10", "lots", ""]), "2", "1", cell(rng), "30"]
        cells += [cell(rng) for _ in range(rng.choice([8, 8, 8, 3]))]
        out.append(",".join(cells))
    return out


def as_set(df):
    return sorted(map(tuple, df.select(*schemas.CSV_SCHEMA.fieldNames()).collect()), key=repr)


@pytest.fixture
def small_blocks(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    opened = spark.conf.get("spark.sql.files.openCostInBytes")

    def use(n):
        spark.conf.set(key, str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield use
    spark.conf.set(key, before)
    spark.conf.set("spark.sql.files.openCostInBytes", opened)


@pytest.mark.parametrize("size,sep", [(64, "\n"), (300, "\n"), (700, "\r\n"), (1 << 20, "\n")])
def test_parallel_reader_equals_the_multi_line_one(spark, tmp_dir, small_blocks, size, sep):
    rng = random.Random(size)
    rows = [r.replace("\n", sep) for r in rows_of(rng, 60)]
    written(f"{tmp_dir}/csv/a.csv", rows, sep)
    written(f"{tmp_dir}/csv/b.csv", rows_of(rng, 5), last=False)
    written(f"{tmp_dir}/csv/c.csv", [])
    want = as_set(tables.read_video_csv(spark, f"{tmp_dir}/csv"))
    small_blocks(size)
    df = tables.read_video_csv(spark, f"{tmp_dir}/csv", multi_line="parallel")
    assert as_set(df) == want and len(want) == 65
    assert {os.path.basename(r[0]) for r in df.select("_source_file").distinct().collect()} == {"a.csv", "b.csv"}


def test_one_large_file_is_read_in_many_tasks(spark, tmp_dir, small_blocks):
    rng = random.Random(1)
    rows = [f'v{i},"t, ""{i}""\nsecond\nline",ch,2024-01-01,k{i % 3},yt,{i},1,1,"{"d" * rng.randint(0, 300)}\n",30,s,1,c,a|b,2,true,hd,no'
            for i in range(3000)]
    written(f"{tmp_dir}/csv/one.csv", rows)
    small_blocks(64 * 1024)
    df = tables.read_video_csv(spark, f"{tmp_dir}/csv/one.csv", multi_line="parallel")
    tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 5
    assert as_set(df) == as_set(tables.read_video_csv(spark, f"{tmp_dir}/csv/one.csv"))


def test_lines_as_functions_of_the_state():
    for line, outside, inside in [('a,b', False, True), ('a,"b', True, False), ('"a""b",c', False, False), ('x",y', False, False),
                                  ('5" wide,"open', True, True), ('""', False, True), ('"', True, False), ('""",', True, False),
                                  ('', False, True), ('"a"x,"b', True, True)]:
        assert csv_records.ends_open(line, False) == outside, line
        assert csv_records.ends_open(line, True) == inside, line


def test_medallion_reads_one_file_in_parallel(spark, tmp_dir, small_blocks):
    rows = [f'v{i},"Title\n{i}",ch,2024-01-01,ai,yt,{i * 1000},1,1,d,30,short,1,Music,,0,true,hd,true' for i in range(200)]
    written(f"{tmp_dir}/in/videos.csv", rows)
    small_blocks(2048)
    summary = medallion.run_all(spark, f"{tmp_dir}/in/videos.csv", medallion.Layout(f"{tmp_dir}/out"), "2002-01-01", export=False)
    assert [tuple(r)[:3] for r in summary.collect()] == [("ai", "Music", 200)]
