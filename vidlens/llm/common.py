"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.session import SHUFFLE_CLEANUP, apply_plan_defaults, discard, materialize, setting

__all__ = ["SHUFFLE_CLEANUP", "arrow_rows", "connected_components", "crc_mod", "discard", "materialize", "prepare", "setting", "table"]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="vidlens-src-"), "vidlens_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> SparkSession:
    """The plan settings and the source that every job here relies on."""
    apply_plan_defaults(spark)
    ship(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_rows(spark: SparkSession, rows: int):
    """Jobs planned inside send at most ``rows`` rows a batch to Python, where rows may be large."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def crc_mod(id_col: str, n: int):
    """crc32(id as text) mod n, as the contracts split held-out rows; a null id gives null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected edge table (src, dst), component being
    the smallest node reachable.

    Alternating star contraction: the large-star step hangs every larger
    neighbour of a node on the smallest neighbour, the small-star step does so
    for the smaller ones; the edge set becomes a forest of stars in a number of
    rounds that grows with the logarithm of the component size. Each step is a
    grouped minimum (combined before the shuffle) and a join, so a hub with a
    third of all edges is neither collected nor expanded into pairs. Each
    round's edges are written to the shared checkpoint folder; only one row of
    totals reaches the driver.
    """
    e = (edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
         .distinct())
    e = materialize(e, "cc-edges")
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").where("u <> v").distinct())
        e = materialize(small, "cc-edges")
        # An unchanged edge set is the fixed point: every edge then joins a node to its root.
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
