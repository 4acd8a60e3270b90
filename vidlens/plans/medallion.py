"""The batch medallion: bronze -> silver -> gold (L1-L4).

Each stage is a plain function over DataFrames and table paths. The stage
outputs are written tables in shared storage, so a later stage (or a retry
after a lost executor) re-reads them instead of recomputing the lineage.
"""

from __future__ import annotations

import dataclasses
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidlens import schemas
from vidlens.functions.casts import safe_timestamp
from vidlens.operators import clean, filters, rollups, stats
from vidlens.session import apply_plan_defaults, discard, materialize, writing
from vidlens.sinks import tables, versioned


@dataclass(frozen=True)
class Layout:
    """Table locations under one root folder in shared storage."""
    root: str

    @property
    def bronze(self) -> str:
        return os.path.join(self.root, "videos_bronze")

    @property
    def silver(self) -> str:
        return os.path.join(self.root, "videos_clean")

    @property
    def summary(self) -> str:
        return os.path.join(self.root, "keyword_summary")

    @property
    def history(self) -> str:
        return os.path.join(self.root, "videos_history")

    @property
    def run_log(self) -> str:
        return os.path.join(self.root, "run_log")

    @property
    def export(self) -> str:
        return os.path.join(self.root, "export", "keyword_summary_csv")


def _silver_schema() -> T.StructType:
    csv = {f.name: f for f in schemas.CSV_SCHEMA.fields}
    fields = [csv[n] for n in schemas.CSV_SCHEMA.fieldNames() if n != "keyword"]
    fields = [T.StructField(f.name, T.BooleanType()) if f.name in ("has_captions", "licensed_content") else f
              for f in fields]
    fields += [schemas.BRONZE_SCHEMA["_ingested_at"], schemas.BRONZE_SCHEMA["_source_file"],
               T.StructField("published_at_ts", T.TimestampType()),
               T.StructField("published_year", T.IntegerType()),
               T.StructField("published_month", T.IntegerType()),
               T.StructField("etl_date", T.StringType()),
               T.StructField("engagement_rate", T.DoubleType()),
               T.StructField("like_to_comment_ratio", T.DoubleType()),
               T.StructField("performance_tier", T.StringType()),
               T.StructField("etl_processed_at", T.TimestampType()),
               csv["keyword"]]  # the partition column is stored last
    return T.StructType(fields)


SILVER_SCHEMA = _silver_schema()


# ---- the run log (A12, Q1, S2) -----------------------------------------------------

RUN_LOG_SCHEMA = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("stage", T.StringType()),
                               T.StructField("metric", T.StringType()), T.StructField("source_file", T.StringType()),
                               T.StructField("value", T.LongType())])


def bronze_checks():
    """What bronze rows are counted against as they are written (Q1); rows that fail stay, silver's rules decide."""
    return {
        "video_id_present": F.col("video_id").isNotNull() & (F.trim("video_id") != ""),
        "views_non_negative": F.col("view_count") >= 0,
        "published_at_parses": safe_timestamp("published_at").isNotNull(),
    }


def observed(df: DataFrame, name: str, checks=None) -> tuple[DataFrame, Observation]:
    """Counts that ride on the write of ``df``, with no job of their own."""
    obs = Observation(name)
    counts = [F.count_if(~check).alias(f"violations:{n}") for n, check in (checks or {}).items()]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *counts), obs


def _log(layout: Layout, run_id: str, stage: str, obs: Observation, by_file: DataFrame | None = None) -> None:
    """A stage's counts go to the run log, under the run and stage, where a rerun replaces them."""
    spark = SparkSession.active()
    print(f"[{stage.upper()}] rows written: {obs.get.get('rows')}")
    rows = spark.createDataFrame([(run_id, stage, k, None, v) for k, v in obs.get.items()], RUN_LOG_SCHEMA)
    if by_file is not None:
        counts = by_file.groupBy(F.col("_source_file").alias("source_file")).agg(F.count(F.lit(1)).alias("value"))
        rows = rows.unionByName(counts.select(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.lit("rows").alias("metric"),
                                              "source_file", "value"))
    rows.coalesce(1).write.mode("overwrite").parquet(os.path.join(layout.run_log, f"run={run_id}", f"of={stage}"))


def read_run_log(spark: SparkSession, layout: Layout) -> DataFrame:
    """run_id, stage, metric, source_file (of a count for one file), value."""
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(layout.run_log).select(*RUN_LOG_SCHEMA.fieldNames())


def bronze_run(spark: SparkSession, layout: Layout, run_id: str) -> DataFrame:
    """The rows that one run landed."""
    return spark.read.schema(schemas.BRONZE_SCHEMA).parquet(os.path.join(layout.bronze, f"run={run_id}"))


def bronze_all(spark: SparkSession, layout: Layout) -> DataFrame:
    """Every run's rows."""
    return tables.read_table(spark, layout.bronze, schemas.BRONZE_SCHEMA).select(*schemas.BRONZE_SCHEMA.fieldNames())


def land_run(df: DataFrame, layout: Layout, run_id: str, ingested_at: str | None = None) -> None:
    """L1: raw rows -> audit columns -> the run's folder of bronze; a rerun under the same id replaces it."""
    audited, obs = observed(tables.with_audit(df, ingested_at), f"bronze-{run_id}", bronze_checks())
    with writing(df.sparkSession):
        audited.write.mode("overwrite").option("compression", "zstd").parquet(os.path.join(layout.bronze, f"run={run_id}"))
    _log(layout, run_id, "bronze", obs, bronze_run(df.sparkSession, layout, run_id))


def bronze(spark: SparkSession, input_path: str, layout: Layout, ingested_at: str | None = None,
           multi_line: bool | str = True, run_id: str | None = None) -> DataFrame:
    """L1: raw CSV -> bronze. Returns the whole bronze table (every run's rows;
    silver de-duplicates across them). ``multi_line`` as in ``tables.read_video_csv``."""
    land_run(tables.read_video_csv(spark, input_path, multi_line=multi_line), layout, run_id or uuid.uuid4().hex, ingested_at)
    return bronze_all(spark, layout)


def silver(spark: SparkSession, bronze_df: DataFrame, layout: Layout, dedup_order=clean.DEFAULT_DEDUP_ORDER,
           etl_date: str | None = None, processed_at: str | None = None, full_refresh: bool = True,
           run_id: str | None = None) -> DataFrame:
    """L2: clean -> silver, partitioned by keyword.

    Silver is made from the whole of bronze, so by default it is replaced
    whole: a video that moved to another keyword leaves no row behind. Without
    ``full_refresh`` only the keywords in ``bronze_df`` are replaced (S6).
    Returns the silver table as written (re-read, not recomputed).
    """
    seen = Observation("silver-input")
    bronze_df = bronze_df.observe(seen, F.max("_ingested_at").cast("string").alias("latest"))
    # Written between the two shuffles of whole rows, by id and by keyword, so that they do not lie on disk together.
    rows = materialize(_silver_rows(bronze_df, dedup_order, etl_date, processed_at), "silver-rows")
    out, obs = observed(rows, "silver")
    if full_refresh:
        tables.overwrite(out, layout.silver)
        _remember(spark, layout, seen.get["latest"])
    else:
        tables.overwrite_partitions(out, layout.silver)
    discard(rows)
    _log(layout, run_id or uuid.uuid4().hex, "silver", obs)
    return tables.read_table(spark, layout.silver, SILVER_SCHEMA)


def _silver_rows(bronze_df: DataFrame, dedup_order, etl_date, processed_at) -> DataFrame:
    return tables.align(clean.clean_videos(bronze_df, dedup_order, etl_date, processed_at), SILVER_SCHEMA)


def _remember(spark: SparkSession, layout: Layout, latest: str | None) -> None:
    """The newest ingest time that silver holds goes with its version."""
    now = versioned.current(spark, layout.silver)
    versioned.publish(spark, layout.silver, dataclasses.replace(now, number=now.number + 1, meta={**now.meta, "latest": latest}))


def merge_silver(spark: SparkSession, layout: Layout, run_id: str, etl_date: str | None = None,
                 processed_at: str | None = None) -> DataFrame:
    """L2 by increments: one run's rows change silver; bronze of earlier runs is not read.

    The survivor of a video id is its newest ingest (``clean.DEFAULT_DEDUP_ORDER``).
    Where all of the run's rows were ingested after everything silver holds, its own
    survivors therefore win, whether their row stays or is dropped: the old rows
    of the run's ids go, the new ones come. Only the keywords that these ids enter
    or leave are rewritten; of the others the id column is read, to find them. A
    run that is not newer, or a first one, refreshes silver from all of bronze.
    Rows that do not change keep the run date they were made on.
    """
    before = versioned.current(spark, layout.silver)
    batch = bronze_run(spark, layout, run_id)
    span = batch.agg(F.min("_ingested_at").cast("string").alias("first"), F.max("_ingested_at").cast("string").alias("last")).first()
    latest = before.meta.get("latest") if before else None
    if span["first"] is None and before is not None:        # an empty run
        return versioned.read(spark, layout.silver, SILVER_SCHEMA)
    if latest is None or span["first"] <= latest:
        return silver(spark, bronze_all(spark, layout), layout, etl_date=etl_date, processed_at=processed_at, run_id=run_id)
    new = materialize(_silver_rows(batch, clean.DEFAULT_DEDUP_ORDER, etl_date, processed_at), "silver-new")
    ids = materialize(clean.drop_blank_ids(batch).select("video_id").distinct(), "silver-ids")
    old = versioned.read(spark, layout.silver, SILVER_SCHEMA, version=before).select("video_id", "keyword")
    left = old.join(ids, "video_id", "left_semi").select("keyword")
    # No more than silver has partitions.
    touched = [r["keyword"] for r in left.unionByName(new.select("keyword")).distinct().collect()]
    kept = versioned.read(spark, layout.silver, SILVER_SCHEMA, touched, before).join(ids, "video_id", "left_anti")
    out, obs = observed(kept.select(*SILVER_SCHEMA.fieldNames()).unionByName(new), f"silver-{run_id}")
    versioned.replace_partitions(out, layout.silver, "keyword", touched, {**before.meta, "latest": span["last"]})
    discard(new, ids)
    _log(layout, run_id, "silver", obs)
    return versioned.read(spark, layout.silver, SILVER_SCHEMA)


def pre_load_analysis(silver_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A1/O1 and A2/O2 reports of the silver stage."""
    return rollups.top_keywords_by_engagement(silver_df, 10), rollups.duration_category_counts(silver_df)


def gold(spark: SparkSession, layout: Layout, run_date: str, min_views: int = 0, keyword=None,
         keyword_mode: str = "exact", run_ts: str | None = None, full_refresh: bool = False,
         exact_quartiles: bool = True, export: bool = True, one_file: bool = False,
         buckets: int | None = None) -> DataFrame:
    """L3: read silver (P3-P6) -> outlier flag (F4) -> summary (A3-A5) ->
    scoped overwrite of the summary (S6; ``full_refresh`` also drops keywords
    that vanished, K14) -> history snapshot (S8) -> CSV export (S9).

    The summary is computed once and staged as a small table in shared
    storage; the three writes read the staged copy. Returns it.
    """
    silver_df = tables.read_table(spark, layout.silver, SILVER_SCHEMA)
    gold_in = filters.read_gold_input(silver_df, min_views, keyword, keyword_mode)
    flagged = stats.flag_outliers(gold_in, exact=exact_quartiles, buckets=buckets)
    summary = tables.align(rollups.keyword_category_summary(flagged), schemas.SUMMARY_SCHEMA)
    stage = os.path.join(layout.root, "_staging", f"summary-{run_date}-{uuid.uuid4().hex}")
    with writing(spark):
        summary.write.mode("overwrite").parquet(stage)
    staged = spark.read.schema(schemas.SUMMARY_SCHEMA).parquet(stage)
    if full_refresh:
        tables.overwrite(staged, layout.summary)
    else:                    # creates the table on the first run
        tables.overwrite_partitions(staged, layout.summary)
    tables.write_history(staged, layout.history, run_date, run_ts)
    if export:
        tables.export_csv(rollups.summary_report(staged), layout.export, one_file)
    return staged


def run_all(spark: SparkSession, input_path: str, layout: Layout, run_date: str, multi_line: bool | str = "parallel",
            run_id: str | None = None, ingested_at: str | None = None, **gold_kwargs) -> DataFrame:
    """L4: bronze -> silver -> gold, in order. Silver takes in this run's rows (``merge_silver``)."""
    apply_plan_defaults(spark)
    run_id = run_id or uuid.uuid4().hex
    land_run(tables.read_video_csv(spark, input_path, multi_line=multi_line), layout, run_id, ingested_at)
    merge_silver(spark, layout, run_id, etl_date=run_date)
    return gold(spark, layout, run_date, **gold_kwargs)
