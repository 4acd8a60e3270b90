"""Registered queries that go through storage: tables, CSV, JSON messages.

Each writes into a fresh folder under the cluster's shared checkpoint
location (``spark.checkpoint.dir``) and returns a DataFrame read back from
what was written, so the check covers the write and the read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vidlens import schemas
from vidlens.functions.casts import coerce_numeric, iso_duration_seconds
from vidlens.operators import clean, live, rollups, stats
from vidlens.plans import medallion
from vidlens.plans import oracle as O
from vidlens.plans.registry import AS_OF, RUN_TS, flagged, register, silver, with_flagged
from vidlens.session import scratch_path
from vidlens.sinks import tables, versioned
from vidlens.sources import fixtures


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"vidlens-{name}-{uuid.uuid4().hex}")


SUMMARY_SQL_BODY = f"""
SELECT keyword, category_name, count(*) AS total_videos, CAST(sum(view_count) AS BIGINT) AS total_views,
       {O.ravg('view_count', 2)} AS avg_views,
       {O.ravg('engagement_rate', 6)} AS avg_engagement_rate,
       {O.ravg('duration_seconds', 1)} AS avg_duration_sec,
       count(*) FILTER (WHERE performance_tier = 'Viral') AS viral_video_count,
       count(*) FILTER (WHERE is_outlier_views) AS outlier_video_count
FROM flagged GROUP BY keyword, category_name"""

# ---- medallion end to end (L1-L4, S1-S9, S14) ------------------------------------

# The medallion's default dedup order (total: ingest time, publish time, then
# every raw column), spelled out in SQL below.
E2E_ORDER = clean.DEFAULT_DEDUP_ORDER
E2E_ORDER_SQL = "published_at_ts DESC NULLS LAST, " + ", ".join(
    f"{c} ASC NULLS LAST" for c in schemas.CSV_SCHEMA.fieldNames() if c != "video_id")


@register("medallion_end_to_end", with_flagged(SUMMARY_SQL_BODY, order=E2E_ORDER_SQL))
def q_medallion_end_to_end(spark, sf_dir):
    """Fixture rows landed as CSV -> bronze -> silver -> gold; the summary as written."""
    root = _scratch(spark, "medallion")
    landing = f"{root}/landing"
    tables.landing_csv(fixtures.videos(spark, sf_dir).select(*schemas.CSV_SCHEMA.fieldNames()), landing)
    layout = medallion.Layout(root)
    b = medallion.bronze(spark, landing, layout, ingested_at=RUN_TS)
    versioned.remove(spark, landing)        # bronze holds all of it
    medallion.silver(spark, b, layout, dedup_order=E2E_ORDER, etl_date=AS_OF, processed_at=RUN_TS)
    return medallion.gold(spark, layout, AS_OF, run_ts=RUN_TS)


# ---- scoped overwrite (S5, S6) ---------------------------------------------------

SCOPED_KEYWORDS = ("economy", "small")
SCOPED_MIN_VIEWS = 100000


@register("scoped_overwrite", O.with_silver(f"""
SELECT keyword, count(*) AS videos, CAST(sum(view_count) AS BIGINT) AS views FROM silver
WHERE keyword NOT IN {SCOPED_KEYWORDS} OR view_count >= {SCOPED_MIN_VIEWS}
GROUP BY keyword"""))
def q_scoped_overwrite(spark, sf_dir):
    """Full write, then a batch with two keywords only: those two partitions are
    replaced, every other keyword is left as it was."""
    path = _scratch(spark, "scoped")
    s = tables.align(silver(spark, sf_dir), medallion.SILVER_SCHEMA)
    tables.overwrite(s, path)
    # The batch comes from what was written (as a rerun of the gold stage would), not from the input again.
    written = tables.read_table(spark, path, medallion.SILVER_SCHEMA)
    batch = written.filter(F.col("keyword").isin(*SCOPED_KEYWORDS) & (F.col("view_count") >= SCOPED_MIN_VIEWS))
    tables.overwrite_partitions(batch, path)
    back = tables.read_table(spark, path, medallion.SILVER_SCHEMA)
    return back.groupBy("keyword").agg(F.count(F.lit(1)).alias("videos"), F.sum("view_count").alias("views"))


# ---- history append (S8) ---------------------------------------------------------

@register("history_append", with_flagged("""
SELECT run_date, count(*) AS summary_rows, CAST(sum(total_videos) AS BIGINT) AS videos,
       CAST(sum(total_views) AS BIGINT) AS views
FROM (SELECT *, '2002-01-01' AS run_date FROM summary UNION ALL SELECT *, '2002-01-02' AS run_date FROM summary)
GROUP BY run_date""", ctes=(f"summary AS ({SUMMARY_SQL_BODY})",)))
def q_history_append(spark, sf_dir):
    """Two run snapshots appended to one history table, read back per run date."""
    path = _scratch(spark, "history")
    summary = rollups.keyword_category_summary(flagged(spark, sf_dir))
    stage = _scratch(spark, "history-stage")
    summary.write.parquet(stage)
    staged = spark.read.schema(schemas.SUMMARY_SCHEMA).parquet(stage)
    tables.write_history(staged, path, "2002-01-01", RUN_TS)
    tables.write_history(staged, path, "2002-01-02", RUN_TS)
    back = tables.read_table(spark, path, schemas.HISTORY_SCHEMA)
    return back.groupBy("run_date").agg(F.count(F.lit(1)).alias("summary_rows"),
                                        F.sum("total_videos").alias("videos"),
                                        F.sum("total_views").alias("views"))


# ---- schema alignment (S7) -------------------------------------------------------

OLD_LAYOUT = [f for f in schemas.SUMMARY_SCHEMA.fields if f.name != "outlier_video_count"]


@register("schema_align", with_flagged("""
SELECT keyword, category_name, total_videos,
       CASE WHEN keyword LIKE '%cut' THEN outlier_video_count ELSE NULL END AS outlier_video_count
FROM summary""", ctes=(f"summary AS ({SUMMARY_SQL_BODY})",)))
def q_schema_align(spark, sf_dir):
    """A table written in the old layout (no outlier column) takes a batch in
    the new one: the table schema widens, old rows read the new column as NULL."""
    from pyspark.sql import types as T
    path = _scratch(spark, "align")
    summary = rollups.keyword_category_summary(flagged(spark, sf_dir))
    old_schema = T.StructType(OLD_LAYOUT)
    old = summary.filter(~F.col("keyword").endswith("cut"))
    tables.overwrite(tables.align(old, old_schema), path)
    new = summary.filter(F.col("keyword").endswith("cut"))
    wide = tables.merged_schema(old_schema, tables.align(new, schemas.SUMMARY_SCHEMA).schema)
    tables.overwrite_partitions(tables.align(new, wide), path)
    back = tables.read_table(spark, path, wide)
    return back.select("keyword", "category_name", "total_videos", "outlier_video_count")


# ---- CSV round trip (S9, S15, U1) ------------------------------------------------

@register("csv_roundtrip", with_flagged("""
SELECT keyword, category_name, total_videos, total_views, avg_views, avg_engagement_rate, avg_duration_sec,
       viral_video_count, CASE WHEN keyword LIKE '%cut' THEN outlier_video_count ELSE NULL END AS outlier_video_count
FROM summary""", ctes=(f"summary AS ({SUMMARY_SQL_BODY})",)))
def q_csv_roundtrip(spark, sf_dir):
    """Summary exported as one CSV file (with header), read back from the folder
    as text and typed again. Two exports of disjoint halves, one without the
    outlier column, are concatenated by name (U1)."""
    root = _scratch(spark, "csv")
    summary = rollups.keyword_category_summary(flagged(spark, sf_dir))
    stage = f"{root}/stage"
    summary.write.parquet(stage)
    staged = spark.read.schema(schemas.SUMMARY_SCHEMA).parquet(stage)
    tables.export_csv(staged.filter(F.col("keyword").endswith("cut")), f"{root}/a", one_file=True)
    tables.export_csv(staged.filter(~F.col("keyword").endswith("cut")).drop("outlier_video_count"), f"{root}/b")
    parts = [tables.read_csv_dir(spark, f"{root}/a"), tables.read_csv_dir(spark, f"{root}/b")]
    text = tables.union_parts(parts)
    typed = []
    for f in schemas.SUMMARY_SCHEMA.fields:
        c = F.col(f.name)
        typed.append((c if f.dataType.simpleString() == "string" else c.try_cast(f.dataType)).alias(f.name))
    return text.select(*typed)


# ---- numeric coercion for publishing --------------------------------------------

@register("numeric_coercion", with_flagged("""
SELECT keyword, category_name, CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS avg_views_num
FROM (SELECT keyword, category_name,
             TRY_CAST(CASE total_videos % 6 WHEN 0 THEN 'abc' WHEN 1 THEN 'inf' WHEN 2 THEN 'NaN' WHEN 3 THEN ''
                      ELSE CAST(avg_views AS VARCHAR) END AS DOUBLE) AS v
      FROM summary)""", ctes=(f"summary AS ({SUMMARY_SQL_BODY})",)))
def q_numeric_coercion(spark, sf_dir):
    """Summary cells as text with junk ('abc', 'inf', 'NaN', '') -> numbers;
    anything not a finite number becomes NULL."""
    s = rollups.keyword_category_summary(flagged(spark, sf_dir))
    n = F.col("total_videos") % 6
    text = (F.when(n == 0, "abc").when(n == 1, "inf").when(n == 2, "NaN").when(n == 3, "")
             .otherwise(F.col("avg_views").cast("string")))
    return s.select("keyword", "category_name", coerce_numeric(text).alias("avg_views_num"))


# ---- JSON messages round trip (S13, S10 file source, T1, P7, P10, P8) ------------

@register("json_roundtrip", O.with_videos(f"""
SELECT video_id, keyword AS search_keyword, 'General' AS keyword_type, title, channel AS channel_title,
       published_at, view_count AS views, like_count AS likes, comment_count AS comments,
       duration_seconds, category_id, platform AS default_audio_language, tags,
       category_name AS topic_categories, video_id AS message_key
FROM videos WHERE video_id IS NOT NULL"""))
def q_json_roundtrip(spark, sf_dir):
    """Records -> keyed JSON messages (plus undecodable junk) -> stored messages ->
    decode with the declared schema -> raw 14-column output and the message's key."""
    path = _scratch(spark, "messages")
    msgs = tables.to_messages(fixtures.video_messages(spark, sf_dir))
    junk = spark.range(3).select(F.lit(None).cast("binary").alias("key"),
                                 F.element_at(F.array(F.lit("{not json"), F.lit(""), F.lit('{"video_id": null}')),
                                              (F.col("id") + 1).cast("int")).alias("value"))
    msgs.unionByName(junk).write.mode("overwrite").parquet(path)
    stored = spark.read.schema(msgs.schema).parquet(path)
    decoded = live.decode_messages(stored, "value", keep=["key"])
    return live.raw_output(decoded, keep=["key"]).withColumn("message_key", F.col("key").cast("string")).drop("key")


# ---- ISO-8601 durations ------------------------------------------------------------

@register("iso_duration_seconds", f"""
SELECT l_orderkey, l_linenumber, d AS duration,
       CAST(COALESCE(TRY_CAST(regexp_extract(d, '^PT(?:(\\d+)H)?(?:(\\d+)M)?(?:(\\d+)S)?', 1) AS BIGINT), 0) * 3600
          + COALESCE(TRY_CAST(regexp_extract(d, '^PT(?:(\\d+)H)?(?:(\\d+)M)?(?:(\\d+)S)?', 2) AS BIGINT), 0) * 60
          + COALESCE(TRY_CAST(regexp_extract(d, '^PT(?:(\\d+)H)?(?:(\\d+)M)?(?:(\\d+)S)?', 3) AS BIGINT), 0)
          AS INTEGER) AS duration_seconds
FROM (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 7
        WHEN 0 THEN 'PT' || CAST(l_partkey % 3 AS VARCHAR) || 'H' || CAST(l_suppkey % 60 AS VARCHAR) || 'M'
                         || CAST(l_orderkey % 60 AS VARCHAR) || 'S'
        WHEN 1 THEN 'PT' || CAST(l_suppkey % 60 AS VARCHAR) || 'M' || CAST(l_orderkey % 60 AS VARCHAR) || 'S'
        WHEN 2 THEN 'PT' || CAST(l_orderkey % 600 AS VARCHAR) || 'S'
        WHEN 3 THEN 'P1DT' || CAST(l_partkey % 24 AS VARCHAR) || 'H'
        WHEN 4 THEN 'PT' || CAST(l_orderkey % 9 AS VARCHAR) || '.5S'
        WHEN 5 THEN ''
        ELSE NULL END AS d
      FROM lineitem)""")
def q_iso_duration_seconds(spark, sf_dir):
    li = fixtures.table(spark, sf_dir, "lineitem")
    s = lambda c, m: (F.col(c) % m).cast("string")
    n = F.col("l_linenumber") % 7
    d = (F.when(n == 0, F.concat(F.lit("PT"), s("l_partkey", 3), F.lit("H"), s("l_suppkey", 60), F.lit("M"),
                                 s("l_orderkey", 60), F.lit("S")))
          .when(n == 1, F.concat(F.lit("PT"), s("l_suppkey", 60), F.lit("M"), s("l_orderkey", 60), F.lit("S")))
          .when(n == 2, F.concat(F.lit("PT"), s("l_orderkey", 600), F.lit("S")))
          .when(n == 3, F.concat(F.lit("P1DT"), s("l_partkey", 24), F.lit("H")))
          .when(n == 4, F.concat(F.lit("PT"), s("l_orderkey", 9), F.lit(".5S")))
          .when(n == 5, F.lit("")))
    return li.select("l_orderkey", "l_linenumber", d.alias("duration"),
                     iso_duration_seconds(d).alias("duration_seconds"))
