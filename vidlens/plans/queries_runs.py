"""Registered queries over several runs: incremental silver, run log, growing schemas, guards, live increments."""

from __future__ import annotations

from pyspark.sql import functions as F

from vidlens import schemas
from vidlens.operators import filters, harvest, moments, rollups, sketches
from vidlens.plans import medallion
from vidlens.plans import oracle as O
from vidlens.plans.queries_harvest import DETAIL_OUT, DETAILS_CTES, details
from vidlens.plans.queries_io import E2E_ORDER_SQL, SUMMARY_SQL_BODY, _scratch
from vidlens.plans.queries_stream import _CHECKS_SQL
from vidlens.plans.registry import (AS_OF, _corr_sql, PRIMARY_KEYWORD, RUN_TS, WINDOWS_SQL, _q, flagged, partitioned_silver,
                                    register, silver_table, with_flagged)
from vidlens.schemas import LIVE_ANALYTICS_COLUMNS
from vidlens.session import materialize
from vidlens.sinks import tables, versioned
from vidlens.sources import fixtures, responses
from vidlens.streaming import live as stream

# ---- three medallion runs (L1, L2, D1, S2) -----------------------------------------

RUN_TIMES = ("2001-12-30 00:00:00", "2001-12-31 00:00:00", RUN_TS)


def run_inputs(videos):
    """What three runs land: first sightings; new videos with some seen before that moved to another keyword,
    changed or lost their views; and a few again."""
    moved = F.col("src_supp") % 4 == 0
    second = videos.where((F.col("src_part") % 3 == 2) | moved)
    second = (second.withColumn("keyword", F.when(moved, F.concat(F.lit("moved "), "keyword")).otherwise(F.col("keyword")))
              .withColumn("view_count", F.when(F.col("src_supp") % 8 == 0, F.lit(-1)).when(moved, F.col("view_count") + 1)
                          .otherwise(F.col("view_count"))))
    third = videos.where(F.col("src_part") % 5 == 0).withColumn("keyword", F.lit("Back Again")).withColumn("title", F.lit(" again "))
    return [videos.where(F.col("src_part") % 3 != 2), second, third]


RUNS_SQL = """runs AS (
  SELECT *, 0 AS run FROM videos WHERE src_part % 3 <> 2
  UNION ALL
  SELECT * REPLACE (CASE WHEN src_supp % 4 = 0 THEN 'moved ' || keyword ELSE keyword END AS keyword,
                    CASE WHEN src_supp % 8 = 0 THEN -1 WHEN src_supp % 4 = 0 THEN view_count + 1 ELSE view_count END AS view_count),
         1 AS run FROM videos WHERE src_part % 3 = 2 OR src_supp % 4 = 0
  UNION ALL
  SELECT * REPLACE ('Back Again' AS keyword, ' again ' AS title), 2 AS run FROM videos WHERE src_part % 5 = 0)"""
RUNS_SILVER_SQL = f"{RUNS_SQL},\nsilver AS ({O.silver_sql('run DESC, ' + E2E_ORDER_SQL, 'runs')})"
RUNS_OUT = ["video_id", "title", "keyword", "view_count", "like_count", "published_year", "performance_tier", "tag_count"]


def three_runs(spark, sf_dir) -> medallion.Layout:
    root = _scratch(spark, "runs")
    layout = medallion.Layout(root)
    for i, rows in enumerate(run_inputs(fixtures.videos(spark, sf_dir))):
        landing = f"{root}/landing/{i}"
        tables.landing_csv(rows.select(*schemas.CSV_SCHEMA.fieldNames()), landing)
        medallion.land_run(tables.read_video_csv(spark, landing, multi_line="parallel"), layout, f"run{i}", RUN_TIMES[i])
        versioned.remove(spark, landing)        # bronze holds all of it
        medallion.merge_silver(spark, layout, f"run{i}", etl_date=AS_OF, processed_at=RUN_TS)
    return layout


@register("medallion_three_runs", O.with_videos(f", {RUNS_SILVER_SQL}\nSELECT {_q(RUNS_OUT)} FROM silver"))
def q_medallion_three_runs(spark, sf_dir):
    """Silver after three incremental runs equals the survivors among all that landed."""
    layout = three_runs(spark, sf_dir)
    return tables.read_table(spark, layout.silver, medallion.SILVER_SCHEMA).select(*RUNS_OUT)


# ---- the run log (A12, Q1, S2) -------------------------------------------------------

LOGGED_CHECKS = ("video_id_present", "views_non_negative", "published_at_parses")


@register("run_log", O.with_videos(f""", {RUNS_SQL},
checked AS (SELECT run, count(*) AS n, {', '.join(f"count(*) FILTER (WHERE NOT ({_CHECKS_SQL[c]})) AS {c}" for c in LOGGED_CHECKS)}
  FROM runs GROUP BY run),
after1 AS ({O.silver_sql('run DESC, ' + E2E_ORDER_SQL, '(SELECT * FROM runs WHERE run = 0) r')}),
log AS (
  SELECT run, 'bronze' AS stage, 'rows' AS metric, false AS by_file, n AS value FROM checked
  UNION ALL SELECT run, 'bronze', 'rows', true, n FROM checked
  {' '.join(f"UNION ALL SELECT run, 'bronze', 'violations:{c}', false, {c} FROM checked" for c in LOGGED_CHECKS)}
  UNION ALL SELECT 0, 'silver', 'rows', false, count(*) FROM after1)
SELECT 'run' || CAST(run AS VARCHAR) AS run_id, stage, metric, by_file, CAST(value AS BIGINT) AS value,
       CAST(CASE run WHEN 0 THEN '{RUN_TIMES[0]}' WHEN 1 THEN '{RUN_TIMES[1]}' ELSE '{RUN_TIMES[2]}' END AS VARCHAR) AS ingested_at
FROM log"""))
def q_run_log(spark, sf_dir):
    """The log of the three runs, counts by file added up, with the ingest time that bronze holds for each run.
    Of silver, the first run's rows (later runs log what they rewrote)."""
    layout = three_runs(spark, sf_dir)
    log = medallion.read_run_log(spark, layout).where("stage = 'bronze' or run_id = 'run0'")
    summed = (log.withColumn("by_file", F.col("source_file").isNotNull()).groupBy("run_id", "stage", "metric", "by_file")
              .agg(F.sum("value").alias("value")))
    bronze = spark.read.parquet(layout.bronze)
    times = bronze.groupBy(F.col("run").alias("run_id")).agg(F.max("_ingested_at").cast("string").alias("ingested_at"))
    return summed.join(times, "run_id")


# ---- a schema that grows over runs (S3, S7) ------------------------------------------

@register("growing_schema", with_flagged("""
SELECT keyword, category_name, CAST(total_videos AS BIGINT) AS total_videos,
       CASE WHEN keyword LIKE '%cut' THEN outlier_video_count END AS outlier_video_count,
       CASE WHEN keyword LIKE '%cut' THEN 'second' END AS run_name
FROM summary""", ctes=(f"summary AS ({SUMMARY_SQL_BODY})",)))
def q_growing_schema(spark, sf_dir):
    """A first run with narrower counts and without two columns, then a wider one; both are read by the table's
    schema. A frame that would make a number a text is refused and leaves the table as it was."""
    path = _scratch(spark, "growing")
    summary = rollups.keyword_category_summary(flagged(spark, sf_dir)).select("keyword", "category_name", "total_videos", "outlier_video_count")
    cut = F.col("keyword").endswith("cut")
    first = summary.where(~cut).withColumn("total_videos", F.col("total_videos").cast("int")).drop("outlier_video_count")
    second = summary.where(cut).withColumn("run_name", F.lit("second"))
    tables.append_evolving(first, path, "keyword")
    tables.append_evolving(second, path, "keyword")
    try:
        tables.append_evolving(second.withColumn("total_videos", F.lit("many")), path, "keyword")
    except tables.SchemaConflict:
        pass
    return tables.read_evolving(spark, path).select("keyword", "category_name", "total_videos", "outlier_video_count", "run_name")


# ---- guards (P6) and repeated details (J1) -------------------------------------------

@register("no_match_guard", O.with_silver("""
SELECT keyword AS present, 'nowhere' AS wanted FROM (SELECT DISTINCT keyword FROM silver)
UNION ALL SELECT DISTINCT keyword, 'matched' FROM silver WHERE keyword = 'small'"""))
def q_no_match_guard(spark, sf_dir):
    """What the guard says is there where a filter matched nothing (the fixture has fewer keywords than the
    guard names), and the rows' keywords where it matched."""
    s = partitioned_silver(spark, sf_dir, ("keyword", "view_count"))
    matched = filters.read_gold_input(s, 0, "small").select(F.col("keyword").alias("present"), F.lit("matched").alias("wanted")).distinct()
    try:
        filters.read_gold_input(s, 0, "nowhere")
    except filters.NoKeywordMatch as e:
        rows = [(k, t) for k in e.present for t in e.terms]
        return spark.createDataFrame(rows, "present string, wanted string").unionByName(matched)
    return matched


_SECOND_CTES = tuple(c.replace("FROM videos ", "FROM videos2 ").replace("det AS", "det2 AS").replace("details AS", "details2 AS")
                     .replace("FROM det)", "FROM det2)") for c in DETAILS_CTES)


@register("repeated_details", O.with_videos(f"""
SELECT {_q(DETAIL_OUT)} FROM details2
UNION ALL SELECT {_q(DETAIL_OUT)} FROM details WHERE video_id NOT IN (SELECT video_id FROM details2)""", (
    "videos2 AS (SELECT * REPLACE (view_count + 5 AS view_count, 'SD' AS definition) FROM videos WHERE src_supp % 2 = 0)",
    *DETAILS_CTES, *_SECOND_CTES)))
def q_repeated_details(spark, sf_dir):
    """Details of some videos come again on later pages with other values; the last one seen wins. Both are written
    before they meet, so that the shuffles that made them are gone by then."""
    videos = fixtures.videos(spark, sf_dir)
    again = videos.where(F.col("src_supp") % 2 == 0).withColumn("view_count", F.col("view_count") + 5).withColumn("definition", F.lit("SD"))
    later = responses.detail_pages(again).withColumn("page", F.col("page") + 1_000_000)
    both = materialize(details(spark, sf_dir), "details").unionByName(materialize(responses.flatten_details(later), "later-details"))
    return harvest.latest_details(both).select(*DETAIL_OUT)


# ---- live analytics by increments (T4, W3) -------------------------------------------

@register("stream_incremental_windows", O.with_videos(f""", {WINDOWS_SQL}
SELECT {_q(LIVE_ANALYTICS_COLUMNS)} FROM staged"""))
def q_stream_incremental_windows(spark, sf_dir):
    """Messages arrive in two parts; a restart of the stream lands the second one. The analytics table is made
    after the first and takes the second in, then the landed batches are compacted and nothing is left to read."""
    root = _scratch(spark, "stream-steps")
    msgs = tables.to_messages(fixtures.video_messages(spark, sf_dir)).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(2)))
    layout = stream.LiveLayout(out=f"{root}/out", checkpoints=f"{root}/checkpoints")
    # Both parts are made in one pass; each arrives by a rename when its turn comes.
    tables.land_messages(msgs, f"{root}/made", by="part")
    for part in (0, 1):
        versioned.move_files(spark, f"{root}/made/part={part}", f"{root}/messages")
        stream.await_all(stream.start_live(stream.file_source(spark, f"{root}/messages", None), layout, PRIMARY_KEYWORD, trigger=None, as_of=AS_OF))
        versioned.remove(spark, f"{root}/messages")     # all three queries have taken all of it in
        stream.refresh_analytics(spark, layout, AS_OF)
    stream.compact(spark, layout, at_least=1)
    stream.refresh_analytics(spark, layout, AS_OF)
    return stream.read_analytics(spark, layout)


# ---- states that add up over runs (A7-A10) -------------------------------------------

MOMENT_COLUMNS = ["view_count", "like_count", "comment_count", "engagement_rate", "duration_seconds"]


@register("merged_moments", O.with_silver(f"""
SELECT count(*) AS n, {', '.join(f"{O.rnd(f'avg({c})', 4)} AS mean_{c}, {O.rnd(f'stddev_samp({c})', 4)} AS stddev_{c}" for c in MOMENT_COLUMNS)},
       {_corr_sql('view_count', 'engagement_rate')} AS corr_views_engagement,
       {_corr_sql('like_count', 'comment_count')} AS corr_likes_comments,
       {_corr_sql('duration_seconds', 'view_count')} AS corr_duration_views
FROM silver"""))
def q_merged_moments(spark, sf_dir):
    """One state for each publish month, stored; the whole table's figures from these alone."""
    path = _scratch(spark, "moments")
    by_month = ["published_year", "published_month"]
    moments.state(silver_table(spark, sf_dir, MOMENT_COLUMNS + by_month), MOMENT_COLUMNS, by_month).write.parquet(path)
    m = moments.merge(spark.read.parquet(path), MOMENT_COLUMNS)
    figures = [x for c in MOMENT_COLUMNS for x in (F.round(moments.mean(c), 4).alias(f"mean_{c}"), F.round(moments.stddev_samp(c), 4).alias(f"stddev_{c}"))]
    return m.select("n", *figures,
                    F.round(moments.corr("view_count", "engagement_rate"), 6).alias("corr_views_engagement"),
                    F.round(moments.corr("like_count", "comment_count"), 6).alias("corr_likes_comments"),
                    F.round(moments.corr("view_count", "duration_seconds"), 6).alias("corr_duration_views"))


@register("quantile_sketches", O.with_silver("""
, spans AS (SELECT keyword, view_count, 'all' AS span FROM silver
  UNION ALL SELECT keyword, view_count, 'from 1995' FROM silver WHERE published_year >= 1995)
SELECT span, keyword, p, n, true AS inside FROM (
  SELECT span, keyword, count(*) AS n FROM spans GROUP BY span, keyword) CROSS JOIN (VALUES (0.25::DOUBLE), (0.5), (0.75)) t(p)
""".replace("\n, spans", ", spans", 1)))
def q_quantile_sketches(spark, sf_dir):
    """Sketches stored by keyword and publish day; quartiles by keyword of all days and of a later span come from
    them, and the exact ranks of these answers lie inside the stated error."""
    path = _scratch(spark, "sketches")
    silver = silver_table(spark, sf_dir, ["keyword", "view_count", "published_year", "published_at_ts"])
    rows = silver.select("keyword", "view_count", "published_year", F.to_date("published_at_ts").alias("day"))
    tables.overwrite(sketches.sketch(rows, "view_count", ["keyword", "published_year", "day"]), path, ["published_year"])
    stored = tables.read_table(spark, path)
    out = None
    for span, keep in (("all", F.lit(True)), ("from 1995", F.col("published_year") >= 1995)):
        answers = sketches.quantiles(sketches.merged(stored.where(keep), ["keyword"]), [0.25, 0.5, 0.75], ["keyword"])
        certified = sketches.certify(answers, rows.where(keep), "view_count", ["keyword"]).select(
            F.lit(span).alias("span"), "keyword", "p", "n", "inside")
        out = certified if out is None else out.unionByName(certified)
    return out
