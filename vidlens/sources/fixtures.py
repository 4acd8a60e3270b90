"""Video records derived from the shared test tables.

The repository's operators work on video records; the shared test data is a
TPC-H-like star schema. ``videos`` maps one ``lineitem`` row (joined to its
``part`` and ``supplier``) to one raw 19-column video record, dirty on
purpose so that every cleaning rule fires. The same mapping is written in SQL
for the DuckDB oracle (``vidlens.plans.oracle.VIDEOS_SQL``).

At scale this is a fact-to-dimension join: ``supplier`` is small and is
broadcast by the planner from its measured size; ``part`` grows with the data
and is joined by shuffle unless AQE measures it under the broadcast limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlens.schemas import CSV_SCHEMA, MESSAGE_FIELDS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw video records (CSV schema + ``src_part``, ``src_supp`` order keys)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(supp, li.l_suppkey == supp.s_suppkey))

    q = F.col("l_quantity")
    pk4 = F.col("l_partkey") % 4
    ptype = F.col("p_type")
    ln3 = F.col("l_linenumber") % 3
    tags = (F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string"))
             .when(F.col("l_linenumber") == 2, F.lit(""))
             .otherwise(F.concat(ptype, F.lit("|"), F.col("p_brand"))))
    cols = {
        "video_id": F.when(F.col("l_partkey") % 97 == 0, F.lit(""))
                     .otherwise(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                                         F.col("l_linenumber").cast("string"))),
        "title": F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")),
        "channel": F.col("s_name"),
        "published_at": F.when(F.col("l_suppkey") % 50 == 0, F.lit("bad"))
                         .otherwise(F.col("l_shipdate").cast("string")),
        "keyword": (F.when(pk4 == 0, F.upper(ptype))
                     .when(pk4 == 1, F.concat(F.lit("  "), F.lower(ptype), F.lit(" ")))
                     .when(pk4 == 2, F.concat(F.lower(ptype), F.lit("’s cut")))
                     .otherwise(F.concat(F.lower(ptype), F.lit("'s cut")))),
        "platform": F.col("l_returnflag"),
        "view_count": (F.when(q == 7, F.lit(None).cast("long"))
                        .when(q == 13, F.lit(-1).cast("long"))
                        .otherwise(F.floor(F.col("l_extendedprice") * q).cast("long"))),
        "like_count": F.when(q == 9, F.lit(None).cast("long"))
                       .otherwise(F.floor(F.col("l_extendedprice") / 10).cast("long")),
        "comment_count": (F.col("l_suppkey") % 20).cast("long"),
        "description": F.lit(None).cast("string"),
        "duration_seconds": F.floor(q * 4).cast("int"),
        "duration_category": F.when(q <= 15, "short").when(q <= 30, "medium").otherwise("long"),
        "category_id": F.col("p_size").cast("string"),
        "category_name": F.when(F.col("l_partkey") % 11 == 0, F.lit(None).cast("string"))
                          .otherwise(F.col("p_brand")),
        "tags": tags,
        "tag_count": F.when(tags.isNull(), F.lit(None).cast("int"))
                      .when(tags == "", F.lit(0))
                      .otherwise((F.length(tags) - F.length(F.replace(tags, F.lit("|"), F.lit(""))) + 1)
                                 .cast("int")),
        "has_captions": F.when(ln3 == 0, "true").when(ln3 == 1, "no").otherwise("maybe"),
        "definition": F.col("l_linestatus"),
        "licensed_content": F.when(F.col("l_returnflag") == "A", "TRUE").otherwise("false"),
    }
    out = [cols[f.name].cast(f.dataType).alias(f.name) for f in CSV_SCHEMA.fields]
    out += [F.col("l_partkey").alias("src_part"), F.col("l_suppkey").alias("src_supp")]
    return j.select(*out)


# Deterministic dedup order for the fixture (a total order on it):
# newest publish time first, then the source keys and two measures.
VIDEOS_DEDUP_ORDER = (
    ("published_at_ts", False), ("src_part", True), ("src_supp", True),
    ("view_count", True), ("duration_seconds", True), ("published_at", True),
)


def video_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records renamed to the 24-field live message layout."""
    v = videos(spark, sf_dir)
    return v.select(
        F.col("video_id"),
        F.col("keyword"),
        F.lit("General").alias("keyword_type"),
        F.col("title"),
        F.col("channel").alias("channelTitle"),
        F.col("description"),
        F.col("published_at").alias("publishedAt"),
        F.col("view_count").alias("viewCount"),
        F.col("like_count").alias("likeCount"),
        F.col("comment_count").alias("commentCount"),
        F.col("duration_seconds"),
        F.lit("2d").alias("dimension"),
        F.col("definition"),
        F.col("has_captions").alias("caption"),
        (F.col("licensed_content") == "TRUE").alias("licensedContent"),
        F.lit("rectangular").alias("projection"),
        F.col("category_id").alias("categoryId"),
        F.col("tags"),
        F.col("platform").alias("defaultAudioLanguage"),
        F.lit("processed").alias("uploadStatus"),
        F.lit("public").alias("privacyStatus"),
        F.lit(False).alias("madeForKids"),
        F.lit(True).alias("embeddable"),
        F.col("category_name").alias("topicCategories"),
    ).select(*MESSAGE_FIELDS)
