"""DuckDB twins of the registered queries (the correctness oracle).

Each query is plain SQL over the shared test tables. Common building blocks
are CTE texts composed here. Two engine gaps are bridged explicitly:

* rounding: Spark rounds the decimal text of a double half-up, DuckDB the
  binary value, so ``rnd`` rounds the text form in DuckDB too;
* NULL order: DuckDB and Spark default differently, so every ORDER BY names it.
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    """Spark's ``round(double, n)`` in DuckDB."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def ravg(col: str, n: int) -> str:
    """``vidlens.operators.rollups.fixed_avg`` in DuckDB: exact average, half-up."""
    return rnd(f"avg(CAST({col} AS DECIMAL(38,12)))", n)


# The fixture view: one lineitem row (with its part and supplier) -> one raw video.
VIDEOS_SQL = """
SELECT
  CASE WHEN l_partkey % 97 = 0 THEN ''
       ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS video_id,
  ' ' || p_name || ' ' AS title,
  s_name AS channel,
  CASE WHEN l_suppkey % 50 = 0 THEN 'bad' ELSE CAST(l_shipdate AS VARCHAR) END AS published_at,
  CASE l_partkey % 4 WHEN 0 THEN upper(p_type)
                     WHEN 1 THEN '  ' || lower(p_type) || ' '
                     WHEN 2 THEN lower(p_type) || '’s cut'
                     ELSE lower(p_type) || '''s cut' END AS keyword,
  l_returnflag AS platform,
  CASE WHEN l_quantity = 7 THEN NULL WHEN l_quantity = 13 THEN CAST(-1 AS BIGINT)
       ELSE CAST(floor(l_extendedprice * l_quantity) AS BIGINT) END AS view_count,
  CASE WHEN l_quantity = 9 THEN NULL ELSE CAST(floor(l_extendedprice / 10) AS BIGINT) END AS like_count,
  CAST(l_suppkey % 20 AS BIGINT) AS comment_count,
  CAST(NULL AS VARCHAR) AS description,
  CAST(floor(l_quantity * 4) AS INTEGER) AS duration_seconds,
  CASE WHEN l_quantity <= 15 THEN 'short' WHEN l_quantity <= 30 THEN 'medium' ELSE 'long' END AS duration_category,
  CAST(p_size AS VARCHAR) AS category_id,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE p_brand END AS category_name,
  CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN '' ELSE p_type || '|' || p_brand END AS tags,
  CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 0 ELSE 2 END AS tag_count,
  CASE l_linenumber % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'no' ELSE 'maybe' END AS has_captions,
  l_linestatus AS definition,
  CASE WHEN l_returnflag = 'A' THEN 'TRUE' ELSE 'false' END AS licensed_content,
  l_partkey AS src_part,
  l_suppkey AS src_supp
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
"""

# Fixture dedup order (vidlens.sources.fixtures.VIDEOS_DEDUP_ORDER) as SQL.
DEDUP_ORDER_SQL = ("published_at_ts DESC NULLS LAST, src_part ASC NULLS LAST, src_supp ASC NULLS LAST, "
                   "view_count ASC NULLS LAST, duration_seconds ASC NULLS LAST, published_at ASC NULLS LAST")

# Silver rows, audit columns left out (they carry the run clock).
_SILVER_TEMPLATE = """
SELECT video_id, title, channel, published_at, keyword, platform, view_count, like_count,
       comment_count, description, duration_seconds, duration_category, category_id,
       category_name, tags, tag_count, has_captions, definition, licensed_content,
       src_part, src_supp, published_at_ts, published_year, published_month,
       CASE WHEN view_count > 0 THEN {ENG}
            ELSE 0.0 END AS engagement_rate,
       {LCR}
            AS like_to_comment_ratio,
       CASE WHEN view_count >= 1000000 THEN 'Viral' WHEN view_count >= 100000 THEN 'High'
            WHEN view_count >= 10000 THEN 'Medium' ELSE 'Low' END AS performance_tier
FROM (
  SELECT video_id, trim(title) AS title, trim(channel) AS channel, published_at,
         NULLIF(regexp_replace(lower(trim(keyword)), '[‘’ʼ`]', '''', 'g'), '') AS keyword,
         platform,
         COALESCE(view_count, 0) AS view_count, COALESCE(like_count, 0) AS like_count,
         COALESCE(comment_count, 0) AS comment_count, description,
         COALESCE(duration_seconds, 0) AS duration_seconds, duration_category, category_id,
         COALESCE(category_name, 'Unknown') AS category_name, tags,
         COALESCE(tag_count, 0) AS tag_count,
         TRY_CAST(has_captions AS BOOLEAN) AS has_captions, definition,
         TRY_CAST(licensed_content AS BOOLEAN) AS licensed_content,
         src_part, src_supp, published_at_ts,
         CAST(year(published_at_ts) AS INTEGER) AS published_year,
         CAST(month(published_at_ts) AS INTEGER) AS published_month
  FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY {ORDER}) AS _rn
    FROM (SELECT *, TRY_CAST(published_at AS TIMESTAMP) AS published_at_ts FROM {SOURCE}
          WHERE video_id IS NOT NULL AND trim(video_id) <> '') v1
  ) v2
  WHERE _rn = 1
) v3
WHERE view_count >= 0
"""


def silver_sql(order: str = DEDUP_ORDER_SQL, source: str = "videos") -> str:
    return (_SILVER_TEMPLATE
            .replace("{ENG}", rnd("(like_count + comment_count) / view_count", 6))
            .replace("{LCR}", rnd("CASE WHEN comment_count = 0 THEN NULL ELSE like_count / comment_count END", 2))
            .replace("{ORDER}", order).replace("{SOURCE}", source))


SILVER_SQL = silver_sql()


def with_silver(body: str, order: str = DEDUP_ORDER_SQL, ctes: tuple[str, ...] = ()) -> str:
    """``WITH videos AS (...), silver AS (...)[, more CTEs] <body>``."""
    more = "".join(f",\n{c.strip()}" for c in ctes)
    return f"WITH videos AS ({VIDEOS_SQL}),\nsilver AS ({silver_sql(order)}){more}\n{body}"


def with_videos(body: str, ctes: tuple[str, ...] = ()) -> str:
    more = "".join(f",\n{c.strip()}" for c in ctes)
    return f"WITH videos AS ({VIDEOS_SQL}){more}\n{body}"
