"""Registered queries of the producer's data work: S16, S17, D2, D3, J1."""

from __future__ import annotations

from vidlens.operators import harvest
from vidlens.plans import oracle as O
from vidlens.plans.registry import PRIMARY_KEYWORD, register
from vidlens.schemas import MESSAGE_FIELDS
from vidlens.session import materialize
from vidlens.sources import fixtures, responses

CAP = harvest.MAX_VIDEOS_PER_KEYWORD

_ITEM_ORDERS = {
    0: "src_supp ASC NULLS LAST, src_part ASC NULLS LAST, video_id ASC NULLS LAST, "
       "published_at ASC NULLS LAST, title ASC NULLS LAST",
    1: "view_count DESC NULLS LAST, video_id ASC NULLS LAST, src_part ASC NULLS LAST, "
       "src_supp ASC NULLS LAST, published_at ASC NULLS LAST, title ASC NULLS LAST",
    2: "published_at DESC NULLS LAST, video_id ASC NULLS LAST, src_part ASC NULLS LAST, "
       "src_supp ASC NULLS LAST, title ASC NULLS LAST",
}

ITEMS_CTES = (
    "kwc AS (SELECT keyword, count(*) AS _kn FROM videos GROUP BY keyword)",
    "base AS (SELECT v.*, greatest(1, CAST(ceil(_kn / 50) AS BIGINT)) AS _np FROM videos v JOIN kwc USING (keyword))",
    "items AS (" + " UNION ALL ".join(
        f"SELECT keyword, {o} AS order_idx, page, "
        f"CAST(row_number() OVER (PARTITION BY keyword, page ORDER BY {order}) - 1 AS INTEGER) AS pos, "
        f"video_id, title, channel AS \"channelTitle\", description, published_at AS \"publishedAt\" "
        f"FROM (SELECT *, (src_part * 7 + src_supp * 13 + COALESCE(duration_seconds, 0) + {o}) % _np AS page "
        f"FROM base)"
        for o, order in _ITEM_ORDERS.items()) + ")",
    "seen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY keyword, video_id "
    "ORDER BY order_idx, page, pos) AS _rn FROM items WHERE video_id IS NOT NULL AND video_id <> '') WHERE _rn = 1)",
    f"capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY keyword "
    f"ORDER BY order_idx, page, pos) AS _rc FROM seen) WHERE _rc <= {CAP})",
)

DETAILS_CTES = (
    "det AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY src_part ASC NULLS LAST, "
    "src_supp ASC NULLS LAST, view_count ASC NULLS LAST, duration_seconds ASC NULLS LAST, "
    "published_at ASC NULLS LAST) AS _rn FROM videos WHERE video_id IS NOT NULL AND video_id <> '') "
    "WHERE _rn = 1 AND src_part % 13 <> 0)",
    """details AS (SELECT video_id,
       CASE WHEN src_supp % 7 = 0 THEN 0 ELSE COALESCE(view_count, 0) END AS "viewCount",
       CASE WHEN src_supp % 7 = 0 THEN 0 ELSE COALESCE(like_count, 0) END AS "likeCount",
       CASE WHEN src_supp % 7 = 0 THEN 0 ELSE COALESCE(comment_count, 0) END AS "commentCount",
       COALESCE(duration_seconds, 0) AS duration_seconds,
       '2d' AS dimension, definition, has_captions AS caption, licensed_content = 'TRUE' AS "licensedContent",
       'rectangular' AS projection, category_id AS "categoryId",
       CASE WHEN src_supp % 7 = 1 OR tags IS NULL THEN '' ELSE tags END AS tags,
       platform AS "defaultAudioLanguage",
       CASE WHEN src_supp % 7 = 0 THEN NULL ELSE 'processed' END AS "uploadStatus",
       CASE WHEN src_supp % 7 = 0 THEN NULL ELSE 'public' END AS "privacyStatus",
       CASE WHEN src_supp % 7 = 0 THEN false ELSE src_part % 2 = 0 END AS "madeForKids",
       CASE WHEN src_supp % 7 = 0 THEN true ELSE src_supp % 3 <> 0 END AS embeddable,
       CASE WHEN src_supp % 7 = 1 OR category_name IS NULL THEN '' ELSE category_name END AS "topicCategories"
     FROM det)""",
)

DETAIL_OUT = [f for f in MESSAGE_FIELDS if f not in
              ("keyword", "keyword_type", "title", "channelTitle", "description", "publishedAt")]
ITEM_OUT = ["keyword", "order_idx", "page", "pos", "video_id", "title", "channelTitle", "description", "publishedAt"]
SEEN_OUT = ["keyword", "video_id", "order_idx", "page", "pos"]


def _q(cols):
    return ", ".join(f'"{c}"' for c in cols)


def items(spark, sf_dir):
    return responses.flatten_search(responses.search_pages(fixtures.videos(spark, sf_dir)))


def details(spark, sf_dir):
    return responses.flatten_details(responses.detail_pages(fixtures.videos(spark, sf_dir)))


@register("flatten_responses", O.with_videos(f"SELECT {_q(ITEM_OUT)} FROM items", ITEMS_CTES[:3]))
def q_flatten_responses(spark, sf_dir):
    return items(spark, sf_dir).select(*ITEM_OUT)


@register("flatten_details", O.with_videos(f"SELECT {_q(DETAIL_OUT)} FROM details", DETAILS_CTES))
def q_flatten_details(spark, sf_dir):
    return details(spark, sf_dir).select(*DETAIL_OUT)


@register("first_seen_dedup", O.with_videos(f"SELECT {_q(SEEN_OUT)} FROM seen", ITEMS_CTES[:4]))
def q_first_seen_dedup(spark, sf_dir):
    return harvest.first_seen(items(spark, sf_dir)).select(*SEEN_OUT)


@register("per_keyword_cap", O.with_videos(f"SELECT {_q(SEEN_OUT)} FROM capped", ITEMS_CTES))
def q_per_keyword_cap(spark, sf_dir):
    return harvest.cap_per_keyword(harvest.first_seen(items(spark, sf_dir))).select(*SEEN_OUT)


@register("enrich_left_join", O.with_videos(f"""
SELECT c.video_id, c.keyword, CASE WHEN c.keyword = '{PRIMARY_KEYWORD}' THEN 'Primary' ELSE 'General' END AS keyword_type,
       c.title, c."channelTitle", c.description, c."publishedAt", {', '.join('d."' + f + '"' for f in DETAIL_OUT[1:])}
FROM seen c LEFT JOIN details d USING (video_id)""", ITEMS_CTES + DETAILS_CTES))
def q_enrich_left_join(spark, sf_dir):
    """J1 over every first-seen record; the cap is a feature of its own (``per_keyword_cap``). Records and details are
    written before they meet, so that the shuffles that made them are gone by then."""
    seen = harvest.first_seen(items(spark, sf_dir)).drop(*[c for c, _ in harvest.ARRIVAL])
    return harvest.enrich(materialize(seen, "first-seen"), materialize(details(spark, sf_dir), "details"), PRIMARY_KEYWORD)
