"""Independent SQL (DuckDB dialect) for every registered query.

Written from the operator semantics, not generated from the Spark plans, over
the same ``lineitem`` table.  Conventions that make both engines agree:
``x / NULLIF(y, 0)`` for NULL-on-zero division; integer sums cast to BIGINT;
``||`` (NULL-propagating) for concatenation; explicit DOUBLE multipliers.
"""

from __future__ import annotations

_QTY = "CAST(l_quantity AS BIGINT)"
_CENTS = "ROUND(l_extendedprice * 100)"
_COMMON = f"""CAST(l_shipdate AS DATE) AS date,
      'c' || CAST(l_linenumber AS VARCHAR) AS campaign_id,
      'Camp_' || CAST(l_linenumber AS VARCHAR) AS campaign_name,
      {_QTY} * 1000 AS impressions,
      l_partkey % 1000 AS clicks"""

NULL_D = "CAST(NULL AS DOUBLE)"


def exact_mean(x: str) -> str:
    """Mean of doubles, summed as whole numbers of 2**-20 and of 2**-80."""
    scaled = f"(({x}) * 1048576)"
    high = f"SUM(CAST(FLOOR({scaled}) AS HUGEINT))"
    low = f"SUM(CAST(FLOOR(({scaled} - FLOOR({scaled})) * 1152921504606846976) AS HUGEINT))"
    unit = "CAST(1152921504606846976 AS HUGEINT)"
    return (
        f"((CAST({high} + {low} // {unit} AS DOUBLE) / 1048576 + CAST({low} % {unit} AS DOUBLE) / pow(2, 80)) / COUNT({x}))"
    )

BASE = f"""
fb_raw AS (
  SELECT {_COMMON}, {_CENTS} AS spend, l_suppkey % 10 AS conversions, {_QTY} * 100 AS video_views,
         's' || CAST(l_suppkey % 7 AS VARCHAR) AS ad_set_id, 'Set_' || CAST(l_suppkey % 7 AS VARCHAR) AS ad_set_name,
         ROUND(l_discount, 2) AS engagement_rate, {_QTY} * 700 AS reach, ROUND(l_tax, 2) AS frequency
  FROM lineitem WHERE l_returnflag = 'A'
),
g_raw AS (
  SELECT {_COMMON}, {_CENTS} AS cost, l_suppkey % 10 AS conversions,
         {_CENTS} * (l_suppkey % 7) AS conversion_value,
         ROUND(l_discount, 2) AS ctr, ROUND(l_tax, 2) AS avg_cpc,
         'g' || CAST(l_suppkey % 7 AS VARCHAR) AS ad_group_id, 'Group_' || CAST(l_suppkey % 7 AS VARCHAR) AS ad_group_name,
         l_suppkey % 10 + 1 AS quality_score, ROUND(l_discount, 2) AS search_impression_share,
         (l_orderkey + l_linenumber) % 20 AS kind
  FROM lineitem WHERE l_returnflag = 'N'
),
tt_raw AS (
  SELECT {_COMMON}, {_CENTS} AS cost, l_suppkey % 10 AS conversions, {_QTY} * 100 AS video_views,
         {_QTY} * 80 AS video_watch_25, {_QTY} * 60 AS video_watch_50, {_QTY} * 40 AS video_watch_75,
         {_QTY} * (l_suppkey % 30) AS video_watch_100,
         l_orderkey % 50 AS likes, l_partkey % 20 AS shares, l_suppkey % 5 AS comments,
         't' || CAST(l_suppkey % 7 AS VARCHAR) AS adgroup_id, 'Adgroup_' || CAST(l_suppkey % 7 AS VARCHAR) AS adgroup_name
  FROM lineitem WHERE l_returnflag = 'R'
),
fb AS (
  SELECT date, campaign_id, campaign_name, 'Facebook' AS platform, impressions, clicks,
         CAST(spend AS DOUBLE) AS spend, conversions, CAST(video_views AS DOUBLE) AS video_views,
         clicks / NULLIF(impressions, 0) AS ctr, spend / NULLIF(clicks, 0) AS cpc,
         spend / NULLIF(conversions, 0) AS cpa, {NULL_D} AS roas, CAST(0 AS DOUBLE) AS social_eng,
         {NULL_D} AS vid_compl_rate, {NULL_D} AS conv_value
  FROM fb_raw
),
g AS (
  SELECT date, campaign_id, campaign_name, 'Google' AS platform, impressions, clicks,
         CAST(cost AS DOUBLE) AS spend, conversions, CAST(0 AS DOUBLE) AS video_views,
         CAST(ctr AS DOUBLE) AS ctr, CAST(avg_cpc AS DOUBLE) AS cpc,
         cost / NULLIF(conversions, 0) AS cpa, conversion_value / NULLIF(cost, 0) AS roas,
         CAST(0 AS DOUBLE) AS social_eng, {NULL_D} AS vid_compl_rate,
         CAST(conversion_value AS DOUBLE) AS conv_value
  FROM g_raw
),
tt AS (
  SELECT date, campaign_id, campaign_name, 'TikTok' AS platform, impressions, clicks,
         CAST(cost AS DOUBLE) AS spend, conversions, CAST(video_views AS DOUBLE) AS video_views,
         clicks / NULLIF(impressions, 0) AS ctr, cost / NULLIF(clicks, 0) AS cpc,
         cost / NULLIF(conversions, 0) AS cpa, {NULL_D} AS roas,
         CAST(likes + shares + comments AS DOUBLE) AS social_eng,
         video_watch_100 / NULLIF(video_views, 0) AS vid_compl_rate, {NULL_D} AS conv_value
  FROM tt_raw
),
fact AS (SELECT * FROM fb UNION ALL SELECT * FROM g UNION ALL SELECT * FROM tt),
daily AS (
  SELECT date, platform, COALESCE(SUM(spend), 0) AS spend,
         CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS conversions,
         CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions,
         CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS clicks
  FROM fact GROUP BY date, platform
),
series AS (
  SELECT *, AVG(spend) OVER (PARTITION BY platform ORDER BY date
                             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS spend_7d_avg
  FROM daily
),
plat AS (
  SELECT platform,
         CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions,
         CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS clicks,
         COALESCE(SUM(spend), 0) AS spend,
         CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS conversions,
         COALESCE(SUM(video_views), 0) AS video_views,
         COALESCE(SUM(social_eng), 0) AS social_eng,
         COALESCE(SUM(conv_value), 0) AS conv_value
  FROM fact GROUP BY platform
),
plat_r AS (
  SELECT *, clicks / NULLIF(impressions, 0) AS ctr, spend / NULLIF(clicks, 0) AS cpc,
         spend / NULLIF(conversions, 0) AS cpa
  FROM plat
),
camp AS (
  SELECT platform, campaign_name,
         CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions,
         CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS clicks,
         COALESCE(SUM(spend), 0) AS spend,
         CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS conversions,
         COALESCE(SUM(conv_value), 0) AS conv_value
  FROM fact GROUP BY platform, campaign_name
),
camp_r AS (
  SELECT *, clicks / NULLIF(impressions, 0) AS ctr, spend / NULLIF(conversions, 0) AS cpa,
         conv_value / NULLIF(spend, 0) AS roas
  FROM camp
),
camp_k AS (
  SELECT *, CASE WHEN conversions = 0 AND spend > 0 THEN CAST('Infinity' AS DOUBLE) ELSE cpa END AS cpa_key
  FROM camp_r
),
funnel AS (
  SELECT CAST(COALESCE(SUM(video_views), 0) AS BIGINT) AS views_total,
         CAST(COALESCE(SUM(video_watch_25), 0) AS BIGINT) AS w25,
         CAST(COALESCE(SUM(video_watch_50), 0) AS BIGINT) AS w50,
         CAST(COALESCE(SUM(video_watch_75), 0) AS BIGINT) AS w75,
         CAST(COALESCE(SUM(video_watch_100), 0) AS BIGINT) AS w100,
         CAST(COALESCE(SUM(likes), 0) AS BIGINT) AS likes,
         CAST(COALESCE(SUM(shares), 0) AS BIGINT) AS shares,
         CAST(COALESCE(SUM(comments), 0) AS BIGINT) AS comments
  FROM tt_raw
),
kpis AS (
  SELECT COALESCE(SUM(spend), 0) AS total_spend,
         CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS total_conversions,
         CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS total_impressions,
         CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS total_clicks,
         COALESCE(SUM(spend) / NULLIF(SUM(conversions), 0), 0) AS portfolio_cpa,
         COALESCE(SUM(clicks) / NULLIF(SUM(impressions), 0) * CAST(100 AS DOUBLE), 0) AS portfolio_ctr_pct,
         COALESCE(SUM(spend) / NULLIF(SUM(clicks), 0), 0) AS portfolio_cpc
  FROM fact
),
g_camp AS (
  SELECT campaign_name, COALESCE(SUM(spend), 0) AS spend, COALESCE(SUM(conv_value), 0) AS conv_value
  FROM fact WHERE platform = 'Google' GROUP BY campaign_name
),
roas_kpi AS (
  SELECT COALESCE({exact_mean("conv_value / NULLIF(spend, 0)")}, 0) AS mean_campaign_roas,
         SUM(conv_value) / NULLIF(SUM(spend), 0) AS pooled_roas
  FROM g_camp
)"""

WEB = """,
web AS (
  SELECT CAST(ts AS DATE) AS date, event_type AS campaign_id, 'Web_' || event_type AS campaign_name,
         'Web' AS platform, CAST(event_type = 'view' AS BIGINT) AS impressions,
         CAST(event_type = 'click' AS BIGINT) AS clicks, ROUND(value * 100) AS spend,
         CAST(event_type = 'purchase' AS BIGINT) AS conversions, CAST(0 AS DOUBLE) AS video_views,
         CAST(event_type = 'click' AS BIGINT) / NULLIF(CAST(event_type = 'view' AS BIGINT), 0) AS ctr,
         ROUND(value * 100) / NULLIF(CAST(event_type = 'click' AS BIGINT), 0) AS cpc,
         ROUND(value * 100) / NULLIF(CAST(event_type = 'purchase' AS BIGINT), 0) AS cpa,
         CAST(NULL AS DOUBLE) AS roas, CAST(0 AS DOUBLE) AS social_eng,
         CAST(NULL AS DOUBLE) AS vid_compl_rate, CAST(NULL AS DOUBLE) AS conv_value
  FROM events
),
fact4 AS (SELECT * FROM fact UNION ALL SELECT * FROM web)"""

SEL = """platform IN ('Google', 'TikTok')"""
DATES = """date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""
CAMPS = """campaign_name IN ('Camp_1', 'Camp_3')"""
CAMP_COLS = "platform, campaign_name, impressions, clicks, spend, conversions, conv_value, ctr, cpa, roas"
PCT = "CAST(100 AS DOUBLE)"


GOOGLE_ROAS = "CASE WHEN platform = 'Google' THEN conv_value / NULLIF(spend, 0) END"

FILTERED = f""",
fcamp AS (
  SELECT platform, campaign_name,
         CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions,
         CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS clicks,
         COALESCE(SUM(spend), 0) AS spend,
         CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS conversions,
         COALESCE(SUM(conv_value), 0) AS conv_value
  FROM fact WHERE {SEL} AND {DATES} AND {CAMPS} GROUP BY platform, campaign_name
)"""


def _q(body: str, extra: str = "") -> str:
    return f"WITH {BASE}{extra}\n{body}"


def _rank_order(key: str, desc: bool = False) -> str:
    d = "DESC" if desc else "ASC"
    return f"{key} {d} NULLS LAST, platform ASC NULLS LAST, campaign_name ASC NULLS LAST"


ORACLE: dict[str, str] = {
    # scan / conform / union
    "scan_feed": _q("SELECT * EXCLUDE (kind), FALSE AS bad_row FROM g_raw"),
    "scan_search": _q("SELECT * EXCLUDE (kind), FALSE AS bad_row FROM g_raw"),
    "scan_social": _q("SELECT *, FALSE AS bad_row FROM fb_raw"),
    "scan_video": _q("SELECT *, FALSE AS bad_row FROM tt_raw"),
    "csv_platform_rollup": _q("SELECT * FROM plat_r"),
    "rejected_rows": _q(
        "SELECT CASE WHEN kind <> 4 THEN date END AS date, campaign_id, campaign_name, ad_group_id, ad_group_name, "
        "impressions, clicks, CASE WHEN kind <> 3 THEN cost END AS cost, "
        "CASE WHEN kind <> 2 THEN conversions END AS conversions, conversion_value, "
        "CASE WHEN kind <> 0 THEN ctr END AS ctr, CASE WHEN kind <> 0 THEN avg_cpc END AS avg_cpc, "
        "CASE WHEN kind <> 0 THEN quality_score END AS quality_score, "
        "CASE WHEN kind <> 0 THEN search_impression_share END AS search_impression_share, "
        "kind <= 1 AS wrong_cell_count, "
        "CASE kind WHEN 2 THEN 'conversions' WHEN 3 THEN 'cost' WHEN 4 THEN 'date' ELSE '' END AS bad_columns "
        "FROM g_raw WHERE kind <= 4"
    ),
    "scan_mixed_headers": _q("SELECT * EXCLUDE (kind), FALSE AS bad_row FROM g_raw"),
    "feed_quality": _q(
        "SELECT 'google' AS feed, COUNT(*) AS rows_read, COUNT(*) FILTER (kind > 4) AS rows_kept, "
        "COUNT(*) FILTER (kind <= 4) AS rows_flagged, COUNT(*) FILTER (kind <= 1) AS wrong_cell_count, "
        "COUNT(*) FILTER (kind BETWEEN 2 AND 4) AS bad_cells, "
        "(SELECT COALESCE(STRING_AGG(c || ':' || n, ',' ORDER BY c), '') FROM (SELECT "
        "CASE kind WHEN 2 THEN 'conversions' WHEN 3 THEN 'cost' ELSE 'date' END AS c, COUNT(*) AS n "
        "FROM g_raw WHERE kind BETWEEN 2 AND 4 GROUP BY kind) AS b) AS bad_columns FROM g_raw "
        "UNION ALL SELECT 'facebook', COUNT(*), COUNT(*), 0, 0, 0, '' FROM fb_raw "
        "UNION ALL SELECT 'tiktok', COUNT(*), COUNT(*), 0, 0, 0, '' FROM tt_raw"
    ),
    "conform_social": _q("SELECT * FROM fb"),
    "conform_search": _q("SELECT * FROM g"),
    "conform_video": _q("SELECT * FROM tt"),
    "unified_fact": _q("SELECT * FROM fact"),
    "platform_rollup_with_web": _q(
        "SELECT *, clicks / NULLIF(impressions, 0) AS ctr, spend / NULLIF(clicks, 0) AS cpc, "
        "spend / NULLIF(conversions, 0) AS cpa FROM (SELECT platform, "
        "CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions, "
        "CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS clicks, COALESCE(SUM(spend), 0) AS spend, "
        "CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS conversions, "
        "COALESCE(SUM(video_views), 0) AS video_views, COALESCE(SUM(social_eng), 0) AS social_eng, "
        "COALESCE(SUM(conv_value), 0) AS conv_value FROM fact4 GROUP BY platform) AS p",
        WEB,
    ),
    "unified_counts": _q("SELECT platform, COUNT(*) AS n_rows FROM fact GROUP BY platform"),
    # filters
    "filter_platforms": _q(f"SELECT * FROM fact WHERE {SEL}"),
    "filter_dates": _q(f"SELECT * FROM fact WHERE {DATES}"),
    "filter_campaigns": _q(f"SELECT * FROM fact WHERE {CAMPS}"),
    "filter_all": _q(f"SELECT * FROM fact WHERE {SEL} AND {DATES} AND {CAMPS}"),
    "filter_series": _q(f"SELECT * FROM series WHERE {SEL} AND {DATES}"),
    # roll-ups
    "daily_rollup": _q("SELECT * FROM daily"),
    "daily_rollup_incremental": _q("SELECT * FROM daily"),
    "daily_rollup_by_file": _q("SELECT * FROM daily"),
    "platform_rollup": _q("SELECT * FROM plat_r"),
    "campaign_rollup": _q("SELECT * FROM camp_r"),
    "platform_cpm": _q(
        "SELECT platform, COALESCE(SUM(spend), 0) AS spend, "
        "CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions, "
        "COALESCE(SUM(spend), 0) / NULLIF(SUM(impressions), 0) * CAST(1000 AS DOUBLE) AS cpm "
        "FROM fact GROUP BY platform"
    ),
    "daily_ctr": _q(
        f"SELECT date, platform, clicks, impressions, clicks / NULLIF(impressions, 0) * {PCT} AS ctr_pct "
        "FROM daily"
    ),
    "portfolio_kpis": _q("SELECT * FROM kpis"),
    "filtered_campaign_rollup": _q(
        "SELECT *, clicks / NULLIF(impressions, 0) AS ctr, spend / NULLIF(conversions, 0) AS cpa, "
        "conv_value / NULLIF(spend, 0) AS roas FROM fcamp",
        FILTERED,
    ),
    "filtered_kpis": _q(
        "SELECT COALESCE(SUM(spend), 0) AS total_spend, CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS total_conversions, "
        "CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS total_impressions, "
        "CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS total_clicks, "
        "COALESCE(SUM(spend) / NULLIF(SUM(conversions), 0), 0) AS portfolio_cpa, "
        f"COALESCE(SUM(clicks) / NULLIF(SUM(impressions), 0) * {PCT}, 0) AS portfolio_ctr_pct, "
        "COALESCE(SUM(spend) / NULLIF(SUM(clicks), 0), 0) AS portfolio_cpc, "
        f"COALESCE({exact_mean(GOOGLE_ROAS)}, 0) AS mean_campaign_roas, "
        "SUM(CASE WHEN platform = 'Google' THEN conv_value END) / "
        "NULLIF(SUM(CASE WHEN platform = 'Google' THEN spend END), 0) AS pooled_roas FROM fcamp",
        FILTERED,
    ),
    "campaign_day_rollup": _q(
        "SELECT date, platform, campaign_name, CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions, "
        "CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS clicks, COALESCE(SUM(spend), 0) AS spend, "
        "CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS conversions, COALESCE(SUM(video_views), 0) AS video_views, "
        "COALESCE(SUM(social_eng), 0) AS social_eng, COALESCE(SUM(conv_value), 0) AS conv_value "
        "FROM fact GROUP BY date, platform, campaign_name"
    ),
    "materialized_selection": _q(
        "SELECT *, clicks / NULLIF(impressions, 0) AS ctr, spend / NULLIF(conversions, 0) AS cpa, "
        "conv_value / NULLIF(spend, 0) AS roas FROM fcamp",
        FILTERED,
    ),
    "empty_selection_kpis": _q(
        "SELECT COALESCE(SUM(spend), 0) AS total_spend, CAST(COALESCE(SUM(conversions), 0) AS BIGINT) AS total_conversions, "
        "CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS total_impressions, "
        "CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS total_clicks, CAST(0 AS DOUBLE) AS portfolio_cpa, "
        "CAST(0 AS DOUBLE) AS portfolio_ctr_pct, CAST(0 AS DOUBLE) AS portfolio_cpc, "
        "CAST(0 AS DOUBLE) AS mean_campaign_roas, CAST(NULL AS DOUBLE) AS pooled_roas "
        "FROM fact WHERE date BETWEEN DATE '2200-01-01' AND DATE '2200-12-31'"
    ),
    "kpi_scaled": _q(
        "SELECT total_spend / CAST(1000 AS DOUBLE) AS spend_k, "
        "total_impressions / CAST(1000000 AS DOUBLE) AS impressions_m, "
        "total_conversions, portfolio_cpa, portfolio_ctr_pct, "
        "(SELECT mean_campaign_roas FROM roas_kpi) AS mean_campaign_roas, "
        "'$' || format('{:.1f}', total_spend / CAST(1000 AS DOUBLE)) || 'K' AS spend_tile, "
        "format('{:,}', total_conversions) AS conversions_tile, "
        "format('{:.1f}', total_impressions / CAST(1000000 AS DOUBLE)) || 'M' AS impressions_tile, "
        "'$' || format('{:.2f}', portfolio_cpa) AS cpa_tile, "
        "format('{:.2f}', portfolio_ctr_pct) || '%' AS ctr_tile, "
        "format('{:.2f}', (SELECT mean_campaign_roas FROM roas_kpi)) || '×' AS roas_tile "
        "FROM kpis"
    ),
    "mean_campaign_roas": _q("SELECT * FROM roas_kpi"),
    "date_extent": _q("SELECT MIN(date) AS min_date, MAX(date) AS max_date FROM fact"),
    "campaign_list": _q(
        "SELECT campaign_name, CAST(ROW_NUMBER() OVER (ORDER BY campaign_name ASC NULLS LAST) AS BIGINT) "
        "AS position FROM (SELECT DISTINCT campaign_name FROM fact) AS d"
    ),
    # windows / shares / funnel
    "spend_rolling_7": _q("SELECT * FROM series"),
    "spend_series_ordered": _q(
        "SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY date ASC NULLS LAST, platform ASC NULLS LAST) AS BIGINT) AS position "
        "FROM series"
    ),
    "spend_rolling_7_days": _q(
        "SELECT *, AVG(spend) OVER (PARTITION BY platform ORDER BY date "
        "RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS spend_7d_avg FROM daily"
    ),
    "spend_share": _q(
        "SELECT platform, spend, SUM(spend) OVER () AS total_spend, "
        "spend / NULLIF(SUM(spend) OVER (), 0) AS spend_share FROM plat"
    ),
    "impression_share": _q(
        "SELECT platform, impressions, CAST(SUM(impressions) OVER () AS BIGINT) AS total_impressions, "
        "impressions / NULLIF(SUM(impressions) OVER (), 0) AS impressions_share FROM plat"
    ),
    "conversions_stacked": _q(
        "SELECT date, platform, conversions, CAST(SUM(conversions) OVER (PARTITION BY date ORDER BY platform "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS conversions_stacked FROM daily"
    ),
    "video_funnel": _q("SELECT * FROM funnel"),
    "funnel_stages": _q(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS BIGINT) AS stage_order, '{label}' AS stage, {col} AS viewers, "
            f"{col} / NULLIF(w25, 0) * {PCT} AS pct_of_first_stage, "
            f"{col} / NULLIF(views_total, 0) * {PCT} AS pct_of_total_views FROM funnel"
            for i, (label, col) in enumerate(
                [("25% view", "w25"), ("50% view", "w50"), ("75% view", "w75"), ("100% complete", "w100")], 1
            )
        )
    ),
    "engagement_summary": _q(
        "SELECT likes, shares, comments, likes + shares + comments AS total_engagements, "
        f"w100 / NULLIF(views_total, 0) * {PCT} AS completion_rate_pct, "
        f"shares / NULLIF(likes, 0) * {PCT} AS share_to_like_pct, "
        f"COALESCE(shares / NULLIF(likes, 0) * {PCT} > 25, FALSE) AS high_amplification FROM funnel"
    ),
    "engagement_tiles": _q(
        "SELECT *, format('{:,}', likes) AS likes_text, format('{:,}', shares) AS shares_text, "
        "format('{:,}', comments) AS comments_text, format('{:,}', total_engagements) AS total_engagements_text, "
        "format('{:.1f}', completion_rate_pct) || '%' AS completion_rate_pct_text, "
        "format('{:.1f}', share_to_like_pct) || '%' AS share_to_like_pct_text FROM ("
        "SELECT likes, shares, comments, likes + shares + comments AS total_engagements, "
        f"w100 / NULLIF(views_total, 0) * {PCT} AS completion_rate_pct, "
        f"shares / NULLIF(likes, 0) * {PCT} AS share_to_like_pct, "
        f"COALESCE(shares / NULLIF(likes, 0) * {PCT} > 25, FALSE) AS high_amplification FROM funnel) AS e"
    ),
    # ranks / insights
    "campaign_cpa_ranked": _q(
        f"SELECT {CAMP_COLS}, CAST(ROW_NUMBER() OVER (ORDER BY {_rank_order('cpa_key')}) AS BIGINT) AS cpa_rank "
        "FROM camp_k"
    ),
    "top_n_campaigns": _q(
        f"SELECT * FROM (SELECT {CAMP_COLS}, CAST(ROW_NUMBER() OVER (ORDER BY {_rank_order('cpa_key')}) AS BIGINT) "
        "AS rank FROM camp_k) AS r WHERE rank <= 5"
    ),
    "best_worst_campaign": _q(
        f"SELECT * FROM (SELECT 'best' AS kind, {CAMP_COLS} FROM camp_k WHERE cpa_key IS NOT NULL "
        f"ORDER BY {_rank_order('cpa_key')} LIMIT 1) AS b "
        f"UNION ALL SELECT * FROM (SELECT 'worst' AS kind, {CAMP_COLS} FROM camp_k WHERE cpa_key IS NOT NULL "
        "ORDER BY cpa_key DESC, platform ASC NULLS LAST, campaign_name ASC NULLS LAST LIMIT 1) AS w"
    ),
    "best_campaign_per_platform": _q(
        f"SELECT {CAMP_COLS} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY platform "
        "ORDER BY cpa_key ASC, campaign_name ASC NULLS LAST) AS rn FROM camp_k WHERE cpa_key IS NOT NULL) AS r "
        "WHERE rn = 1"
    ),
    "roas_table": _q(
        "SELECT campaign_name, spend, conv_value, roas, cpa, CAST(ROW_NUMBER() OVER "
        "(ORDER BY roas DESC NULLS LAST, campaign_name ASC NULLS LAST) AS BIGINT) AS roas_rank "
        "FROM camp_r WHERE platform = 'Google'"
    ),
    "roas_chart": _q(
        "SELECT CAST(ROW_NUMBER() OVER (ORDER BY roas DESC NULLS LAST, campaign_name ASC NULLS LAST) AS BIGINT) AS position, "
        "replace(campaign_name, '_', ' ') AS label, roas, format('{:.2f}', roas) || '×' AS roas_text, "
        "COALESCE(roas >= 4, FALSE) AS meets_target FROM camp_r WHERE platform = 'Google'"
    ),
    "cpa_chart": _q(
        f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_rank_order('cpa_key')}) AS BIGINT) AS position, platform, "
        "replace(campaign_name, '_', ' ') AS label, cpa, '$' || format('{:.2f}', cpa) AS cpa_text FROM camp_k"
    ),
    "roas_target_flag": _q(
        "SELECT campaign_name, roas, COALESCE(roas >= 4, FALSE) AS meets_target "
        "FROM camp_r WHERE platform = 'Google'"
    ),
    "roas_leader": _q(
        f"SELECT {CAMP_COLS} FROM camp_r WHERE roas IS NOT NULL ORDER BY {_rank_order('roas', True)} LIMIT 1"
    ),
    "below_target_spend": _q(
        "SELECT platform, campaign_name, roas, spend, 4 - roas AS gap_to_target "
        "FROM camp_r WHERE platform = 'Google' AND roas < 4"
    ),
    "conversion_leader": _q(
        f"SELECT {CAMP_COLS} FROM camp_r WHERE conversions IS NOT NULL "
        f"ORDER BY {_rank_order('conversions', True)} LIMIT 1"
    ),
    "platform_leaders": _q(
        "SELECT * FROM (SELECT 'most_conversions' AS leader, platform, CAST(conversions AS DOUBLE) AS value "
        "FROM plat ORDER BY conversions DESC, platform LIMIT 1) AS a UNION ALL "
        "SELECT * FROM (SELECT 'lowest_cpm' AS leader, platform, "
        "spend / NULLIF(impressions, 0) * CAST(1000 AS DOUBLE) AS value FROM plat "
        "WHERE spend / NULLIF(impressions, 0) IS NOT NULL ORDER BY value ASC, platform LIMIT 1) AS b"
    ),
    # presentation / sink
    "platform_kpis_long": _q(
        "SELECT platform, 'cpa' AS metric, cpa AS value, '$' || format('{:.2f}', cpa) AS label FROM plat_r "
        f"UNION ALL SELECT platform, 'ctr_pct', ctr * {PCT}, format('{{:.2f}}', ctr * {PCT}) || '%' FROM plat_r "
        "UNION ALL SELECT platform, 'cpc', cpc, '$' || format('{:.3f}', cpc) FROM plat_r"
    ),
    "campaign_labels": _q(
        "SELECT platform, campaign_name, replace(campaign_name, '_', ' ') AS label FROM camp_r"
    ),
    "report_campaign_table": _q(
        "SELECT replace(campaign_name, '_', ' ') AS campaign, spend, conversions, conv_value, cpa, roas, "
        "'$' || format('{:,.0f}', spend) AS spend_text, '$' || format('{:,.0f}', conv_value) AS conv_value_text, "
        "'$' || format('{:.2f}', cpa) AS cpa_text, format('{:.2f}', roas) || '×' AS roas_text "
        "FROM camp_r WHERE platform = 'Google'"
    ),
    "report_fact_table": _q(
        "SELECT date, platform, replace(campaign_name, '_', ' ') AS campaign, impressions, clicks, spend, conversions, "
        "ctr, cpc, cpa, video_views, social_eng, strftime(date, '%Y-%m-%d') AS date_text, "
        "'$' || format('{:,.2f}', spend) AS spend_text, "
        f"format('{{:.2f}}', ctr * {PCT}) || '%' AS ctr_text, '$' || format('{{:.3f}}', cpc) AS cpc_text, "
        "'$' || format('{:.2f}', cpa) AS cpa_text FROM fact"
    ),
    "export_text_roundtrip": _q(
        "SELECT * REPLACE (CASE campaign_id WHEN 'c1' THEN 'a \"quoted\" name' WHEN 'c2' THEN ' blanks, and commas ' "
        "WHEN 'c3' THEN 'two' || chr(10) || 'lines' WHEN 'c4' THEN '' WHEN 'c5' THEN NULL "
        "WHEN 'c6' THEN '\"' || chr(92) || '\"' ELSE campaign_name END AS campaign_name) FROM fact"
    ),
    "export_roundtrip": _q("SELECT * FROM fact"),
}

# The same results by way of cached and of refreshed tables.
ORACLE["cached_selection"] = ORACLE["materialized_selection"]
ORACLE["refreshed_cube"] = ORACLE["campaign_day_rollup"]
ORACLE["spend_rolling_refreshed"] = ORACLE["spend_rolling_7"]
ORACLE["ordered_export"] = ORACLE["unified_fact"]
ORACLE["fact_page"] = _q(
    "SELECT * FROM fact ORDER BY date NULLS FIRST, platform NULLS FIRST, campaign_name NULLS FIRST, "
    "campaign_id NULLS FIRST, impressions NULLS FIRST, clicks NULLS FIRST, spend NULLS FIRST, conversions NULLS FIRST, "
    "video_views NULLS FIRST, ctr NULLS FIRST, cpc NULLS FIRST, cpa NULLS FIRST, roas NULLS FIRST, "
    "social_eng NULLS FIRST, vid_compl_rate NULLS FIRST, conv_value NULLS FIRST LIMIT 250 OFFSET 750"
)
