"""Canonical column layout of the unified channel fact.

Every channel feed, whatever its own column names, is conformed to this
16-column layout (one row per source row: date x campaign x ad set).
"""

from __future__ import annotations

from pyspark.sql import types as T

# The names, types and roles of the unified fact's columns.
# Column roles drive the conform defaults:
#   key      - copied from the feed (renamed if needed)
#   count    - additive integer measure, BIGINT (absent -> 0)
#   money    - additive double measure (absent -> 0.0)
#   ratio    - row-level ratio; native pass-through or derived (absent -> NULL)
#   value    - monetary value only some channels report (absent -> NULL)
FACT_FIELDS: list[tuple[str, T.DataType, str]] = [
    ("date", T.DateType(), "key"),
    ("campaign_id", T.StringType(), "key"),
    ("campaign_name", T.StringType(), "key"),
    ("platform", T.StringType(), "key"),
    ("impressions", T.LongType(), "count"),
    ("clicks", T.LongType(), "count"),
    ("spend", T.DoubleType(), "money"),
    ("conversions", T.LongType(), "count"),
    ("video_views", T.DoubleType(), "money"),
    ("ctr", T.DoubleType(), "ratio"),
    ("cpc", T.DoubleType(), "ratio"),
    ("cpa", T.DoubleType(), "ratio"),
    ("roas", T.DoubleType(), "ratio"),
    ("social_eng", T.DoubleType(), "money"),
    ("vid_compl_rate", T.DoubleType(), "ratio"),
    ("conv_value", T.DoubleType(), "value"),
]

FACT_COLUMNS: list[str] = [name for name, _, _ in FACT_FIELDS]
FACT_TYPES: dict[str, T.DataType] = {name: dtype for name, dtype, _ in FACT_FIELDS}
FACT_ROLES: dict[str, str] = {name: role for name, _, role in FACT_FIELDS}

FACT_SCHEMA = T.StructType(
    [T.StructField(name, dtype, nullable=True) for name, dtype, _ in FACT_FIELDS]
)

# Measures summed by the daily series (date x platform).
DAILY_MEASURES: list[str] = ["spend", "conversions", "impressions", "clicks"]

# Measures summed by the platform and campaign roll-ups.
PLATFORM_MEASURES: list[str] = [
    "impressions", "clicks", "spend", "conversions", "video_views", "social_eng", "conv_value",
]
CAMPAIGN_MEASURES: list[str] = ["impressions", "clicks", "spend", "conversions", "conv_value"]

# Video funnel totals: output name -> raw video-feed column.
FUNNEL_MEASURES: dict[str, str] = {
    "views_total": "video_views",
    "w25": "video_watch_25",
    "w50": "video_watch_50",
    "w75": "video_watch_75",
    "w100": "video_watch_100",
    "likes": "likes",
    "shares": "shares",
    "comments": "comments",
}
