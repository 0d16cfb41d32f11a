"""Built-in channel specs for the three advertising exports.

Fixed values: the raw header names and types of each export, and which raw
column fills which canonical fact column.  The same specs conform both the
CSV exports and the parquet-derived test feeds, which use the same raw names.
"""

from __future__ import annotations

from adfuse.sources.spec import FeedSpec

# --- fixed values: raw export headers and their types --------------------------
FACEBOOK = FeedSpec(
    name="facebook",
    platform="Facebook",
    source_types={
        "date": "date",
        "campaign_id": "string",
        "campaign_name": "string",
        "ad_set_id": "string",
        "ad_set_name": "string",
        "impressions": "bigint",
        "clicks": "bigint",
        "spend": "double",
        "conversions": "bigint",
        "video_views": "bigint",
        "engagement_rate": "double",
        "reach": "bigint",
        "frequency": "double",
    },
)

GOOGLE = FeedSpec(
    name="google",
    platform="Google",
    source_types={
        "date": "date",
        "campaign_id": "string",
        "campaign_name": "string",
        "ad_group_id": "string",
        "ad_group_name": "string",
        "impressions": "bigint",
        "clicks": "bigint",
        "cost": "double",
        "conversions": "bigint",
        "conversion_value": "double",
        "ctr": "double",
        "avg_cpc": "double",
        "quality_score": "bigint",
        "search_impression_share": "double",
    },
    # Google reports its own (rounded) ctr and avg_cpc: passed through, not recomputed.
    rename={"cost": "spend", "conversion_value": "conv_value", "avg_cpc": "cpc"},
)

TIKTOK = FeedSpec(
    name="tiktok",
    platform="TikTok",
    source_types={
        "date": "date",
        "campaign_id": "string",
        "campaign_name": "string",
        "adgroup_id": "string",
        "adgroup_name": "string",
        "impressions": "bigint",
        "clicks": "bigint",
        "cost": "double",
        "conversions": "bigint",
        "video_views": "bigint",
        "video_watch_25": "bigint",
        "video_watch_50": "bigint",
        "video_watch_75": "bigint",
        "video_watch_100": "bigint",
        "likes": "bigint",
        "shares": "bigint",
        "comments": "bigint",
    },
    rename={"cost": "spend"},
    derived={
        "social_eng": "likes + shares + comments",
        "vid_compl_rate": "try_divide(video_watch_100, video_views)",
    },
)

# A web-analytics channel (see ``event_feed``): only renames, everything else by role.
WEB = FeedSpec(
    name="web",
    platform="Web",
    source_types={
        "date": "date",
        "campaign_id": "string",
        "campaign_name": "string",
        "views": "bigint",
        "clicks": "bigint",
        "purchases": "bigint",
        "cost": "double",
    },
    rename={"views": "impressions", "purchases": "conversions", "cost": "spend"},
)
# -------------------------------------------------------------------------------

CHANNELS: dict[str, FeedSpec] = {s.name: s for s in (FACEBOOK, GOOGLE, TIKTOK)}
