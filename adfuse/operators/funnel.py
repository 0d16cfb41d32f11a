"""Video funnel and social-engagement summary over a video channel's raw feed.

The funnel is a global (or grouped) aggregate with partial sums per task;
everything downstream works on its one row per group, so no shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfuse.functions.ratios import safe_div
from adfuse.schema import FUNNEL_MEASURES

# Funnel stage labels in drawing order, and the funnel column of each.
FUNNEL_STAGES: list[tuple[str, str]] = [
    ("25% view", "w25"),
    ("50% view", "w50"),
    ("75% view", "w75"),
    ("100% complete", "w100"),
]

# Share-to-like ratio (percent) above which amplification is called high.
AMPLIFICATION_THRESHOLD_PCT = 25.0


def video_funnel(video_feed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals of views, watch stages and social counters (one row per group)."""
    sums = [
        F.coalesce(F.sum(raw), F.lit(0)).cast("bigint").alias(name)
        for name, raw in FUNNEL_MEASURES.items()
    ]
    if by:
        return video_feed.groupBy(*by).agg(*sums)
    return video_feed.agg(*sums)


def funnel_stages(funnel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Long form of the funnel: one row per stage with retention.

    pct_of_first_stage   viewers / first drawn stage (the funnel chart's
                         "percent of initial")
    pct_of_total_views   viewers / all video views (the caption's meaning)
    """
    pairs = ", ".join(f"{i}, '{label}', {col}" for i, (label, col) in enumerate(FUNNEL_STAGES, 1))
    first = FUNNEL_STAGES[0][1]
    long = funnel.select(
        *by,
        F.col(first).alias("_first"),
        F.col("views_total").alias("_views"),
        F.expr(f"stack({len(FUNNEL_STAGES)}, {pairs}) AS (stage_order, stage, viewers)"),
    )
    return long.select(
        *by,
        F.col("stage_order").cast("bigint").alias("stage_order"),
        "stage",
        "viewers",
        (safe_div("viewers", "_first") * F.lit(100.0)).alias("pct_of_first_stage"),
        (safe_div("viewers", "_views") * F.lit(100.0)).alias("pct_of_total_views"),
    )


def engagement_summary(funnel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Social totals and the two engagement ratios shown next to the funnel."""
    share_to_like = safe_div("shares", "likes") * F.lit(100.0)
    return funnel.select(
        *by,
        "likes",
        "shares",
        "comments",
        (F.col("likes") + F.col("shares") + F.col("comments")).alias("total_engagements"),
        (safe_div("w100", "views_total") * F.lit(100.0)).alias("completion_rate_pct"),
        share_to_like.alias("share_to_like_pct"),
        F.coalesce(share_to_like > F.lit(AMPLIFICATION_THRESHOLD_PCT), F.lit(False)).alias(
            "high_amplification"
        ),
    )
