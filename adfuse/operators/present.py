"""Presentation tables: the data half of the dashboard's tables and tiles.

Text columns are built with JVM-side ``format_number``/``concat`` (no Python
formatting per row).  Column names are snake_case; ``display_headers`` maps
them to the dashboard's header captions when needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfuse.functions.format import (
    clean_label,
    fmt_currency,
    fmt_fixed,
    fmt_multiple,
    fmt_number,
    fmt_percent,
    fmt_scaled,
    scale,
)
from adfuse.operators.filters import flag_target

# Display captions of the two dashboard tables.
CAMPAIGN_TABLE_HEADERS: dict[str, str] = {
    "campaign": "Campaign",
    "spend": "Spend",
    "conversions": "Conv.",
    "conv_value": "Conv. Value",
    "cpa": "CPA",
    "roas": "ROAS",
}
FACT_TABLE_HEADERS: dict[str, str] = {
    "date": "Date",
    "platform": "Platform",
    "campaign": "Campaign",
    "impressions": "Impressions",
    "clicks": "Clicks",
    "spend": "Spend",
    "conversions": "Conversions",
    "ctr": "CTR",
    "cpc": "CPC",
    "cpa": "CPA",
    "video_views": "Video Views",
    "social_eng": "Social Eng.",
}


def display_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """The table as shown: a column per caption, its text where there is one (for final output only)."""
    shown = [(f"{c}_text" if f"{c}_text" in df.columns else c, caption) for c, caption in headers.items()]
    return df.select(*[F.col(c).alias(caption) for c, caption in shown if c in df.columns])


def campaign_labels(camp: DataFrame) -> DataFrame:
    """Campaign names with underscores shown as spaces."""
    return camp.select("platform", "campaign_name", clean_label("campaign_name").alias("label"))


def report_campaign_table(camp: DataFrame, platform: str = "Google") -> DataFrame:
    """Per-campaign detail table of one platform (search channel by default); numbers and their text."""
    return camp.where(F.col("platform") == F.lit(platform)).select(
        clean_label("campaign_name").alias("campaign"),
        "spend",
        "conversions",
        "conv_value",
        "cpa",
        "roas",
        fmt_currency("spend", 0).alias("spend_text"),
        fmt_currency("conv_value", 0).alias("conv_value_text"),
        fmt_currency("cpa", 2, grouping=False).alias("cpa_text"),
        fmt_multiple("roas", 2).alias("roas_text"),
    )


def report_fact_table(fact: DataFrame) -> DataFrame:
    """Row-level view of the (filtered) fact; numbers and their text."""
    return fact.select(
        "date",
        "platform",
        clean_label("campaign_name").alias("campaign"),
        "impressions",
        "clicks",
        "spend",
        "conversions",
        "ctr",
        "cpc",
        "cpa",
        "video_views",
        "social_eng",
        F.date_format("date", "yyyy-MM-dd").alias("date_text"),
        fmt_currency("spend", 2).alias("spend_text"),
        fmt_percent("ctr", 2).alias("ctr_text"),
        fmt_currency("cpc", 3, grouping=False).alias("cpc_text"),
        fmt_currency("cpa", 2, grouping=False).alias("cpa_text"),
    )


def cpa_chart(ranked: DataFrame) -> DataFrame:
    """The CPA bars in their order: campaigns ranked by ``cpa_rank`` with label and bar text."""
    return ranked.select(
        F.col("cpa_rank").alias("position"),
        "platform",
        clean_label("campaign_name").alias("label"),
        "cpa",
        fmt_currency("cpa", 2, grouping=False).alias("cpa_text"),
    )


def roas_chart(ranked: DataFrame, target: float) -> DataFrame:
    """The ROAS bars in their order: campaigns ranked by ``roas_rank`` with label, bar text and target flag."""
    flagged = flag_target(ranked, "roas", target)
    return flagged.select(
        F.col("roas_rank").alias("position"),
        clean_label("campaign_name").alias("label"),
        "roas",
        fmt_multiple("roas", 2).alias("roas_text"),
        "meets_target",
    )


def engagement_tiles(engagement: DataFrame) -> DataFrame:
    """Texts of the engagement tiles, beside their numbers."""
    counts = ["likes", "shares", "comments", "total_engagements"]
    rates = ["completion_rate_pct", "share_to_like_pct"]
    return engagement.select(
        "*",
        *[fmt_number(c, 0).alias(f"{c}_text") for c in counts],
        *[fmt_percent(c, 1, already_pct=True).alias(f"{c}_text") for c in rates],
    )


def platform_kpis_long(plat: DataFrame) -> DataFrame:
    """(platform, metric, value, label) rows for the CPA / CTR% / CPC bars."""
    wide = plat.select(
        "platform", "cpa", (F.col("ctr") * F.lit(100.0)).alias("ctr_pct"), "cpc"
    )
    long = wide.unpivot(["platform"], ["cpa", "ctr_pct", "cpc"], "metric", "value")
    label = (
        F.when(F.col("metric") == "cpa", fmt_currency("value", 2, grouping=False))
        .when(F.col("metric") == "ctr_pct", F.concat(fmt_fixed("value", 2), F.lit("%")))
        .otherwise(fmt_currency("value", 3, grouping=False))
    )
    return long.select("platform", "metric", "value", label.alias("label"))


def kpi_tiles(kpis: DataFrame, roas: DataFrame | None = None) -> DataFrame:
    """Scaled KPI values and their tile text ($K spend, M impressions, ...).

    ``kpis`` is the one-row ``portfolio_kpis`` or ``kpi_summary`` (which
    already carries ``mean_campaign_roas``); otherwise ``roas`` (optional), the
    one-row ``mean_campaign_roas``, is attached as a scalar subquery.
    """
    cols = [
        scale("total_spend", "K").alias("spend_k"),
        scale("total_impressions", "M").alias("impressions_m"),
        "total_conversions",
        "portfolio_cpa",
        "portfolio_ctr_pct",
        fmt_scaled("total_spend", "K", 1, prefix="$").alias("spend_tile"),
        fmt_number("total_conversions", 0).alias("conversions_tile"),
        fmt_scaled("total_impressions", "M", 1).alias("impressions_tile"),
        fmt_currency("portfolio_cpa", 2, grouping=False).alias("cpa_tile"),
        fmt_percent("portfolio_ctr_pct", 2, already_pct=True).alias("ctr_tile"),
    ]
    if "mean_campaign_roas" in kpis.columns:
        cols += ["mean_campaign_roas", fmt_multiple("mean_campaign_roas", 2).alias("roas_tile")]
    elif roas is not None:
        r = roas.select("mean_campaign_roas").scalar()
        cols += [r.alias("mean_campaign_roas"), fmt_multiple(r, 2).alias("roas_tile")]
    return kpis.select(*cols)
