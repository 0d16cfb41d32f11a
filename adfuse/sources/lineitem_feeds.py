"""Channel-shaped raw feeds derived from the ``lineitem`` table.

The test tables carry no advertising exports, so three raw feeds are carved
out of ``lineitem`` by return flag, each with its own export's raw column
names so that conforming is really exercised (FIXTURES.md section 3):

    A -> Facebook-shaped, N -> Google-shaped, R -> TikTok-shaped

Every value is an integer-valued double or a bigint, so sums are exact in
any order and Spark agrees bit for bit with an independent SQL engine.
The flag filter and the column selection reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adfuse.sources.channels import GOOGLE
from adfuse.sources.tables import read_table

# Which return flag stands in for which channel, and the raw
# column expressions of each channel-shaped feed.
FLAG_OF_FEED: dict[str, str] = {"facebook": "A", "google": "N", "tiktok": "R"}

_QTY = "CAST(l_quantity AS BIGINT)"
_CENTS = "round(l_extendedprice * 100)"
_COMMON = [
    "CAST(l_shipdate AS DATE) AS date",
    "concat('c', CAST(l_linenumber AS STRING)) AS campaign_id",
    "concat('Camp_', CAST(l_linenumber AS STRING)) AS campaign_name",
    f"{_QTY} * 1000 AS impressions",
    "l_partkey % 1000 AS clicks",
]
FEED_COLUMNS: dict[str, list[str]] = {
    "facebook": _COMMON
    + [
        f"{_CENTS} AS spend",
        "l_suppkey % 10 AS conversions",
        f"{_QTY} * 100 AS video_views",
        "concat('s', CAST(l_suppkey % 7 AS STRING)) AS ad_set_id",
        "concat('Set_', CAST(l_suppkey % 7 AS STRING)) AS ad_set_name",
        "round(l_discount, 2) AS engagement_rate",
        f"{_QTY} * 700 AS reach",
        "round(l_tax, 2) AS frequency",
    ],
    "google": _COMMON
    + [
        f"{_CENTS} AS cost",
        "l_suppkey % 10 AS conversions",
        f"{_CENTS} * (l_suppkey % 7) AS conversion_value",
        "round(l_discount, 2) AS ctr",
        "round(l_tax, 2) AS avg_cpc",
        "concat('g', CAST(l_suppkey % 7 AS STRING)) AS ad_group_id",
        "concat('Group_', CAST(l_suppkey % 7 AS STRING)) AS ad_group_name",
        "l_suppkey % 10 + 1 AS quality_score",
        "round(l_discount, 2) AS search_impression_share",
    ],
    "tiktok": _COMMON
    + [
        f"{_CENTS} AS cost",
        "l_suppkey % 10 AS conversions",
        f"{_QTY} * 100 AS video_views",
        f"{_QTY} * 80 AS video_watch_25",
        f"{_QTY} * 60 AS video_watch_50",
        f"{_QTY} * 40 AS video_watch_75",
        f"{_QTY} * (l_suppkey % 30) AS video_watch_100",
        "l_orderkey % 50 AS likes",
        "l_partkey % 20 AS shares",
        "l_suppkey % 5 AS comments",
        "concat('t', CAST(l_suppkey % 7 AS STRING)) AS adgroup_id",
        "concat('Adgroup_', CAST(l_suppkey % 7 AS STRING)) AS adgroup_name",
    ],
}


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")


def channel_feed(li: DataFrame, channel: str) -> DataFrame:
    """One channel-shaped raw feed: a filter and a projection over lineitem."""
    return li.where(f"l_returnflag = '{FLAG_OF_FEED[channel]}'").selectExpr(*FEED_COLUMNS[channel])


#: Column of ``channel_table`` that tells the channels apart.
CHANNEL = "channel"


def channel_table(li: DataFrame) -> DataFrame:
    """All three channels as one wide raw table: every raw column of any of them, and the channel's tag.

    A raw column of the same name has the same definition in every feed.
    """
    columns = dict.fromkeys(c for feed in FEED_COLUMNS.values() for c in feed)
    return li.selectExpr(f"l_returnflag AS {CHANNEL}", *columns)


def social_feed(li: DataFrame) -> DataFrame:
    """Facebook-shaped: spend, video_views."""
    return channel_feed(li, "facebook")


def search_feed(li: DataFrame) -> DataFrame:
    """Google-shaped: cost, conversion_value and native (rounded) ctr / avg_cpc."""
    return channel_feed(li, "google")


def video_feed(li: DataFrame) -> DataFrame:
    """TikTok-shaped: cost, video funnel stages and social counters."""
    return channel_feed(li, "tiktok")


def faulty_search_lines(li: DataFrame) -> DataFrame:
    """The search feed as CSV lines (no header), some of them damaged: of every
    twenty, one too short, one too long, and one each with a fractional count,
    a text for an amount and an impossible date."""
    kind = "(l_orderkey + l_linenumber) % 20"
    feed = li.where(f"l_returnflag = '{FLAG_OF_FEED['google']}'").selectExpr(*FEED_COLUMNS["google"], f"{kind} AS kind")
    text = {c: f"CAST({c} AS STRING)" for c in GOOGLE.source_types}
    text["date"] = "if(kind = 4, '1996-13-40', CAST(date AS STRING))"
    text["conversions"] = "concat(conversions, if(kind = 2, '.5', ''))"
    text["cost"] = "if(kind = 3, 'n/a', CAST(cost AS STRING))"
    cells = [f"{e} AS {c}" for c, e in text.items()]
    short = ", ".join(list(text)[:10])
    whole = ", ".join(text)
    return feed.selectExpr("kind", *cells).selectExpr(
        f"concat(if(kind = 0, concat_ws(',', {short}), concat_ws(',', {whole})), if(kind = 1, ',extra', '')) AS line"
    )


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw channel feeds keyed by channel name."""
    li = lineitem(spark, sf_dir)
    return {name: channel_feed(li, name) for name in FLAG_OF_FEED}
