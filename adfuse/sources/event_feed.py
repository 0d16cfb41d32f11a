"""A fourth, web-analytics channel derived from the ``events`` table.

It is added to the unified fact by spec only (``channels.WEB``): one row per
event, views / clicks / purchases as 0-1 counters and the event value, in
cents, as cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adfuse.sources.tables import read_table

# Raw column expressions of the web feed.
WEB_COLUMNS: list[str] = [
    "CAST(ts AS DATE) AS date",
    "event_type AS campaign_id",
    "concat('Web_', event_type) AS campaign_name",
    "CAST(event_type = 'view' AS BIGINT) AS views",
    "CAST(event_type = 'click' AS BIGINT) AS clicks",
    "CAST(event_type = 'purchase' AS BIGINT) AS purchases",
    "round(value * 100) AS cost",
]


def web_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").selectExpr(*WEB_COLUMNS)
