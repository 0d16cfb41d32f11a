"""Fact and series filters.

Expressed as plain predicates so Catalyst pushes them down: the date range
reaches the parquet scan (rewritten onto the raw timestamp), and a platform
list prunes whole union branches because ``platform`` is a literal per feed.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateLike = str | dt.date | None


def _as_date(d: DateLike) -> Column | None:
    if d is None:
        return None
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    elif isinstance(d, dt.datetime):
        d = d.date()  # whole days: a time part must not cut the end day short
    return F.lit(d)


def _predicate(
    platforms: Sequence[str] | None,
    date_from: DateLike,
    date_to: DateLike,
    campaigns: Sequence[str] | None,
    date_col: str,
) -> Column:
    preds: list[Column] = []
    if platforms is not None:
        # An empty platform selection selects nothing (isin([]) is false).
        preds.append(F.col("platform").isin(list(platforms)) if platforms else F.lit(False))
    lo, hi = _as_date(date_from), _as_date(date_to if date_to is not None else date_from)
    if lo is not None and hi is not None:
        preds.append(F.col(date_col).between(lo, hi))
    elif lo is not None:
        preds.append(F.col(date_col) >= lo)
    elif hi is not None:
        preds.append(F.col(date_col) <= hi)
    if campaigns:
        # An empty campaign selection means no restriction.
        preds.append(F.col("campaign_name").isin(list(campaigns)))
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def filter_fact(
    fact: DataFrame,
    platforms: Sequence[str] | None = None,
    date_from: DateLike = None,
    date_to: DateLike = None,
    campaigns: Sequence[str] | None = None,
) -> DataFrame:
    """Dashboard filter on the unified fact.

    platforms  None = all; [] = none
    date_from / date_to  inclusive; a single given date means that day only
    campaigns  None or [] = all
    """
    return fact.where(_predicate(platforms, date_from, date_to, campaigns, "date"))


def filter_series(
    series: DataFrame,
    platforms: Sequence[str] | None = None,
    date_from: DateLike = None,
    date_to: DateLike = None,
) -> DataFrame:
    """Platform/date filter applied to the daily series *after* its windows.

    Trailing averages keep their pre-filter history; the platform predicate
    (the window's partition key) is still pushed below the window by Catalyst.
    """
    return series.where(_predicate(platforms, date_from, date_to, None, "date"))


def flag_target(
    df: DataFrame, metric: str, target: float, out: str = "meets_target"
) -> DataFrame:
    """Boolean column ``metric >= target``; an undefined metric never meets it."""
    return df.withColumn(out, F.coalesce(F.col(metric) >= F.lit(target), F.lit(False)))
