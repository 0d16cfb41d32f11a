"""The dashboard's data flow as composed lazy plans.

load      raw feeds -> conformed, unified fact -> one (date, platform,
          campaign) aggregate ``cube`` -> the (date, platform) series with its
          trailing spend average; video funnel of the video channel
select    the filter interaction: every table the dashboard shows for one
          platform / date / campaign selection

The fact is aggregated once.  All filters act on dimensions the cube keeps,
and every roll-up the dashboard shows is additive, so plat / camp / KPIs /
shares / leaders / rankings are all answered from the filtered cube (size:
days x campaigns); only the row-level table reads the fact.  The cube and the
one-row funnel are always written once as parquet (to ``materialize_to``, or a
scratch folder of the session), so each table of the view reads just its
columns and dates.  With ``materialize_to`` the fact is written as well,
partitioned by platform and month and clustered by campaign inside: lineage is cut,
executor loss costs no recomputation, platform and date filters prune, and a
campaign filter skips row groups.  ``load_cached`` keeps these tables for later calls.
A single selection needs none of this: filter the fact itself and the
predicates reach the feeds.  Nothing here collects: each attribute is a DataFrame for the caller's action.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfuse.functions.ratios import with_ratios
from adfuse.operators.conform import conform_all
from adfuse.operators.filters import DateLike, filter_fact, filter_series
from adfuse.operators.funnel import engagement_summary, funnel_stages, video_funnel
from adfuse.operators.insights import below_target, best_worst, platform_leaders, rank_campaigns
from adfuse.operators.present import (
    kpi_tiles,
    platform_kpis_long,
    report_campaign_table,
    report_fact_table,
)
from adfuse.operators.rollups import (
    campaign_day_rollup,
    campaign_rollup,
    daily_ctr,
    daily_rollup,
    kpi_summary,
    platform_rollup,
)
from adfuse.operators.windows import rolling_mean, share_of_total, stack
from adfuse.sources.cache import TableCache
from adfuse.sources.files import spec_text
from adfuse.sources.sinks import Stored, store
from adfuse.sources.spec import FeedSpec
from adfuse.sources.storage import scratch_path


#: Partition column of the materialised fact: year * 100 + month.
MONTH = "fact_month"


def _month(date):
    return F.year(date) * 100 + F.month(date)


@dataclass
class Loaded:
    fact: DataFrame
    cube: DataFrame
    series: DataFrame
    funnel: DataFrame | None


def series_of(fact: DataFrame, window: int = 7, frame: str = "rows") -> DataFrame:
    """Daily (date, platform) sums with the trailing mean of spend.

    ``fact`` may be the fact or any finer-grained roll-up of it (the cube).
    """
    return rolling_mean(daily_rollup(fact), "spend", window, frame, out="spend_7d_avg")


#: Version of what ``load_cached`` stores.
STORED = "1"


def _store(
    feeds: Mapping[str, DataFrame], specs: Mapping[str, FeedSpec], video_channel: str, root: str, with_fact: bool
) -> tuple[DataFrame, dict[str, Stored]]:
    """The (stored) fact, and the stored tables by name."""
    fact, tables = conform_all(dict(feeds), dict(specs)), {}
    if with_fact:
        tables["fact"] = store(
            fact.withColumn(MONTH, _month("date")),
            f"{root}/fact",
            partition_by=["platform", MONTH],
            cluster_by=["campaign_name", "date"],
            bloom=["campaign_name"],
        )
        fact = tables["fact"].read(fact.sparkSession)
    tables["cube"] = store(campaign_day_rollup(fact, exact=True), f"{root}/cube")
    if video_channel in feeds:
        tables["funnel"] = store(video_funnel(feeds[video_channel]), f"{root}/funnel")
    return fact, tables


def load(
    feeds: Mapping[str, DataFrame],
    specs: Mapping[str, FeedSpec],
    video_channel: str = "tiktok",
    materialize_to: str | None = None,
) -> Loaded:
    spark = next(iter(feeds.values())).sparkSession
    root = (materialize_to or scratch_path(spark, "dashboard")).rstrip("/")
    fact, stored = _store(feeds, specs, video_channel, root, with_fact=bool(materialize_to))
    tables = {name: t.read(spark) for name, t in stored.items()}
    return Loaded(fact=fact, cube=tables["cube"], series=series_of(tables["cube"]), funnel=tables.get("funnel"))


def load_cached(
    spark: SparkSession,
    feeds: Callable[[], Mapping[str, DataFrame]],
    specs: Mapping[str, FeedSpec],
    inputs: Sequence[str],
    cache_root: str,
    video_channel: str = "tiktok",
) -> Loaded:
    """``load`` that later calls, also of other sessions, find again.

    ``inputs`` are the paths that the feeds read.  As long as their files and
    the specs stay the same, a call reads the stored tables and neither calls
    ``feeds`` nor touches an input file; after a change it builds anew.
    """

    def build(folder: str) -> dict[str, Stored]:
        return _store(feeds(), specs, video_channel, folder, with_fact=True)[1]

    what = [STORED, video_channel, *(spec_text(specs[name]) for name in sorted(specs))]
    tables = TableCache(spark, cache_root).tables(inputs, what, build)
    cube = tables["cube"]
    return Loaded(fact=tables["fact"], cube=cube, series=series_of(cube), funnel=tables.get("funnel"))


def _rows(fact: DataFrame, date_from: DateLike, date_to: DateLike) -> DataFrame:
    """The fact without its partition column, months outside the dates pruned."""
    if MONTH not in fact.columns:
        return fact
    days = [F.lit(d).cast("date") for d in (date_from, date_to if date_to is not None else date_from)]
    if date_from is not None:
        fact = fact.where(F.col(MONTH) >= _month(days[0]))
    if date_from is not None or date_to is not None:
        fact = fact.where(F.col(MONTH) <= _month(days[1]))
    return fact.drop(MONTH)


@dataclass
class View:
    fact: DataFrame
    series: DataFrame
    platforms: DataFrame
    campaigns: DataFrame
    search_campaigns: DataFrame
    kpis: DataFrame
    tiles: DataFrame
    spend_share: DataFrame
    impression_share: DataFrame
    platform_kpis: DataFrame
    conversions_stacked: DataFrame
    ctr: DataFrame
    best_worst: DataFrame
    leaders: DataFrame
    below_target: DataFrame
    funnel_stages: DataFrame | None
    engagement: DataFrame | None
    search_table: DataFrame
    fact_table: DataFrame

    def cpa_ranking(self) -> DataFrame:
        """Campaigns with their CPA position (runs a checkpoint job when called)."""
        return rank_campaigns(self.campaigns, "cpa")


def select(
    loaded: Loaded,
    platforms: Sequence[str] | None = None,
    date_from: DateLike = None,
    date_to: DateLike = None,
    campaigns: Sequence[str] | None = None,
    search_platform: str = "Google",
) -> View:
    """Everything the dashboard shows for one filter selection.

    As in the reference, the series is filtered after its window (trailing
    averages keep earlier history) and ignores the campaign filter; the funnel
    ignores every filter.
    """
    fact = filter_fact(_rows(loaded.fact, date_from, date_to), platforms, date_from, date_to, campaigns)
    cube = filter_fact(loaded.cube, platforms, date_from, date_to, campaigns)
    series = filter_series(loaded.series, platforms, date_from, date_to)
    plat = platform_rollup(cube)
    camp = campaign_rollup(cube, exact=True)
    summary = kpi_summary(camp, search_platform)
    return View(
        fact=fact,
        series=series,
        platforms=plat,
        campaigns=camp,
        search_campaigns=camp.where(camp["platform"] == search_platform),
        kpis=summary,
        tiles=kpi_tiles(summary),
        spend_share=share_of_total(plat.select("platform", "spend"), "spend", total_out="total_spend"),
        impression_share=share_of_total(
            plat.select("platform", "impressions"), "impressions", total_out="total_impressions"
        ),
        platform_kpis=platform_kpis_long(plat),
        conversions_stacked=stack(series.select("date", "platform", "conversions"), "conversions"),
        ctr=daily_ctr(series),
        best_worst=best_worst(camp, "cpa"),
        leaders=platform_leaders(with_ratios(plat, ["cpm"])),
        below_target=below_target(camp, search_platform),
        funnel_stages=funnel_stages(loaded.funnel) if loaded.funnel is not None else None,
        engagement=engagement_summary(loaded.funnel) if loaded.funnel is not None else None,
        search_table=report_campaign_table(camp, search_platform),
        fact_table=report_fact_table(fact),
    )
