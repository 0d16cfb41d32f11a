"""Registered queries: one per operator of the inventory, over the test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
three channels carved out of ``lineitem`` (see
``adfuse.sources.lineitem_feeds``), as one tagged table or as separate feeds.  Every query runs over the whole table.
Most are lazy; those that write something first (CSV round trips, the
materialised dashboard, the streaming run, global positions) run jobs while
they are built.
The SQL twin of each query lives in ``adfuse.plans.oracle``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfuse.functions.ratios import with_ratios
from adfuse.operators.conform import conform, conform_all, conform_tagged
from adfuse.operators.filters import filter_fact, filter_series, flag_target
from adfuse.operators.funnel import engagement_summary, funnel_stages, video_funnel
from adfuse.operators.insights import (
    ROAS_TARGET,
    below_target,
    best_per_group,
    best_worst,
    leader,
    platform_leaders,
    rank_campaigns,
    top_campaigns,
)
from adfuse.operators.present import (
    campaign_labels,
    cpa_chart,
    engagement_tiles,
    kpi_tiles,
    platform_kpis_long,
    report_campaign_table,
    report_fact_table,
    roas_chart,
)
from adfuse.operators.rollups import (
    campaign_day_rollup,
    campaign_names,
    campaign_rollup,
    daily_ctr,
    daily_rollup,
    date_extent,
    kpi_summary,
    mean_campaign_roas,
    platform_cpm,
    platform_rollup,
    portfolio_kpis,
)
from adfuse.operators.windows import (
    global_row_number,
    refresh_rolling_mean,
    rolling_mean,
    share_of_total,
    stack,
)
from adfuse.plans import dashboard
from adfuse.plans.cube import Export, read_cube, refresh_cube
from adfuse.plans.dashboard import series_of
from adfuse.sources.channels import CHANNELS, FACEBOOK, GOOGLE, TIKTOK, WEB
from adfuse.sources.event_feed import web_feed
from adfuse.sources.lineitem_feeds import (
    CHANNEL,
    FLAG_OF_FEED,
    channel_feed,
    channel_table,
    faulty_search_lines,
    lineitem,
    raw_feeds,
    search_feed,
    social_feed,
    video_feed,
)
from adfuse.sources.ordered import export_ordered_csv, store_pages
from adfuse.sources.readers import checked, feed_quality, read_feed, rejected_rows
from adfuse.sources.sinks import export_csv, materialize, read_csv_typed
from adfuse.sources.storage import remove_folder, scratch_path
from adfuse.sources.tables import read_table_stream
from adfuse.streaming.by_file import read_rollup, start_rollup_by_file
from adfuse.streaming.daily import read_daily_rollup, write_daily_rollup

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed query parameters (the oracle SQL uses the same literals).
SEL_PLATFORMS = ["Google", "TikTok"]
SEL_FROM, SEL_TO = "1996-01-01", "1996-12-31"
SEL_CAMPAIGNS = ["Camp_1", "Camp_3"]
SEARCH_PLATFORM = "Google"
TOP_N = 5
PAGE, PAGE_SIZE = 3, 250
#: Names that a CSV has to quote, by campaign; one of them is empty and one NULL.
ODD_NAMES = r"""CASE campaign_id WHEN 'c1' THEN 'a "quoted" name' WHEN 'c2' THEN ' blanks, and commas '
  WHEN 'c3' THEN concat('two', chr(10), 'lines') WHEN 'c4' THEN '' WHEN 'c5' THEN NULL
  WHEN 'c6' THEN concat('"', chr(92), '"') ELSE campaign_name END"""


def fact(spark: SparkSession, sf_dir: str, platforms: list[str] | None = None) -> DataFrame:
    """The unified fact of the channels that lie in lineitem, in one scan; a choice of platforms reaches it."""
    specs = {flag: CHANNELS[c] for c, flag in FLAG_OF_FEED.items()}
    return conform_tagged(channel_table(lineitem(spark, sf_dir)), CHANNEL, specs, platforms)


def series(spark: SparkSession, sf_dir: str, frame: str = "rows") -> DataFrame:
    return series_of(fact(spark, sf_dir), 7, frame)


def camp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign_rollup(fact(spark, sf_dir))


# --- scan / conform / union ---------------------------------------------------
def _from_csv(spark: SparkSession, sf_dir: str, channel: str) -> DataFrame:
    """A channel's feed written as CSV and read back, every declared column typed."""
    path = export_csv(channel_feed(lineitem(spark, sf_dir), channel), scratch_path(spark, f"csv-{channel}"))
    return read_feed(spark, CHANNELS[channel], path, "csv")


def q_scan_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed CSV read by header name, after writing the search feed as CSV."""
    return _from_csv(spark, sf_dir, "google")


def q_scan_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_csv(spark, sf_dir, "facebook")


def q_scan_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as ``scan_feed``, from a file without header."""
    feed = search_feed(lineitem(spark, sf_dir)).select(*GOOGLE.source_types)
    path = scratch_path(spark, "csv-no-header")
    feed.write.csv(path)
    return read_feed(spark, GOOGLE, path, "csv", header=False)


def q_scan_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_csv(spark, sf_dir, "tiktok")


def q_csv_platform_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From three CSV exports to the platform roll-up."""
    return platform_rollup(conform_all({c: _from_csv(spark, sf_dir, c) for c in CHANNELS}, CHANNELS))


def q_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged lines of a CSV feed: wrong numbers of cells, and cells that do not parse."""
    path = scratch_path(spark, "faulty-csv")
    faulty_search_lines(lineitem(spark, sf_dir)).write.text(path)
    return rejected_rows(spark, GOOGLE, path, header=False).drop("line")


def _moved_exports(spark: SparkSession, sf_dir: str, channel: str) -> str:
    """A channel's feed as three CSV exports whose columns stand in different orders."""
    li, root = lineitem(spark, sf_dir), scratch_path(spark, f"moved-{channel}")
    for k in range(3):
        feed = channel_feed(li.where(f"l_orderkey % 3 = {k}"), channel)
        turn = len(feed.columns) * k // 3
        export_csv(feed.select(*feed.columns[turn:], *feed.columns[:turn]), f"{root}/export-{k}")
    return root


def q_scan_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed from files with three column orders: a scan for each header, united by name."""
    return read_feed(spark, GOOGLE, _moved_exports(spark, sf_dir, "google"), "csv", mixed_headers=True)


def q_feed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and cells that the totals miss, by feed; counted in the pass that computes the totals."""
    faulty = scratch_path(spark, "faulty-totals")
    faulty_search_lines(lineitem(spark, sf_dir)).write.text(faulty)
    feeds, counts = {}, {}
    for c in CHANNELS:
        path = faulty if c == "google" else export_csv(channel_feed(lineitem(spark, sf_dir), c), scratch_path(spark, c))
        feeds[c], counts[c] = checked(spark, CHANNELS[c], path, keep_bad=False, header=c != "google")
    platform_rollup(conform_all(feeds, CHANNELS)).write.parquet(scratch_path(spark, "totals"))
    return feed_quality(spark, counts)


def q_conform_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(social_feed(lineitem(spark, sf_dir)), FACEBOOK)


def q_conform_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(search_feed(lineitem(spark, sf_dir)), GOOGLE)


def q_conform_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(video_feed(lineitem(spark, sf_dir)), TIKTOK)


def q_unified_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir)


def q_platform_rollup_with_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fourth channel (web events) joins the fact by spec only."""
    feeds = {**raw_feeds(spark, sf_dir), "web": web_feed(spark, sf_dir)}
    return platform_rollup(conform_all(feeds, {**CHANNELS, "web": WEB}))


def q_unified_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by platform of the union of three separate feeds."""
    whole = conform_all(raw_feeds(spark, sf_dir), CHANNELS)
    return whole.groupBy("platform").agg(F.count(F.lit(1)).alias("n_rows"))


# --- filters --------------------------------------------------------------------
def q_filter_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_fact(fact(spark, sf_dir, SEL_PLATFORMS), platforms=SEL_PLATFORMS)


def q_filter_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_fact(fact(spark, sf_dir), date_from=SEL_FROM, date_to=SEL_TO)


def q_filter_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_fact(fact(spark, sf_dir), campaigns=SEL_CAMPAIGNS)


def q_filter_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_fact(fact(spark, sf_dir, SEL_PLATFORMS), SEL_PLATFORMS, SEL_FROM, SEL_TO, SEL_CAMPAIGNS)


def q_filter_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_series(series(spark, sf_dir), SEL_PLATFORMS, SEL_FROM, SEL_TO)


# --- roll-ups -------------------------------------------------------------------
def q_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_rollup(fact(spark, sf_dir))


def q_daily_rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily roll-up maintained by a Structured Streaming job (one
    ``availableNow`` run over lineitem as a file stream)."""
    li = read_table_stream(spark, sf_dir, "lineitem")
    stream_fact = conform_all({n: channel_feed(li, n) for n in FLAG_OF_FEED}, CHANNELS)
    root = scratch_path(spark, "daily-incremental")
    write_daily_rollup(stream_fact, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return read_daily_rollup(spark, f"{root}/out")


def q_daily_rollup_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily roll-up maintained from landing CSV files whose headers differ (two streaming runs)."""
    sources = [(CHANNELS[c], _moved_exports(spark, sf_dir, c), "csv") for c in CHANNELS]
    out = scratch_path(spark, "daily-by-file")
    for _ in range(2):  # the second run finds nothing new
        start_rollup_by_file(spark, sources, out, max_files_per_trigger=20).awaitTermination()
    return read_rollup(spark, out)[0]


def q_refreshed_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaign-day table after files were added, replaced and deleted, from the changed files only."""
    li, root = lineitem(spark, sf_dir), scratch_path(spark, "refreshed")
    exports = [Export(CHANNELS[c], f"{root}/exports/{c}", "parquet") for c in CHANNELS]

    def write(rows: str, batch: str, clicks: str = "clicks") -> None:
        for c in CHANNELS:
            feed = channel_feed(li.where(rows), c).withColumn("clicks", F.expr(clicks))
            feed.write.parquet(f"{root}/exports/{c}/{batch}")

    write("l_orderkey % 2 = 0", "even")
    write("l_orderkey % 4 = 1", "first-count", "clicks + 1")
    write("l_orderkey % 8 = 1", "sent-twice")
    refresh_cube(spark, exports, f"{root}/cube")
    for c in CHANNELS:
        remove_folder(spark, f"{root}/exports/{c}/first-count")
        remove_folder(spark, f"{root}/exports/{c}/sent-twice")
    write("l_orderkey % 4 = 1", "corrected")
    write("l_orderkey % 4 = 3", "late")
    refresh_cube(spark, exports, f"{root}/cube")
    return read_cube(spark, f"{root}/cube")


def q_platform_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return platform_rollup(fact(spark, sf_dir))


def q_campaign_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camp(spark, sf_dir)


def q_platform_cpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return platform_cpm(fact(spark, sf_dir))


def q_daily_ctr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_ctr(daily_rollup(fact(spark, sf_dir)))


def q_portfolio_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio_kpis(fact(spark, sf_dir))


def q_kpi_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Totals and the ROAS mean come from one campaign roll-up in one aggregate.
    return kpi_tiles(kpi_summary(campaign_rollup(fact(spark, sf_dir), exact=True), SEARCH_PLATFORM))


def q_mean_campaign_roas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_campaign_roas(fact(spark, sf_dir, [SEARCH_PLATFORM]), SEARCH_PLATFORM)


def q_date_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_extent(fact(spark, sf_dir))


def q_campaign_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = campaign_names(fact(spark, sf_dir))
    return global_row_number(names, [F.col("campaign_name").asc_nulls_last()], "position")


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_fact(fact(spark, sf_dir, SEL_PLATFORMS), SEL_PLATFORMS, SEL_FROM, SEL_TO, SEL_CAMPAIGNS)


def q_filtered_campaign_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign roll-up of the filtered fact; the filter reaches the scans."""
    return campaign_rollup(_selected(spark, sf_dir))


def q_filtered_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI row (totals, ratios, search-channel ROAS) of the filtered selection."""
    return kpi_summary(campaign_rollup(_selected(spark, sf_dir), exact=True), SEARCH_PLATFORM)


def q_campaign_day_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign_day_rollup(fact(spark, sf_dir))


def q_materialized_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's cached path: fact, campaign-day table and funnel written
    once as parquet, read back, filtered, rolled up."""
    root = scratch_path(spark, "materialized")
    loaded = dashboard.load(raw_feeds(spark, sf_dir), CHANNELS, materialize_to=root)
    return dashboard.select(loaded, SEL_PLATFORMS, SEL_FROM, SEL_TO, SEL_CAMPAIGNS, SEARCH_PLATFORM).campaigns


def q_cached_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selection from tables that an earlier call cached; no feed is read for it."""
    root, inputs = scratch_path(spark, "cache"), [f"{sf_dir.rstrip('/')}/lineitem.parquet"]
    dashboard.load_cached(spark, lambda: raw_feeds(spark, sf_dir), CHANNELS, inputs, root)

    def no_feeds():
        raise AssertionError("the cached tables were not found again")

    loaded = dashboard.load_cached(spark, no_feeds, CHANNELS, inputs, root)
    return dashboard.select(loaded, SEL_PLATFORMS, SEL_FROM, SEL_TO, SEL_CAMPAIGNS, SEARCH_PLATFORM).campaigns


def q_empty_selection_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI row of a selection without rows: zeros, and no pooled ROAS."""
    none = filter_fact(fact(spark, sf_dir), date_from="2200-01-01", date_to="2200-12-31")
    return kpi_summary(campaign_rollup(none, exact=True), SEARCH_PLATFORM)


# --- windows / shares / funnel ----------------------------------------------------
def q_spend_rolling_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir, "rows")


def q_spend_series_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series with each row's position by date and platform."""
    order = [F.col("date").asc_nulls_last(), F.col("platform").asc_nulls_last()]
    return global_row_number(series(spark, sf_dir), order, "position")


def q_spend_rolling_7_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir, "days")


def q_spend_rolling_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trailing mean after days came late and others were corrected, from an earlier result."""
    whole = materialize(daily_rollup(fact(spark, sf_dir)), scratch_path(spark, "daily"))
    late, first = F.dayofmonth("date") == 3, F.dayofmonth("date") == 17
    early = whole.where(~late).withColumn("spend", F.when(first, F.col("spend") + 1).otherwise(F.col("spend")))
    before = materialize(rolling_mean(early, "spend", 7, "rows", out="spend_7d_avg"), scratch_path(spark, "series"))
    changed = whole.where(late | first).select("platform", "date")
    return refresh_rolling_mean(before, whole, changed, "spend", 7, "rows", out="spend_7d_avg")


def q_spend_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    plat = platform_rollup(fact(spark, sf_dir)).select("platform", "spend")
    return share_of_total(plat, "spend", total_out="total_spend")


def q_impression_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    plat = platform_rollup(fact(spark, sf_dir)).select("platform", "impressions")
    return share_of_total(plat, "impressions", total_out="total_impressions")


def q_conversions_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_rollup(fact(spark, sf_dir)).select("date", "platform", "conversions")
    return stack(daily, "conversions")


def _funnel(spark: SparkSession, sf_dir: str):
    return video_funnel(video_feed(lineitem(spark, sf_dir)))


def q_video_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _funnel(spark, sf_dir)


def q_funnel_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel_stages(_funnel(spark, sf_dir))


def q_engagement_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engagement_summary(_funnel(spark, sf_dir))


def q_engagement_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engagement_tiles(engagement_summary(_funnel(spark, sf_dir)))


# --- ranks / insights --------------------------------------------------------------
def q_campaign_cpa_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_campaigns(camp(spark, sf_dir), "cpa")


def q_top_n_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_campaigns(camp(spark, sf_dir), "cpa", TOP_N)


def q_best_worst_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_worst(camp(spark, sf_dir), "cpa")


def q_best_campaign_per_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_per_group(camp(spark, sf_dir), ["platform"], "cpa")


def _search_campaigns(spark: SparkSession, sf_dir: str):
    return campaign_rollup(fact(spark, sf_dir, [SEARCH_PLATFORM]))


def q_roas_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _search_campaigns(spark, sf_dir).select("campaign_name", "spend", "conv_value", "roas", "cpa")
    order = [F.col("roas").desc_nulls_last(), F.col("campaign_name").asc_nulls_last()]
    return global_row_number(g, order, "roas_rank")


def q_roas_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROAS bars: order, label, value, text and target flag in one table."""
    return roas_chart(q_roas_table(spark, sf_dir), ROAS_TARGET)


def q_cpa_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CPA bars: order, label, value and text in one table."""
    return cpa_chart(rank_campaigns(camp(spark, sf_dir), "cpa"))


def q_roas_target_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _search_campaigns(spark, sf_dir).select("campaign_name", "roas")
    return flag_target(g, "roas", ROAS_TARGET)


def q_roas_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leader(camp(spark, sf_dir), "roas", largest=True)


def q_below_target_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return below_target(camp(spark, sf_dir), SEARCH_PLATFORM)


def q_conversion_leader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leader(camp(spark, sf_dir), "conversions", largest=True)


def q_platform_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return platform_leaders(with_ratios(platform_rollup(fact(spark, sf_dir)), ["cpm"]))


# --- presentation / sink --------------------------------------------------------------
def q_platform_kpis_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return platform_kpis_long(platform_rollup(fact(spark, sf_dir)))


def q_campaign_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign_labels(camp(spark, sf_dir))


def q_report_campaign_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_campaign_table(camp(spark, sf_dir), SEARCH_PLATFORM)


def q_report_fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_fact_table(fact(spark, sf_dir))


def q_export_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV round trip of names with quotes, commas, blanks, line breaks and empty texts."""
    odd = F.expr(ODD_NAMES)
    path = export_csv(fact(spark, sf_dir).withColumn("campaign_name", odd), scratch_path(spark, "export-text"))
    return read_csv_typed(spark, path)


def q_ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified fact as one CSV in ordered parts, read back from the parts behind its header."""
    path = scratch_path(spark, "ordered-export")
    parts = export_ordered_csv(fact(spark, sf_dir), path, ["date", "platform", "campaign_name"])
    header = [r["path"] for r in parts.where("place > 0").collect()]
    return read_csv_typed(spark, header, header=False)


def q_fact_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourth page of the raw table, from the one or two parts that hold it."""
    paged = store_pages(fact(spark, sf_dir), scratch_path(spark, "pages"), ["date", "platform", "campaign_name"])
    return paged.page(spark, PAGE, PAGE_SIZE)


def q_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the unified fact as CSV and read it back typed by header."""
    path = export_csv(fact(spark, sf_dir), scratch_path(spark, "export"))
    return read_csv_typed(spark, path)


QUERIES: dict[str, QueryFn] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
