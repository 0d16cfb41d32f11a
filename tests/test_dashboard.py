"""The dashboard flow end to end, parquet materialisation, display headers."""

import contextlib
import io

from pyspark.sql import functions as F

from adfuse.operators import (
    campaign_rollup,
    display_headers,
    filter_fact,
    platform_rollup,
    portfolio_kpis,
    report_campaign_table,
)
from adfuse.operators.present import CAMPAIGN_TABLE_HEADERS
from adfuse.plans import dashboard
from adfuse.sources import CHANNELS, scratch_path
from adfuse.sources.lineitem_feeds import raw_feeds
from conftest import SF_SMALL


def test_load_materialize_and_select(spark):
    feeds = raw_feeds(spark, SF_SMALL)
    loaded = dashboard.load(feeds, CHANNELS, materialize_to=scratch_path(spark, "fact"))
    assert loaded.fact.count() == sum(f.count() for f in feeds.values())

    view = dashboard.select(loaded, platforms=["Google"], date_from="1996-01-01", date_to="1996-12-31")
    # partition pruning on the materialised, platform-partitioned fact
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        view.fact.explain("formatted")
    (pruned,) = [line for line in buf.getvalue().splitlines() if line.startswith("PartitionFilters")]
    assert "(platform#" in pruned and "(fact_month#" in pruned
    assert {r.platform for r in view.platforms.collect()} == {"Google"}
    assert view.series.where(F.col("platform") != "Google").count() == 0
    assert view.series.agg(F.min("date"), F.max("date")).first()[0].year == 1996
    k = view.kpis.first()
    assert k.total_spend == view.platforms.agg(F.sum("spend")).first()[0]
    assert view.tiles.first().roas_tile.endswith("×")
    assert {r.kind for r in view.best_worst.collect()} <= {"best", "worst"}
    ranked = view.cpa_ranking().orderBy("cpa_rank").collect()
    assert [r.cpa_rank for r in ranked] == list(range(1, len(ranked) + 1))
    assert view.funnel_stages.count() == 4 and view.engagement.count() == 1
    assert view.fact_table.count() == view.fact.count()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cube_answers_equal_fact_answers(spark):
    feeds = raw_feeds(spark, SF_SMALL)
    loaded = dashboard.load(feeds, CHANNELS)
    sel = dict(platforms=["Google", "TikTok"], date_from="1995-06-01", date_to="1998-06-30", campaigns=["Camp_2", "Camp_5"])
    view = dashboard.select(loaded, **sel)
    fact = filter_fact(loaded.fact, **sel)
    assert _rows(view.platforms) == _rows(platform_rollup(fact))
    assert _rows(view.campaigns) == _rows(campaign_rollup(fact))
    k = portfolio_kpis(fact).first()
    assert tuple(view.kpis.first())[:7] == tuple(k)
    direct_series = dashboard.series_of(loaded.fact)
    assert _rows(loaded.series) == _rows(direct_series)


def test_display_headers(spark):
    camp = spark.createDataFrame(
        [("Google", "Search_Brand", 1234.5, 10, 5000.0, 123.45, 4.05)],
        "platform string, campaign_name string, spend double, conversions bigint, conv_value double, cpa double, roas double",
    )
    out = display_headers(report_campaign_table(camp), CAMPAIGN_TABLE_HEADERS)
    assert out.columns == ["Campaign", "Spend", "Conv.", "Conv. Value", "CPA", "ROAS"]
    r = out.first()
    assert (r[0], r[1], r[3], r[4], r[5]) == ("Search Brand", "$1,234", "$5,000", "$123.45", "4.05×")


def test_empty_selection(spark):
    loaded = dashboard.load(raw_feeds(spark, SF_SMALL), CHANNELS)
    view = dashboard.select(loaded, platforms=[])
    assert view.platforms.count() == 0 and view.campaigns.count() == 0 and view.series.count() == 0
    k = view.kpis.first()
    assert (k.total_spend, k.total_conversions, k.portfolio_cpa, k.mean_campaign_roas) == (0.0, 0, 0.0, 0.0)
    assert k.pooled_roas is None
    t = view.tiles.first()
    assert (t.spend_tile, t.conversions_tile, t.roas_tile) == ("$0.0K", "0", "0.00×")
    assert view.best_worst.count() == 0 and view.leaders.count() == 0
    assert view.spend_share.count() == 0 and view.fact_table.count() == 0


def _view_tables(view):
    return {k: v for k, v in vars(view).items() if v is not None}


def test_every_table_of_the_view_equals_its_fact_level_twin_with_nulls(spark):
    """Measures that are NULL (a bad cell) add nothing, on either way."""
    from adfuse.functions.ratios import with_ratios
    from adfuse.operators import (
        below_target,
        best_worst,
        daily_ctr,
        kpi_summary,
        kpi_tiles,
        platform_kpis_long,
        platform_leaders,
        report_fact_table,
        share_of_total,
        stack,
    )
    from adfuse.operators.filters import filter_series
    from adfuse.operators.funnel import engagement_summary, funnel_stages, video_funnel

    feeds = raw_feeds(spark, SF_SMALL)
    holes = {
        "facebook": ("spend", "impressions"), "google": ("cost", "conversions", "conversion_value"), "tiktok": ("clicks",),
    }
    for name, columns in holes.items():
        for c in columns:
            gone = (F.dayofmonth("date") % 3 == 0) | (F.year("date") == 1996) & (F.month("date") == 2)
            feeds[name] = feeds[name].withColumn(c, F.when(~gone, F.col(c)))
    sel = dict(platforms=["Google", "Facebook"], date_from="1995-06-01", date_to="1998-06-30", campaigns=["Camp_2", "Camp_5"])
    for target in (None, scratch_path(spark, "nulls")):
        loaded = dashboard.load(feeds, CHANNELS, materialize_to=target)
        view = dashboard.select(loaded, **sel)
        whole = dashboard.conform_all(feeds, CHANNELS)
        fact = filter_fact(whole, **sel)
        series = filter_series(dashboard.series_of(whole), sel["platforms"], sel["date_from"], sel["date_to"])
        plat, camp = platform_rollup(fact), campaign_rollup(fact)
        kpis, funnel = kpi_summary(camp), video_funnel(feeds["tiktok"])
        twins = {
            "fact": fact, "series": series, "platforms": plat, "campaigns": camp,
            "search_campaigns": camp.where("platform = 'Google'"), "kpis": kpis, "tiles": kpi_tiles(kpis),
            "spend_share": share_of_total(plat.select("platform", "spend"), "spend", total_out="total_spend"),
            "impression_share": share_of_total(plat.select("platform", "impressions"), "impressions", total_out="total_impressions"),
            "platform_kpis": platform_kpis_long(plat),
            "conversions_stacked": stack(series.select("date", "platform", "conversions"), "conversions"),
            "ctr": daily_ctr(series), "best_worst": best_worst(camp, "cpa"),
            "leaders": platform_leaders(with_ratios(plat, ["cpm"])), "below_target": below_target(camp, "Google"),
            "funnel_stages": funnel_stages(funnel), "engagement": engagement_summary(funnel),
            "search_table": report_campaign_table(camp, "Google"), "fact_table": report_fact_table(fact),
        }
        tables = _view_tables(view)
        assert set(tables) == set(twins)
        for name, df in tables.items():
            assert df.columns == twins[name].columns, name
            assert sorted(map(str, df.collect())) == sorted(map(str, twins[name].collect())), name


def test_dates_prune_the_materialised_fact(spark):
    loaded = dashboard.load(raw_feeds(spark, SF_SMALL), CHANNELS, materialize_to=scratch_path(spark, "months"))
    view = dashboard.select(loaded, date_from="1996-03-05", date_to="1996-04-02")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        view.fact.explain("formatted")
    assert "PartitionFilters: [isnotnull(fact_month" in buf.getvalue()
    assert view.fact.agg(F.min("date"), F.max("date")).first()[0].isoformat() >= "1996-03-05"
    one = dashboard.select(loaded, date_from="1996-03-05")
    assert {r.date.isoformat() for r in one.fact.select("date").distinct().collect()} <= {"1996-03-05"}
