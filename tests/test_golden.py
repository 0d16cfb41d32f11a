"""Golden values of the original three CSV exports (January 2024).

The exports are not part of this repository; point ADFUSE_CSV_DIR at a folder
holding them (file names containing facebook / google / tiktok).
"""

import glob
import os

import pytest

from adfuse.functions.ratios import with_ratios
from adfuse.operators import (
    best_per_group,
    best_worst,
    campaign_rollup,
    conform_all,
    engagement_summary,
    leader,
    mean_campaign_roas,
    platform_leaders,
    platform_rollup,
    portfolio_kpis,
    rank_campaigns,
    video_funnel,
)
from adfuse.plans.dashboard import series_of
from adfuse.sources import CHANNELS, read_feed

CSV_DIR = os.environ.get("ADFUSE_CSV_DIR")


@pytest.fixture(scope="module")
def feeds(spark):
    out = {}
    for name, spec in CHANNELS.items():
        (path,) = glob.glob(os.path.join(CSV_DIR, f"*{name}*.csv"))
        out[name] = read_feed(spark, spec, path, "csv")
    return out


@pytest.fixture(scope="module")
def fact(feeds):
    return conform_all(feeds, CHANNELS).cache()


def approx(x, rel=1e-5):
    return pytest.approx(x, rel=rel)


def test_row_count(fact):
    assert fact.count() == 330


def test_platform_rollup(fact):
    p = {r.platform: r for r in platform_rollup(fact).collect()}
    assert (p["Facebook"].impressions, p["Facebook"].clicks, p["Facebook"].conversions) == (4541474, 88899, 2395)
    assert p["Facebook"].spend == approx(18292.00) and p["Facebook"].cpa == approx(7.6375783)
    assert p["Google"].conv_value == approx(210900) and p["Google"].cpc == approx(0.2739022)
    assert p["TikTok"].social_eng == approx(1507959) and p["TikTok"].video_views == approx(23122559)
    assert p["TikTok"].ctr == approx(0.0160875) and p["Facebook"].conv_value == 0.0


def test_daily_series(fact):
    s = {(str(r.date), r.platform): r for r in series_of(fact).collect()}
    assert len(s) == 90
    assert s[("2024-01-07", "Facebook")].spend_7d_avg == approx(508.828571)
    assert s[("2024-01-07", "Google")].spend_7d_avg == approx(1034.357143)
    assert s[("2024-01-30", "TikTok")].spend == approx(2967.7)
    assert s[("2024-01-30", "TikTok")].spend_7d_avg == approx(2977.371429)


def test_funnel_and_engagement(feeds):
    f = video_funnel(feeds["tiktok"]).first()
    assert (f.views_total, f.w25, f.w50, f.w75, f.w100) == (23122559, 18086889, 13282329, 9184774, 6004867)
    assert (f.likes, f.shares, f.comments) == (1117850, 312694, 77415)
    e = engagement_summary(video_funnel(feeds["tiktok"])).first()
    assert e.completion_rate_pct == approx(25.97, rel=1e-3)


def test_kpis(fact):
    k = portfolio_kpis(fact).first()
    assert k.portfolio_ctr_pct == approx(1.700714) and k.portfolio_cpc == approx(0.1892179)
    assert k.portfolio_cpa == approx(9.74668) and k.total_conversions == 13363
    r = mean_campaign_roas(fact).first()
    assert r.mean_campaign_roas == approx(6.213747) and r.pooled_roas == approx(5.596213)


def test_insights(fact):
    camp = campaign_rollup(fact)
    bw = {r.kind: r for r in best_worst(camp, "cpa").collect()}
    assert bw["best"].campaign_name == "Search_Brand_Terms" and bw["best"].cpa == approx(5.09903)
    assert bw["worst"].campaign_name == "Search_Generic_Terms" and bw["worst"].cpa == approx(24.79888)
    top = leader(camp, "roas").first()
    assert top.campaign_name == "Search_Brand_Terms" and top.roas == approx(9.80578)
    generic = camp.where("campaign_name = 'Search_Generic_Terms'").first()
    assert generic.roas == approx(2.01622) and generic.spend == approx(15548.90)
    assert leader(camp, "conversions").first().conversions == 2653
    best_fb = {r.platform: r for r in best_per_group(camp, ["platform"], "cpa").collect()}["Facebook"]
    assert best_fb.cpa == approx(5.95421)
    lead = {r.leader: r for r in platform_leaders(with_ratios(platform_rollup(fact), ["cpm"])).collect()}
    assert lead["most_conversions"].platform == "TikTok" and lead["most_conversions"].value == 6750
    assert lead["lowest_cpm"].platform == "TikTok" and lead["lowest_cpm"].value == approx(2.58695)


def test_cpa_order(fact):
    ranked = rank_campaigns(campaign_rollup(fact), "cpa").orderBy("cpa_rank")
    assert [r.campaign_name for r in ranked.collect()] == [
        "Search_Brand_Terms", "Conversions_Retargeting", "Shopping_All_Products", "Traffic_Drive_Jan",
        "Brand_Awareness_Q1", "Display_Remarketing", "Influencer_Collab", "Conversion_Focus",
        "Awareness_GenZ", "Traffic_Campaign", "Video_Views_Campaign", "Search_Generic_Terms",
    ]


def test_kpi_tiles_text(fact):
    from adfuse.operators import campaign_rollup, kpi_summary, kpi_tiles

    t = kpi_tiles(kpi_summary(campaign_rollup(fact))).first()
    assert (t.spend_tile, t.conversions_tile, t.impressions_tile) == ("$130.2K", "13,363", "40.5M")
    assert (t.cpa_tile, t.ctr_tile, t.roas_tile) == ("$9.75", "1.70%", "6.21×")
