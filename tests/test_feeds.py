"""Feeds that are wrong or unusual: nothing may be lost or changed silently."""

import csv
import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfuse.operators import conform, conform_all, kpi_summary, platform_rollup
from adfuse.schema import FACT_SCHEMA
from adfuse.sources import (
    CHANNELS,
    GOOGLE,
    FeedSpec,
    export_csv,
    read_csv_typed,
    read_feed,
    rejected_rows,
    remove_scratch,
    scratch_path,
)
from adfuse.sources.tables import read_table_stream

D = dt.date
RAW = "date date, campaign_id string, campaign_name string, impressions bigint, clicks bigint, cost double, conversions bigint"


def raw(spark, **more):
    names = ", ".join([RAW, *[f"{k} double" for k in more]])
    return spark.createDataFrame([(D(2024, 1, 1), "c", "A", 100, 5, 2.5, 1, *more.values())], names)


# --- a spec that does not fit raises; it never turns a measure into zeros ----------
def test_mistyped_rename_source(spark):
    spec = FeedSpec(name="typo", platform="X", rename={"cots": "spend"})
    with pytest.raises(ValueError, match="typo.*cots"):
        conform(raw(spark), spec)


@pytest.mark.parametrize("wrong", [{"rename": {"cost": "spnd"}}, {"derived": {"spnd": "cost"}}])
def test_unknown_target(wrong):
    with pytest.raises(ValueError, match="typo.*spnd"):
        FeedSpec(name="typo", platform="X", **wrong)


def test_two_sources_for_one_column(spark):
    with pytest.raises(ValueError, match="spend"):
        FeedSpec(name="two", platform="X", rename={"cost": "spend", "fee": "spend"})
    with pytest.raises(ValueError, match="spend"):
        FeedSpec(name="two", platform="X", rename={"cost": "spend"}, derived={"spend": "cost * 2"})
    with pytest.raises(ValueError, match="spend"):
        conform(raw(spark, spend=9.0), FeedSpec(name="two", platform="X", rename={"cost": "spend"}))


def test_good_rename_still_conforms(spark):
    assert conform(raw(spark), FeedSpec(name="ok", platform="X", rename={"cost": "spend"})).first().spend == 2.5


# --- text that needs escaping ------------------------------------------------------
def test_literals_with_quotes(spark):
    spec = FeedSpec(name="q", platform="O'Brien \\ Co", rename={"cost": "spend"}, date_format="yyyy-MM-dd'T'HH:mm:ss")
    text = raw(spark).selectExpr("* EXCEPT (date)", "concat(date, 'T10:00:00') AS date")
    row = conform(text, spec).first()
    assert row.platform == "O'Brien \\ Co" and row.date == D(2024, 1, 1)
    camp = spark.createDataFrame(
        [("O'Brien", "x", 10.0, 1, 5, 100, 30.0, 3.0), ("Other", "y", 1.0, 1, 5, 100, 1.0, 1.0)],
        "platform string, campaign_name string, spend double, conversions bigint, clicks bigint, impressions bigint, "
        "conv_value double, roas double",
    )
    k = kpi_summary(camp, "O'Brien").first()
    assert (k.mean_campaign_roas, k.pooled_roas, k.total_spend) == (3.0, 3.0, 11.0)


def test_roas_is_not_rounded(spark):
    camp = spark.createDataFrame(
        [("G", 3.0, 1, 1, 1, 1.0, 1 / 3)],
        "platform string, spend double, conversions bigint, clicks bigint, impressions bigint, conv_value double, roas double",
    )
    assert kpi_summary(camp, "G").first().mean_campaign_roas == 1 / 3


# --- damaged CSV ---------------------------------------------------------------------
SPEC = FeedSpec(
    name="x", platform="X", source_types={"date": "date", "campaign_id": "string", "spend": "double", "conversions": "bigint"}
)
LINES = [
    "2024-01-01,good,1.5,3",
    "2024-01-02,short,2.5",
    "2024-01-03,long,3.5,1,9",
    "2024-01-04,fraction,4.5,12.5",
    "2024-01-05,text,n/a,2",
    "2024-13-06,date,5.5,2",
    "2024-01-07,blank,,",
]


@pytest.fixture
def damaged(tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(["date,campaign_id,spend,conversions", *LINES]) + "\n")
    return str(tmp_path / "a.csv")


def test_damaged_rows_are_flagged_by_default(spark, damaged):
    rows = {r.campaign_id: r for r in read_feed(spark, SPEC, damaged).collect()}
    assert len(rows) == len(LINES)
    assert {k for k, r in rows.items() if r.bad_row} == {"short", "long", "fraction", "text", "date"}
    assert rows["good"].spend == 1.5 and rows["blank"].spend is None
    # The flag does not depend on which columns are read.
    some = read_feed(spark, SPEC, damaged, columns=["campaign_id", "date"])
    assert {r.campaign_id for r in some.where("bad_row").collect()} == {"short", "long", "date"}


def test_damaged_rows_can_fail_or_be_ignored(spark, damaged):
    with pytest.raises(Exception, match="bad row"):
        read_feed(spark, SPEC, damaged, on_bad="fail").collect()
    assert read_feed(spark, SPEC, damaged, on_bad="ignore").columns == list(SPEC.source_types)
    with pytest.raises(ValueError, match="on_bad"):
        read_feed(spark, SPEC, damaged, on_bad="drop")


def test_rejected_rows_say_what_is_wrong(spark, damaged):
    out = {r.campaign_id: r for r in rejected_rows(spark, SPEC, damaged).collect()}
    assert {k: (r.wrong_cell_count, r.bad_columns) for k, r in out.items()} == {
        "short": (True, ""), "long": (True, ""), "fraction": (False, "conversions"),
        "text": (False, "spend"), "date": (False, "date"),
    }
    assert out["long"].line == LINES[2]


# --- CSV that survives any text -------------------------------------------------------
NAMES = [
    "plain", 'a "quoted" name', "comma, name", " lead", "trail ", "", "new\nline", "cr\r\nlf", None, "back\\slash",
    '"', '""', '\\"', "tab\t", "naïve 🙂",
]
NAMED = T.StructType([T.StructField("campaign_name", T.StringType()), T.StructField("spend", T.DoubleType())])


def test_export_round_trip_of_any_text(spark, tmp_path):
    df = spark.createDataFrame([(n, float(k)) for k, n in enumerate(NAMES)], NAMED)
    path = export_csv(df.coalesce(1), str(tmp_path / "out"))
    back = {r.spend: r.campaign_name for r in read_csv_typed(spark, path, NAMED).collect()}
    assert back == {float(k): n for k, n in enumerate(NAMES)}
    (file,) = (tmp_path / "out").glob("*.csv")
    with open(file, newline="", encoding="utf-8") as f:  # as other tools read it
        rows = list(csv.reader(f))
    assert rows[0] == ["campaign_name", "spend"]
    assert [r[0] for r in rows[1:]] == [n or "" for n in NAMES]


def test_export_bounds_files(spark, tmp_path):
    df = spark.range(100).selectExpr("cast(id as string) as campaign_name", "double(id) as spend").coalesce(1)
    path = export_csv(df, str(tmp_path / "out"), rows_per_file=30)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 4 and read_csv_typed(spark, path, NAMED).count() == 100


# --- three channels from files, with values worked out by hand ---------------------------
EXPORTS = {
    "facebook": """date,campaign_id,campaign_name,ad_set_id,ad_set_name,impressions,clicks,spend,conversions,video_views,engagement_rate,reach,frequency
2024-03-01,f1,Brand_One,s1,Set,1000,50,100.0,10,400,0.1,900,1.1
2024-03-02,f1,Brand_One,s1,Set,3000,150,100.0,0,600,0.1,900,1.1
""",
    "google": """date,campaign_id,campaign_name,ad_group_id,ad_group_name,impressions,clicks,cost,conversions,conversion_value,ctr,avg_cpc,quality_score,search_impression_share
2024-03-01,g1,Search_One,a1,Group,2000,100,50.0,5,400.0,0.05,0.51,7,0.5
2024-03-02,g2,"Search, Two",a1,Group,2000,100,150.0,5,300.0,0.05,1.49,8,0.4
""",
    "tiktok": """date,campaign_id,campaign_name,adgroup_id,adgroup_name,impressions,clicks,cost,conversions,video_views,video_watch_25,video_watch_50,video_watch_75,video_watch_100,likes,shares,comments
2024-03-01,t1,Clip_One,b1,Group,10000,200,40.0,4,5000,4000,3000,2000,1000,300,90,10
""",
}


@pytest.fixture
def exports(spark, tmp_path):
    feeds = {}
    for name, text in EXPORTS.items():
        (tmp_path / f"{name}.csv").write_text(text)
        feeds[name] = read_feed(spark, CHANNELS[name], str(tmp_path / f"{name}.csv"))
    return feeds


def test_three_exports_by_hand(spark, exports):
    from adfuse.operators import engagement_summary, kpi_tiles, mean_campaign_roas, video_funnel
    from adfuse.operators import campaign_rollup
    from adfuse.plans.dashboard import series_of

    assert not any(df.where("bad_row").count() for df in exports.values())
    fact = conform_all(exports, CHANNELS)
    assert fact.schema.names == FACT_SCHEMA.names and fact.count() == 5
    p = {r.platform: r for r in platform_rollup(fact).collect()}
    assert (p["Facebook"].spend, p["Facebook"].cpa, p["Facebook"].ctr) == (200.0, 20.0, 0.05)
    assert (p["Google"].spend, p["Google"].conv_value, p["Google"].cpc) == (200.0, 700.0, 1.0)
    assert (p["TikTok"].social_eng, p["TikTok"].video_views) == (400.0, 5000.0)
    rows = {(r.campaign_name, r.date.day): r for r in fact.collect()}
    assert rows["Search_One", 1].cpc == 0.51 and rows["Search, Two", 2].roas == 2.0  # reported, and worked out
    assert rows["Clip_One", 1].vid_compl_rate == 0.2 and rows["Brand_One", 2].cpa is None
    s = {(r.platform, r.date.day): r.spend_7d_avg for r in series_of(fact).collect()}
    assert s["Google", 1] == 50.0 and s["Google", 2] == 100.0
    r = mean_campaign_roas(fact).first()
    assert (r.mean_campaign_roas, r.pooled_roas) == (5.0, 3.5)
    e = engagement_summary(video_funnel(exports["tiktok"])).first()
    assert (e.total_engagements, e.completion_rate_pct, e.share_to_like_pct, e.high_amplification) == (400, 20.0, 30.0, True)
    t = kpi_tiles(kpi_summary(campaign_rollup(fact))).first()
    assert (t.spend_tile, t.conversions_tile, t.roas_tile, t.total_conversions) == ("$0.4K", "24", "5.00×", 24)


def test_insights_and_orders_by_hand(spark, exports):
    from adfuse.functions.ratios import with_ratios
    from adfuse.operators import (
        below_target, best_per_group, best_worst, campaign_names, campaign_rollup, daily_rollup, global_row_number, leader,
        platform_leaders, rank_campaigns, share_of_total, stack, top_campaigns,
    )
    from adfuse.operators.insights import ROAS_TARGET

    fact = conform_all(exports, CHANNELS)
    camp, plat = campaign_rollup(fact), platform_rollup(fact)
    cpa = {r.campaign_name: r.cpa for r in camp.collect()}
    assert cpa == {"Brand_One": 20.0, "Search_One": 10.0, "Search, Two": 30.0, "Clip_One": 10.0}
    # I1, I3: two campaigns cost 10 a conversion; the first platform by name wins.
    assert {r.kind: (r.platform, r.campaign_name) for r in best_worst(camp).collect()} == {
        "best": ("Google", "Search_One"), "worst": ("Google", "Search, Two"),
    }
    assert {r.platform: r.campaign_name for r in best_per_group(camp).collect()} == {
        "Facebook": "Brand_One", "Google": "Search_One", "TikTok": "Clip_One",
    }
    # I4, I6
    r = leader(camp, "roas").first()
    assert (r.campaign_name, r.roas) == ("Search_One", 8.0)
    assert leader(camp, "conversions").first().campaign_name == "Brand_One"
    # I5
    (r,) = below_target(camp, "Google").collect()
    assert (r.campaign_name, r.roas, r.spend, r.gap_to_target) == ("Search, Two", 2.0, 150.0, ROAS_TARGET - 2.0)
    # I7: ten conversions each on two platforms; 40 for 10,000 impressions.
    found = {r.leader: (r.platform, r.value) for r in platform_leaders(with_ratios(plat, ["cpm"])).collect()}
    assert found == {"most_conversions": ("Facebook", 10.0), "lowest_cpm": ("TikTok", 4.0)}
    # Orders
    names = [r.campaign_name for r in rank_campaigns(camp).orderBy("cpa_rank").collect()]
    assert names == ["Search_One", "Clip_One", "Brand_One", "Search, Two"]
    assert [r.campaign_name for r in top_campaigns(camp, n=2).orderBy("rank").collect()] == names[:2]
    by_name = global_row_number(campaign_names(fact), [F.col("campaign_name").asc_nulls_last()], "n").orderBy("n")
    assert [r.campaign_name for r in by_name.collect()] == ["Brand_One", "Clip_One", "Search, Two", "Search_One"]
    google = camp.where("platform = 'Google'")
    ranked = global_row_number(google, [F.col("roas").desc_nulls_last()], "n").orderBy("n")
    assert [r.roas for r in ranked.collect()] == [8.0, 2.0]
    share = share_of_total(plat.select("platform", "spend"), "spend", total_out="all")
    assert {r.platform: (r.spend / r["all"], r["all"]) for r in share.collect()}["TikTok"] == (40 / 440, 440.0)
    top = stack(daily_rollup(fact).select("date", "platform", "conversions"), "conversions").where("date = '2024-03-01'")
    assert max(v for row in top.collect() for v in row if isinstance(v, int)) == 10 + 5 + 4


# --- files ------------------------------------------------------------------------------
def test_stream_reads_exactly_its_table(spark, tmp_path):
    from conftest import SF_SMALL

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(10)
    for name in ("lineitem.parquet", "lineitem.parquet.bak", "lineitem.parquet2"):
        li.write.parquet(str(tmp_path / name))
    out, root = [], str(tmp_path)
    q = read_table_stream(spark, root, "lineitem").writeStream.foreachBatch(lambda b, _: out.append(b.count()))
    q.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start().awaitTermination(60)
    assert sum(out) == 10
    q = read_table_stream(spark, SF_SMALL, "lineitem").writeStream.foreachBatch(lambda b, _: out.append(b.count()))
    q.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck2")).start().awaitTermination(60)
    assert sum(out) == 10 + spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_scratch_is_removed_on_request_only(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert remove_scratch(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        remove_scratch(spark, str(tmp_path))


def test_read_feed_of_a_file_without_header(spark, tmp_path):
    (tmp_path / "n.csv").write_text("\n".join(LINES[:1]) + "\n")
    (row,) = read_feed(spark, SPEC, str(tmp_path / "n.csv"), header=False).collect()
    assert (row.campaign_id, row.conversions, row.bad_row) == ("good", 3, False)


def test_specs_are_values():
    assert dataclasses.replace(GOOGLE, platform="Search").rename == GOOGLE.rename
