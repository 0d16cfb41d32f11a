"""Operator unit tests on hand-made rows (cases the test tables never contain)."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from adfuse.operators import (
    best_per_group,
    best_worst,
    campaign_rollup,
    conform,
    daily_rollup,
    filter_fact,
    flag_target,
    global_row_number,
    portfolio_kpis,
    rolling_mean,
    share_of_total,
    stack,
    unify,
)
from adfuse.schema import FACT_COLUMNS, FACT_SCHEMA
from adfuse.sources import FACEBOOK, GOOGLE, TIKTOK, FeedSpec, read_feed

D = dt.date


def fact_rows(spark, rows):
    full = []
    for r in rows:
        base = {c: None for c in FACT_COLUMNS}
        base.update(r)
        full.append(tuple(base[c] for c in FACT_COLUMNS))
    return spark.createDataFrame(full, FACT_SCHEMA)


def test_zero_denominators_give_null_not_error(spark):
    raw = spark.createDataFrame(
        [Row(date=D(2024, 1, 1), campaign_id="x", campaign_name="A", impressions=0, clicks=0,
             spend=0.0, conversions=0, video_views=0)]
    )
    out = conform(raw, FACEBOOK).first()
    assert out.ctr is None and out.cpc is None and out.cpa is None
    assert out.roas is None and out.vid_compl_rate is None and out.conv_value is None
    assert out.social_eng == 0.0 and out.platform == "Facebook"


def test_search_feed_keeps_native_ratios(spark):
    raw = spark.createDataFrame(
        [Row(date=D(2024, 1, 1), campaign_id="g", campaign_name="S", impressions=1000, clicks=10,
             cost=5.0, conversions=2, conversion_value=20.0, ctr=0.0123, avg_cpc=0.51)]
    )
    out = conform(raw, GOOGLE).first()
    assert out.ctr == 0.0123 and out.cpc == 0.51  # passed through, not recomputed
    assert out.spend == 5.0 and out.cpa == 2.5 and out.roas == 4.0 and out.conv_value == 20.0
    assert out.video_views == 0.0 and out.vid_compl_rate is None


def test_video_feed_derived_columns(spark):
    raw = spark.createDataFrame(
        [Row(date=D(2024, 1, 1), campaign_id="t", campaign_name="V", impressions=100, clicks=4,
             cost=2.0, conversions=1, video_views=50, video_watch_25=40, video_watch_50=30,
             video_watch_75=20, video_watch_100=10, likes=3, shares=2, comments=1)]
    )
    out = conform(raw, TIKTOK).first()
    assert out.social_eng == 6.0 and out.vid_compl_rate == 0.2 and out.ctr == 0.04


def test_nan_in_source_becomes_null(spark):
    raw = spark.createDataFrame(
        [Row(date=D(2024, 1, 1), campaign_id="x", campaign_name="A", impressions=1, clicks=1,
             spend=float("nan"), conversions=1, video_views=1)]
    )
    out = conform(raw, FACEBOOK).first()
    assert out.spend is None


def test_duplicate_rows_kept_by_union(spark):
    raw = spark.createDataFrame(
        [Row(date=D(2024, 1, 1), campaign_id="x", campaign_name="A", impressions=1, clicks=1,
             spend=1.0, conversions=1, video_views=1)] * 2
    )
    assert unify([conform(raw, FACEBOOK), conform(raw, FACEBOOK)]).count() == 4


def test_new_channel_by_spec_only(spark):
    spec = FeedSpec(name="radio", platform="Radio", rename={"listeners": "impressions", "fee": "spend"})
    raw = spark.createDataFrame(
        [Row(date="2024-02-03", campaign_id="r1", campaign_name="Morning", listeners=500, clicks=5,
             fee=10.0, conversions=0)]
    )
    out = conform(raw, spec).first()
    assert out.date == D(2024, 2, 3) and out.impressions == 500 and out.platform == "Radio"
    assert out.cpc == 2.0 and out.cpa is None and out.video_views == 0.0


def test_spec_referencing_missing_column_names_the_feed(spark):
    spec = FeedSpec(name="bad", platform="B", derived={"social_eng": "likes + shares"})
    raw = spark.createDataFrame([Row(date=D(2024, 1, 1), likes=1)])
    with pytest.raises(ValueError, match="'bad'"):
        conform(raw, spec)


def test_malformed_csv_cells_flagged_and_header_matched_by_name(spark, tmp_path):
    p = tmp_path / "feed.csv"
    # reordered header, one extra column, one malformed date and one malformed int
    p.write_text(
        "campaign_name,date,extra,campaign_id,impressions,clicks,spend,conversions,video_views\n"
        "A,2024-01-01,zz,c1,100,5,2.5,1,10\n"
        "B,2024-13-45,zz,c2,abc,5,2.5,1,10\n"
    )
    cols = ["date", "campaign_id", "campaign_name", "impressions", "clicks", "spend", "conversions", "video_views"]
    df = read_feed(spark, FACEBOOK, str(p), "csv", columns=cols)
    rows = {r.campaign_name: r for r in df.collect()}
    assert rows["A"].date == D(2024, 1, 1) and rows["A"].impressions == 100 and not rows["A"].bad_row
    assert rows["B"].date is None and rows["B"].impressions is None and rows["B"].bad_row
    assert "extra" not in df.columns


def test_parquet_feed_typed_by_name(spark, tmp_path):
    src = spark.createDataFrame(
        [("2024-01-01", "c1", "A", "100", "5", 2.5, 1, 10, "extra")],
        "date string, campaign_id string, campaign_name string, impressions string, clicks string, "
        "spend double, conversions int, video_views int, junk string",
    )
    path = str(tmp_path / "feed")
    src.write.parquet(path)
    cols = ["date", "campaign_id", "campaign_name", "impressions", "clicks", "spend", "conversions", "video_views"]
    df = read_feed(spark, FACEBOOK, path, "parquet", columns=cols)
    assert dict(df.dtypes) == {
        "date": "date", "campaign_id": "string", "campaign_name": "string", "impressions": "bigint",
        "clicks": "bigint", "spend": "double", "conversions": "bigint", "video_views": "bigint", "bad_row": "boolean",
    }
    r = df.first()
    assert r.date == D(2024, 1, 1) and r.impressions == 100 and not r.bad_row
    assert conform(df, FACEBOOK).first().cpc == 0.5


def test_csv_files_with_different_header_order_fail_loudly(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,campaign_id\n2024-01-01,c1\n")
    (tmp_path / "b.csv").write_text("campaign_id,date\nc2,2024-01-02\n")
    spec = FeedSpec(name="x", platform="X", source_types={"date": "date", "campaign_id": "string"})
    with pytest.raises(Exception):
        read_feed(spark, spec, str(tmp_path), "csv").collect()


def _camp(spark, rows):
    return spark.createDataFrame(
        [Row(platform=p, campaign_name=n, spend=s, conversions=c, cpa=(s / c if c else None))
         for p, n, s, c in rows]
    )


def test_best_worst_infinite_and_undefined_cpa(spark):
    camp = _camp(spark, [
        ("G", "good", 10.0, 5),      # cpa 2
        ("G", "meh", 30.0, 5),       # cpa 6
        ("F", "burn", 50.0, 0),      # spend, no conversions -> worst
        ("T", "idle", 0.0, 0),       # 0/0 -> neither
    ])
    r = {x.kind: x for x in best_worst(camp, "cpa").collect()}
    assert r["best"].campaign_name == "good" and r["worst"].campaign_name == "burn"
    assert r["worst"].cpa is None


def test_cpa_tie_goes_to_first_name(spark):
    camp = _camp(spark, [("G", "b", 10.0, 5), ("G", "a", 10.0, 5), ("F", "z", 10.0, 5)])
    r = {x.kind: x for x in best_worst(camp, "cpa").collect()}
    assert (r["best"].platform, r["best"].campaign_name) == ("F", "z")
    assert (r["worst"].platform, r["worst"].campaign_name) == ("F", "z")


def test_best_per_group(spark):
    camp = _camp(spark, [("G", "a", 10.0, 1), ("G", "b", 10.0, 5), ("F", "c", 10.0, 0), ("F", "d", 9.0, 3)])
    r = {x.platform: x.campaign_name for x in best_per_group(camp, ["platform"], "cpa").collect()}
    assert r == {"G": "b", "F": "d"}


def test_all_null_conv_value_group_sums_to_zero(spark):
    fact = fact_rows(spark, [
        dict(platform="F", campaign_name="a", spend=1.0, impressions=1, clicks=1, conversions=1),
        dict(platform="F", campaign_name="a", spend=2.0, impressions=1, clicks=1, conversions=1),
        dict(platform="F", campaign_name="a", spend=3.0, impressions=1, clicks=1, conversions=1),
    ])
    r = campaign_rollup(fact).first()
    assert r.conv_value == 0.0 and r.roas == 0.0 and r.spend == 6.0 and r.cpa == 2.0


def test_rows_frame_differs_from_days_frame_on_gaps(spark):
    s = spark.createDataFrame(
        [Row(date=D(2024, 1, d), platform="P", spend=float(v)) for d, v in [(1, 10), (2, 20), (10, 30)]]
    )
    rows = {r.date.day: r.a for r in rolling_mean(s, "spend", 7, "rows", out="a").collect()}
    days = {r.date.day: r.a for r in rolling_mean(s, "spend", 7, "days", out="a").collect()}
    assert rows == {1: 10.0, 2: 15.0, 10: 20.0}  # fewer than 7 rows: mean of what exists
    assert days == {1: 10.0, 2: 15.0, 10: 30.0}


def test_rolling_one_is_identity(spark):
    s = spark.createDataFrame([Row(date=D(2024, 1, d), platform="P", spend=float(d)) for d in range(1, 6)])
    assert all(r.spend == r.a for r in rolling_mean(s, "spend", 1, out="a").collect())


def test_platform_filter_empty_list_selects_nothing_campaign_empty_selects_all(spark):
    fact = fact_rows(spark, [dict(platform="F", campaign_name="a", date=D(2024, 1, 1))])
    assert filter_fact(fact, platforms=[]).count() == 0
    assert filter_fact(fact, campaigns=[]).count() == 1


def test_single_date_range_is_that_day(spark):
    fact = fact_rows(spark, [dict(platform="F", date=D(2024, 1, d)) for d in (1, 2, 3)])
    out = filter_fact(fact, date_from="2024-01-02")
    assert [r.date.day for r in out.collect()] == [2]
    assert filter_fact(fact, date_from="2024-01-01", date_to="2024-01-02").count() == 2
    assert filter_fact(fact, date_from=dt.datetime(2024, 1, 1, 9), date_to=dt.datetime(2024, 1, 2, 9)).count() == 2


def test_empty_fact_kpis_are_zero(spark):
    r = portfolio_kpis(fact_rows(spark, [])).first()
    assert r.total_spend == 0.0 and r.total_conversions == 0 and r.portfolio_cpa == 0.0
    assert r.portfolio_ctr_pct == 0.0 and r.portfolio_cpc == 0.0


def test_target_flag_null_is_false(spark):
    df = spark.createDataFrame([Row(r=5.0), Row(r=3.0), Row(r=None)], "r double")
    assert [x.meets_target for x in flag_target(df, "r", 4.0).orderBy(F.col("r").desc_nulls_last()).collect()] == [
        True, False, False
    ]


def test_share_of_total_and_stack(spark):
    df = spark.createDataFrame([Row(date=D(2024, 1, 1), platform=p, v=v) for p, v in [("A", 1.0), ("B", 3.0)]])
    shares = {r.platform: r.v_share for r in share_of_total(df, "v").collect()}
    assert shares == {"A": 0.25, "B": 0.75}
    st = {r.platform: r.v_stacked for r in stack(df, "v").collect()}
    assert st == {"A": 1.0, "B": 4.0}
    zero = spark.createDataFrame([Row(platform="A", v=0.0)])
    assert share_of_total(zero, "v").first().v_share is None


def test_global_row_number_matches_sorted_order(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), F.col("id")).repartition(7)
    out = global_row_number(df, [F.col("k").desc(), F.col("id")], "pos")
    got = [(r.k, r.pos) for r in out.orderBy("pos").collect()]
    assert [p for _, p in got] == list(range(1, 5001))
    assert [k for k, _ in got] == sorted((k for k, _ in got), reverse=True)


def test_global_row_number_empty_and_single(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert global_row_number(empty, [F.col("k")], "pos").count() == 0
    one = spark.createDataFrame([Row(k=7)])
    assert [r.pos for r in global_row_number(one, [F.col("k")], "pos").collect()] == [1]


def test_series_filter_keeps_window_history(spark):
    from adfuse.operators import filter_series

    s = spark.createDataFrame(
        [Row(date=D(2024, 1, d), platform="P", spend=float(d)) for d in range(1, 11)]
    )
    rolled = rolling_mean(s, "spend", 7, out="avg7")
    first = filter_series(rolled, ["P"], "2024-01-08", "2024-01-10").orderBy("date").first()
    # day 8 averages days 2..8 although days before the 8th were filtered out
    assert first.date == D(2024, 1, 8) and first.avg7 == sum(range(2, 9)) / 7


def test_daily_rollup_sums(spark):
    fact = fact_rows(spark, [
        dict(platform="F", date=D(2024, 1, 1), spend=1.0, conversions=1, impressions=10, clicks=1),
        dict(platform="F", date=D(2024, 1, 1), spend=2.0, conversions=2, impressions=20, clicks=2),
    ])
    r = daily_rollup(fact).first()
    assert (r.spend, r.conversions, r.impressions, r.clicks) == (3.0, 3, 30, 3)
