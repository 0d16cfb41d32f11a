"""The incremental daily roll-up equals the batch one, late data included."""

from adfuse.operators import conform_all, daily_rollup
from adfuse.sources import CHANNELS, FACEBOOK, GOOGLE, read_feed
from adfuse.streaming import read_daily_rollup, start_daily_rollup

FB_HEADER = list(FACEBOOK.source_types)
G_HEADER = list(GOOGLE.source_types)


def _fb_line(day, camp, imp, clicks, spend, conv):
    row = dict(date=day, campaign_id=camp, campaign_name=camp, ad_set_id="s", ad_set_name="s",
               impressions=imp, clicks=clicks, spend=spend, conversions=conv, video_views=1,
               engagement_rate=0.1, reach=1, frequency=1.0)
    return ",".join(str(row[c]) for c in FB_HEADER)


def _g_line(day, camp, imp, clicks, cost, conv):
    row = dict(date=day, campaign_id=camp, campaign_name=camp, ad_group_id="a", ad_group_name="a",
               impressions=imp, clicks=clicks, cost=cost, conversions=conv, conversion_value=cost * 3,
               ctr=0.01, avg_cpc=0.5, quality_score=7, search_impression_share=0.4)
    return ",".join(str(row[c]) for c in G_HEADER)


def _write(path, header, lines):
    path.write_text(",".join(header) + "\n" + "\n".join(lines) + "\n")


def _table(df):
    return {(r.date, r.platform): (r.spend, r.conversions, r.impressions, r.clicks) for r in df.collect()}


def test_stream_matches_batch_including_late_data(spark, tmp_path):
    fb_dir, g_dir = tmp_path / "fb", tmp_path / "g"
    fb_dir.mkdir()
    g_dir.mkdir()
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    _write(fb_dir / "part1.csv", FB_HEADER, [_fb_line(d, "A", 100 + i, 5, 2.5 * i, i % 3) for i, d in enumerate(days[:10])])
    _write(g_dir / "part1.csv", G_HEADER, [_g_line(d, "S", 200, 7, 1.5, 1) for d in days[:10]])

    out = str(tmp_path / "daily")
    sources = [(FACEBOOK, str(fb_dir), "csv"), (GOOGLE, str(g_dir), "csv")]
    ckpt = str(tmp_path / "ckpt")

    def batch():
        return daily_rollup(conform_all({
            "facebook": read_feed(spark, FACEBOOK, str(fb_dir), "csv"),
            "google": read_feed(spark, GOOGLE, str(g_dir), "csv"),
        }, CHANNELS))

    start_daily_rollup(spark, sources, out, checkpoint=ckpt).awaitTermination(120)
    assert _table(read_daily_rollup(spark, out)) == _table(batch())

    # second delivery: later days plus late rows for the first day; same checkpoint resumes
    _write(fb_dir / "part2.csv", FB_HEADER, [_fb_line(d, "B", 50, 1, 4.0, 1) for d in days[10:]] + [_fb_line(days[0], "L", 7, 1, 1.0, 1)])
    _write(g_dir / "part2.csv", G_HEADER, [_g_line(d, "S", 300, 9, 2.0, 2) for d in days[10:]])
    start_daily_rollup(spark, sources, out, checkpoint=ckpt).awaitTermination(120)
    got, want = _table(read_daily_rollup(spark, out)), _table(batch())
    assert got == want and len(got) == 40


def test_readers_see_complete_versions_and_restarts_resume(spark, tmp_path):
    """No ``checkpoint=``: the second run finds the first one's, and reads new files only."""
    fb_dir = tmp_path / "fb"
    fb_dir.mkdir()
    _write(fb_dir / "part1.csv", FB_HEADER, [_fb_line("2024-01-01", "A", 100, 5, 2.5, 1)])
    out = str(tmp_path / "daily")
    sources = [(FACEBOOK, str(fb_dir), "csv")]
    start_daily_rollup(spark, sources, out).awaitTermination(120)
    before = read_daily_rollup(spark, out)  # a reader that has begun
    _write(fb_dir / "part2.csv", FB_HEADER, [_fb_line("2024-01-01", "B", 10, 1, 1.5, 0)])
    start_daily_rollup(spark, sources, out).awaitTermination(120)
    assert [r.spend for r in before.collect()] == [2.5]
    (row,) = read_daily_rollup(spark, out).collect()
    assert (row.spend, row.impressions) == (4.0, 110)
    # A version that is not finished is not read.
    (tmp_path / "daily" / "version=999999999999").mkdir()
    assert [r.spend for r in read_daily_rollup(spark, out).collect()] == [4.0]
