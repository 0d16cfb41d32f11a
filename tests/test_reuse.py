"""Cached tables, refreshed tables, the clustered layout, and feeds whose files differ."""

import csv
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from adfuse.operators import campaign_rollup, conform_all
from adfuse.operators.rollups import campaign_day_rollup
from adfuse.plans import cube, dashboard
from adfuse.plans.cube import Export, bad_rows, evict, read_cube, refresh_cube
from adfuse.schema import FACT_SCHEMA
from adfuse.sources import CHANNELS, GOOGLE, TableCache, materialize, read_csv_typed, scratch_path, store
from adfuse.sources import readers
from adfuse.sources.readers import checked, feed_quality, header_groups, read_feed
from adfuse.sources.spec import FeedSpec
from adfuse.streaming import read_feed_stream, read_rollup, start_rollup_by_file

RADIO = FeedSpec(
    name="radio",
    platform="Radio",
    source_types={"date": "date", "campaign_name": "string", "listeners": "bigint", "clicks": "bigint", "fee": "double"},
    rename={"listeners": "impressions", "fee": "spend"},
)
NAMES = list(RADIO.source_types)


def write(path, rows, names=NAMES):
    """Rows as dicts or as raw text lines."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as out:
        w = csv.DictWriter(out, names, extrasaction="ignore", restval="")
        w.writeheader()
        for r in rows:
            out.write(r + "\n") if isinstance(r, str) else w.writerow(r)


def row(day, name, listeners=10, clicks=1, fee=2.5):
    return dict(zip(NAMES, (f"2024-{day}", name, listeners, clicks, fee), strict=True))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- cached tables ----------------------------------------------------------------
def test_a_second_call_reads_no_feed_and_a_changed_file_builds_anew(spark, tmp_path):
    folder, calls = f"{tmp_path}/in", []
    write(f"{folder}/a.csv", [row("01-01", "x"), row("02-01", "y")])

    def load(specs=None):
        specs = specs or {"radio": RADIO}

        def feeds():
            calls.append(1)
            return {"radio": read_feed(spark, specs["radio"], folder)}

        return dashboard.load_cached(spark, feeds, specs, [folder], f"{tmp_path}/cache")

    first = rows(load().fact)
    again = load()
    assert len(calls) == 1 and rows(again.fact) == first and len(first) == 2
    assert all("/cache/" in f for t in (again.fact, again.cube) for f in t.inputFiles())
    write(f"{folder}/a.csv", [row("01-01", "x"), row("02-01", "yy", 11)])
    assert {r.campaign_name for r in load().fact.collect()} == {"x", "yy"} and len(calls) == 2
    write(f"{folder}/b.csv", [row("03-01", "z")])
    assert load().cube.count() == 3 and len(calls) == 3
    other = FeedSpec(name="radio", platform="FM", source_types=RADIO.source_types, rename=RADIO.rename)
    assert {r.platform for r in load({"radio": other}).cube.collect()} == {"FM"} and len(calls) == 4
    assert {r.platform for r in load().cube.collect()} == {"Radio"} and len(calls) == 4  # the older entry is still there
    cache = TableCache(spark, f"{tmp_path}/cache")
    assert cache.evict(keep=1) == 1 and len(os.listdir(f"{tmp_path}/cache/data")) == 1
    assert {r.platform for r in load().cube.collect()} == {"Radio"} and len(calls) == 5


def test_a_failed_build_is_not_found_and_leaves_nothing(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", [row("01-01", "x")])
    cache = TableCache(spark, f"{tmp_path}/cache")

    def build(folder):
        store(spark.range(3), f"{folder}/t")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        cache.tables([f"{tmp_path}/in"], [], build)
    assert os.listdir(f"{tmp_path}/cache/data") == []
    got = cache.tables([f"{tmp_path}/in"], [], lambda f: {"t": store(spark.range(2), f"{f}/t")})
    assert got["t"].count() == 2


def test_the_first_of_two_builders_counts(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", [row("01-01", "x")])
    cache = TableCache(spark, f"{tmp_path}/cache")

    def slow(folder):
        cache.tables([f"{tmp_path}/in"], [], lambda f: {"t": store(spark.range(5), f"{f}/t")})
        return {"t": store(spark.range(9), f"{folder}/t")}

    assert cache.tables([f"{tmp_path}/in"], [], slow)["t"].count() == 5
    assert len(os.listdir(f"{tmp_path}/cache/data")) == 1


# --- layout -----------------------------------------------------------------------
def test_odd_partition_values_come_back(spark):
    df = spark.createDataFrame(
        [("2024", 1, "a"), ("", 2, "b"), (None, 3, "c"), ("a/b=c d%", None, "d"), ("007", 4, None)],
        "platform string, month int, v string",
    )
    assert rows(materialize(df, scratch_path(spark, "odd"), ["platform", "month"])) == rows(df)


def scanned_rows(df):
    """Rows that leave the file scans of an executed query."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            p = p.executedPlan()
        if p.nodeName().startswith("Scan"):
            n += p.metrics().apply("numOutputRows").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return n


def test_a_campaign_filter_skips_row_groups(spark):
    n = 40_000
    fact = spark.range(n).select(
        F.lit(1).alias("month"), F.concat(F.lit("camp-"), F.sha1(F.col("id").cast("string"))).alias("campaign_name"), "id"
    )
    kept = store(fact, scratch_path(spark, "row-groups"), ["month"], ["campaign_name"], ["campaign_name"], 100_000)
    files = f"{kept.path}/**/*.parquet"
    meta = duckdb.sql(
        f"SELECT count(*), count(bloom_filter_offset) FROM parquet_metadata('{files}') WHERE path_in_schema = 'campaign_name'"
    ).fetchall()[0]
    assert meta[0] >= 8 and meta[1] == meta[0]  # row groups, all with a bloom filter
    table = kept.read(spark)
    name = fact.where("id = 777").first().campaign_name
    hit = table.where(F.col("campaign_name") == name)
    assert hit.count() == 1 and 0 < scanned_rows(hit.select("id")) <= n / 4
    # Inside a row group's span, but in none of them: only the bloom filters can tell.
    assert scanned_rows(table.where(F.col("campaign_name") == name[:-1] + "x").select("id")) == 0


def test_a_hot_month_is_many_tasks(spark, tmp_path):
    hot = spark.range(60_000).select(
        F.lit("Radio").alias("platform"), F.lit(202401).alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("name")
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "256k")
    try:
        path = store(hot, f"{tmp_path}/t", ["platform", "month"], ["name"]).path
    finally:
        spark.conf.unset(setting)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) >= 4 and spark.read.parquet(path).count() == 60_000


# --- refreshed cube ---------------------------------------------------------------
def full(spark, folder):
    return rows(campaign_day_rollup(conform_all({"radio": read_feed(spark, RADIO, folder, mixed_headers=True, on_bad="ignore")}, {"radio": RADIO})))


def test_refresh_equals_a_rebuild_and_reads_changed_files_only(spark, tmp_path, monkeypatch):
    folder, root, read = f"{tmp_path}/in", f"{tmp_path}/cube", []
    original = readers.read_feed

    def spy(spark, spec, paths, *a, **k):
        read.extend(os.path.basename(p) for p in paths)
        return original(spark, spec, paths, *a, **k)

    monkeypatch.setattr("adfuse.plans.cube.read_feed", spy)
    exports = [Export(RADIO, folder)]

    def refresh():
        read.clear()
        done = refresh_cube(spark, exports, root)
        assert rows(read_cube(spark, root)) == full(spark, folder)
        return done

    write(f"{folder}/jan a+b.csv", [row("01-01", "x", fee=0.1), row("01-01", "x", fee=0.2), row("02-03", "y")])
    write(f"{folder}/sub/feb.csv", [row("02-03", "y", 5), row("02-04", None), row("02-30", "no date")], NAMES[::-1])
    done = refresh()
    assert (done.files_read, done.slices_written) == (2, 3) and sorted(read) == ["feb.csv", "jan a+b.csv"]
    assert rows(bad_rows(spark, root).select("bad_rows")) == [(1,)]

    assert refresh().files_read == 0 and read == []  # nothing new
    write(f"{folder}/mar.csv", [row("03-01", "z")])  # added
    assert (refresh().slices_written, read) == (1, ["mar.csv"])
    write(f"{folder}/jan a+b.csv", [row("01-02", "xx", fee=0.3)])  # replaced: February loses a row, January changes
    assert (refresh().slices_written, read) == (2, ["jan a+b.csv"])
    os.remove(f"{folder}/sub/feb.csv")  # deleted: its only month and the rows without date are gone
    done = refresh()
    assert (done.files_read, done.files_gone, done.slices_written) == (0, 1, 2)
    assert {r.date.month for r in read_cube(spark, root).collect()} == {1, 3}

    months = read_cube(spark, root, ["Radio"], "2024-03-01", "2024-03-31")
    assert months.count() == 1 and all("_202403" in f for f in months.inputFiles())  # other months are not opened
    assert evict(spark, root) > 0 and rows(read_cube(spark, root)) == full(spark, folder)
    os.remove(f"{folder}/mar.csv")
    os.remove(f"{folder}/jan a+b.csv")
    refresh_cube(spark, exports, root)
    assert read_cube(spark, root).count() == 0


def test_a_broken_refresh_changes_nothing(spark, tmp_path, monkeypatch):
    folder, root = f"{tmp_path}/in", f"{tmp_path}/cube"
    write(f"{folder}/a.csv", [row("01-01", "x"), row("02-01", "x")])
    refresh_cube(spark, [Export(RADIO, folder)], root)
    before = rows(read_cube(spark, root))
    write(f"{folder}/b.csv", [row("01-01", "x"), row("02-01", "y")])
    write_slices, calls = cube._write_slices, []  # the second write of the refresh fails

    def failing(*a):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        write_slices(*a)

    monkeypatch.setattr(cube, "_write_slices", failing)
    with pytest.raises(RuntimeError):
        refresh_cube(spark, [Export(RADIO, folder)], root)
    assert rows(read_cube(spark, root)) == before
    monkeypatch.setattr(cube, "_write_slices", write_slices)
    refresh_cube(spark, [Export(RADIO, folder)], root)
    assert rows(read_cube(spark, root)) == full(spark, folder)


# --- files of one feed that differ --------------------------------------------------
def test_headers_in_any_order_and_with_extra_columns(spark, tmp_path):
    folder = f"{tmp_path}/in"
    write(f"{folder}/a.csv", [row("01-01", "x, y")])
    write(f"{folder}/b [1]{{2}}.csv", [row("01-02", "b", 7)], NAMES[2:] + NAMES[:2])
    write(f"{folder}/deep/c.csv", [{**row("01-03", "c", 8), "note": "n"}], ["note", *NAMES[::-1]])
    open(f"{folder}/empty.csv", "w").close()
    write(f"{folder}/header-only.csv", [], NAMES[::-1])
    assert sorted(map(len, header_groups(spark, [folder]))) == [1, 1, 1, 1]
    got = read_feed(spark, RADIO, folder, mixed_headers=True)
    assert [(r.campaign_name, r.listeners, r.bad_row) for r in got.orderBy("date").collect()] == [
        ("x, y", 10, False), ("b", 7, False), ("c", 8, False),
    ]
    with pytest.raises(Exception):
        read_feed(spark, RADIO, [folder, f"{folder}/deep"], on_bad="fail").collect()
    write(f"{folder}/short.csv", [{"date": "2024-01-01"}], ["date"])
    with pytest.raises(ValueError, match="not found"):
        read_feed(spark, RADIO, folder, mixed_headers=True)


def test_only_the_first_lines_are_read_for_the_headers(spark, tmp_path):
    for k in range(3):
        write(f"{tmp_path}/in/{k}.csv", [row("01-01", "x" * 200)] * 20_000, NAMES if k else NAMES[::-1])
    groups = header_groups(spark, [f"{tmp_path}/in"])
    assert sorted(map(len, groups)) == [1, 2]


def test_quality_is_counted_while_the_totals_are_computed(spark, tmp_path):
    write(
        f"{tmp_path}/in/a.csv",
        [row("01-01", "x"), "2024-13-01,bad date,5,1,1.0", "2024-01-02,frac,1.5,x,2.0", "2024-01-02,short", row("01-03", "y")],
    )
    for keep, total in ((True, 2.5 + 1 + 2 + 2.5), (False, 5.0)):
        feed, counts = checked(spark, RADIO, f"{tmp_path}/in", keep_bad=keep)
        got = campaign_rollup(conform_all({"radio": feed}, {"radio": RADIO})).agg(F.sum("spend")).first()[0]
        assert got == total
        assert rows(feed_quality(spark, {"radio": counts})) == [
            ("radio", 5, 5 if keep else 2, 3, 1, 3, "clicks:1,date:1,listeners:1")
        ]
    assert read_feed(spark, RADIO, f"{tmp_path}/in", on_bad="drop").count() == 2


def test_exported_cells_that_do_not_parse_fail(spark, tmp_path):
    names = FACT_SCHEMA.names
    with open(f"{tmp_path}/a.csv", "w") as out:
        out.write(",".join(names) + "\n" + ",".join("x" if n == "clicks" else "" for n in names) + "\n")
    with pytest.raises(Exception, match="clicks: no bigint: x"):
        read_csv_typed(spark, f"{tmp_path}/a.csv").collect()


# --- streaming ----------------------------------------------------------------------
def test_stream_of_files_with_moved_columns_counts_bad_rows(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    write(f"{folder}/a b.csv", [row("01-01", "x"), row("01-02", "x", 3)])
    write(f"{folder}/b.csv", [row("01-01", "y", 4), "1.0,oops,5,late,2024-01-01"], NAMES[::-1])

    def run():
        start_rollup_by_file(spark, [(RADIO, folder, "csv")], out, max_files_per_trigger=1).awaitTermination()
        daily, quality = read_rollup(spark, out)
        days = {r.date.day if r.date else None: (r.impressions, r.clicks, r.spend) for r in daily.collect()}
        return days, tuple(quality.first())

    assert run() == ({1: (19, 2, 6.0), 2: (3, 1, 2.5)}, ("radio", 4, 1))
    write(f"{folder}/late.csv", [row("01-02", "z", 7)], NAMES[1:] + NAMES[:1])
    days, quality = run()
    assert days[2] == (10, 2, 5.0) and quality == ("radio", 5, 1)
    assert run() == (days, quality)  # nothing new
    batch = conform_all({"radio": read_feed(spark, RADIO, folder, mixed_headers=True, on_bad="ignore")}, {"radio": RADIO})
    want = batch.groupBy("date").agg(F.sum("impressions"), F.sum("spend"))
    assert rows(read_rollup(spark, out)[0].select("date", "impressions", "spend")) == rows(want)


def test_streamed_feed_flags_bad_and_ragged_lines(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", [row("01-01", "x"), "2024-01-02,bad,n,1,1.0", "2024-01-02,short"])
    stream = read_feed_stream(spark, RADIO, f"{tmp_path}/in")
    q = stream.writeStream.format("memory").queryName("flagged").trigger(availableNow=True)
    q.option("checkpointLocation", f"{tmp_path}/c").start().awaitTermination()
    assert sorted((r.campaign_name, r.bad_row) for r in spark.table("flagged").collect()) == [
        ("bad", True), ("short", True), ("x", False),
    ]


def test_channels_and_fixture_feeds_still_cache(spark, tmp_path):
    """A parquet input and several channels."""
    from adfuse.sources.lineitem_feeds import raw_feeds
    from conftest import SF_SMALL

    feeds = lambda: raw_feeds(spark, SF_SMALL)
    inputs = [f"{SF_SMALL}/lineitem.parquet"]
    one = dashboard.load_cached(spark, feeds, CHANNELS, inputs, f"{tmp_path}/cache")
    two = dashboard.load_cached(spark, lambda: 1 / 0, CHANNELS, inputs, f"{tmp_path}/cache")
    assert GOOGLE.platform in {r.platform for r in two.cube.select("platform").distinct().collect()}
    assert one.fact.count() == two.fact.count() and two.funnel.count() == 1


# --- ordered parts --------------------------------------------------------------------
def test_pages_concatenate_to_the_ordered_table_and_open_few_parts(spark, tmp_path):
    from adfuse.sources.ordered import store_pages

    rows_ = [(k % 7 or None, f"n{k % 50}", float(k)) for k in range(1000)] + [(3, "same", 1.0)] * 100
    df = spark.createDataFrame(rows_, "a int, b string, c double")
    paged = store_pages(df, f"{tmp_path}/p", ["a", "b"], parts=8)
    want = [tuple(r) for r in df.orderBy("a", "b", "c").collect()]
    assert paged.rows(spark) == len(want)
    got = []
    for k in range(12):
        page = paged.page(spark, k, 95)
        assert len({f.split("/")[-2] for f in page.inputFiles()}) <= 3
        got += [tuple(r) for r in page.collect()]
    assert got == want
    assert paged.page(spark, 99, 95).collect() == [] == store_pages(df.limit(0), f"{tmp_path}/e", ["a"]).page(spark, 0, 5).collect()


def test_parts_of_the_ordered_csv_are_one_file(spark, tmp_path):
    from adfuse.sources.ordered import export_ordered_csv

    names = ["plain", 'a "q"', "x, y", "two\nlines", "", None, " lead"]
    df = spark.createDataFrame([(k % 13, names[k % 7], k / 4) for k in range(500)], "a int, `b, c` string, d double").repartition(5)
    parts = export_ordered_csv(df, f"{tmp_path}/a b", ["a"], parts=6).orderBy("place").collect()
    assert len(parts) == 7 and [p.offset for p in parts] == [sum(x.length for x in parts[:k]) for k in range(7)]
    data = b"".join(open(p.path.removeprefix("file:"), "rb").read() for p in parts)
    assert len(data) == parts[-1].offset + parts[-1].length
    read = list(csv.reader(data.decode().splitlines(keepends=True)))
    assert read[0] == ["a", "b, c", "d"]
    assert read[1:] == [[str(r[0]), r[1] or "", str(r[2])] for r in df.orderBy("a", "`b, c`", "d").collect()]
