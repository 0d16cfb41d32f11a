"""Sums that do not depend on order, and channels that share one table."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from adfuse.functions.exact import exact_mean_sql, exact_sum_sql
from adfuse.operators import campaign_rollup, conform_all, conform_tagged, kpi_summary, mean_campaign_roas
from adfuse.plans.catalog import QUERIES
from adfuse.plans.oracle import ORACLE
from adfuse.schema import FACT_SCHEMA
from adfuse.sources.spec import FeedSpec
from compare import compare


def fact_of(spark, seed=1, n=4000):
    r = random.Random(seed)
    rows = [
        dict(
            platform=r.choice(["Google", "Radio"]),
            campaign_name=f"c{r.randint(0, 300)}",
            spend=r.choice([r.random() * 10 ** r.randint(-8, 9), None, 0.1]),
            conv_value=r.choice([r.random() * 1e5, None, -0.3]),
            conversions=r.randint(0, 9), clicks=r.randint(0, 9), impressions=r.randint(0, 99),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame([tuple(d.get(c) for c in FACT_SCHEMA.names) for d in rows], FACT_SCHEMA)


def test_kpis_have_the_same_bits_under_any_partitioning(spark):
    fact = fact_of(spark)
    results = set()
    for k, dealt in enumerate((fact.repartition(7, "spend"), fact.repartition(3), fact.orderBy("conv_value").coalesce(1))):
        spark.conf.set("spark.sql.shuffle.partitions", 2 + 3 * k)
        results.add(
            (
                *kpi_summary(campaign_rollup(dealt, exact=True)).first(),
                *mean_campaign_roas(dealt).first(),
                *campaign_rollup(dealt, exact=True).agg(F.sort_array(F.collect_list("spend"))).first()[0],
            )
        )
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(results) == 1
    plain = {tuple(f.agg(F.sum("spend")).first()) for f in (fact.repartition(7, "spend"), fact.orderBy("conv_value").coalesce(1))}
    assert len(plain) == 2  # the plain sum does depend on it


@pytest.mark.parametrize(
    "values",
    [[], [None], [0.1] * 10, [1 / 3], [1e12, 1e-12, -1e12], [-0.1, -0.2, 0.3], [2.0**-80, -(2.0**-20)], [8e12, 0.5, -8e12], [5e-324]],
)
def test_against_fractions(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    total, mean = df.selectExpr(exact_sum_sql("x"), exact_mean_sql("x")).first()
    known = [v for v in values if v is not None]
    if not known:
        assert (total, mean) == (None, None)
        return
    want = sum((Fraction(math.floor(Fraction(v) * 2**80), 2**80) for v in known), Fraction(0))
    assert abs(Fraction(total) - want) <= abs(want) * Fraction(1, 2**52)
    assert mean == total / len(known)


def test_too_large_values_fail(spark):
    for x in (1e13, math.inf):
        with pytest.raises(Exception):
            spark.createDataFrame([(x,)], "x double").selectExpr(exact_sum_sql("x")).collect()


@pytest.mark.parametrize("values", [[1e13], [2.0**43, -0.1], [-1e13, 1e13, 0.3], [1e25, 1e9 + 1e-6, -1e25], [2.0**43 - 2.0**-10] * 3, [8e31], [0.1, None]])
def test_wide_sums_against_fractions(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    total, mean = df.selectExpr(exact_sum_sql("x", wide=True), exact_mean_sql("x", wide=True)).first()
    known = [v for v in values if v is not None]
    want = sum((Fraction(math.floor(Fraction(v) * 2**80), 2**80) for v in known), Fraction(0))
    assert abs(Fraction(total) - want) <= abs(want) * Fraction(1, 2**52)
    assert mean == total / len(known)


def test_wide_sums_equal_the_others_on_smaller_values(spark):
    df = spark.createDataFrame([(k % 50, v) for k, v in enumerate(x.spend for x in fact_of(spark).collect())], "k int, x double")
    both = df.groupBy("k").agg(F.expr(exact_sum_sql("x")).alias("a"), F.expr(exact_sum_sql("x", wide=True)).alias("b")).collect()
    assert len(both) == 50 and all(r.a == r.b for r in both)


def test_sums_out_of_the_wide_range_fail(spark):
    for values in ([1e32], [6e31] * 2, [-1e32], [math.inf], [math.nan]):
        with pytest.raises(Exception):
            spark.createDataFrame([(v,) for v in values], "x double").selectExpr(exact_sum_sql("x", wide=True)).collect()


@pytest.fixture(scope="module")
def large_spend(spark, tmp_path_factory):
    """A lineitem with every amount under 2**43 and sums by campaign above it, and a DuckDB connection to it."""
    import duckdb

    r = random.Random(9)
    rows = [
        (k, r.randint(1, 9999), r.randint(1, 99), k % 3 + 1, float(r.randint(1, 50)), r.randint(10**11, 10**12) / 100, 0.05, 0.02, "ANR"[k % 7 % 3])
        for k in range(300)
    ]
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
    folder = str(tmp_path_factory.mktemp("large_spend"))
    df = spark.createDataFrame(rows, kinds).withColumn("l_shipdate", F.lit("1996-02-03").cast("timestamp"))
    df.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    most = con.sql("SELECT max(a), min(s) FROM (SELECT max(c * (l_suppkey % 7)) AS a, sum(c * (l_suppkey % 7)) AS s FROM (SELECT *, round(l_extendedprice * 100) AS c FROM lineitem) WHERE l_returnflag = 'N' GROUP BY l_linenumber)").fetchall()[0]
    assert most[0] < 2**43 < most[1]
    return folder, con


def test_kpi_tiles_of_sums_above_the_limit_of_a_value(spark, large_spend):
    folder, con = large_spend
    for name in ("kpi_scaled", "filtered_kpis"):
        ok, msg = compare(QUERIES[name](spark, folder), con, ORACLE[name], exact=True)
        assert ok, msg
    rows = [("Google", f"c{k % 2}", 1e13, 3e13 + k, 1, 1, 1) for k in range(4)]
    fact = spark.createDataFrame(rows, "platform string, campaign_name string, spend double, conv_value double, conversions long, clicks long, impressions long")
    k = kpi_summary(campaign_rollup(fact, exact=True)).first()
    assert (k.total_spend, k.pooled_roas, k.mean_campaign_roas) == (4e13, (12e13 + 6) / 4e13, ((6e13 + 2) / 2e13 + (6e13 + 4) / 2e13) / 2)


def test_campaign_roas_of_sums_above_the_limit_of_a_value(spark, large_spend):
    folder, con = large_spend
    ok, msg = compare(QUERIES["mean_campaign_roas"](spark, folder), con, ORACLE["mean_campaign_roas"], exact=True)
    assert ok, msg
    rows = [("Google", "dear", 2e13, 5e13), ("Google", "cheap", 0.5, 2e13), ("Google", "free", 0.0, 9.0), ("Radio", "dear", 1e13, 1e13)]
    r = mean_campaign_roas(spark.createDataFrame(rows, "platform string, campaign_name string, spend double, conv_value double")).first()
    assert tuple(r) == ((2.5 + 4e13) / 2, (7e13 + 9) / (2e13 + 0.5))


RADIO = FeedSpec(
    name="radio", platform="Radio", source_types={"date": "date", "campaign_name": "string", "listeners": "bigint", "fee": "double"},
    rename={"listeners": "impressions", "fee": "spend"},
)
PRINT = FeedSpec(
    name="print", platform="O'Print", source_types={"date": "date", "campaign_name": "string", "copies": "bigint", "ctr": "double", "spend": "double"},
    rename={"copies": "impressions"}, derived={"clicks": "copies / 10", "video_views": "copies * 2"},
)


def test_tagged_channels_equal_separate_feeds(spark):
    kinds = "tag string, date date, campaign_name string, listeners bigint, fee double, copies bigint, ctr double, spend double"
    r = random.Random(4)
    rows = [
        (r.choice(["r", "p'", "other", None]), None, f"c{k % 5}", k, k / 7, r.choice([None, 10 * k]), r.choice([0.5, None, math.nan]), k / 3)
        for k in range(200)
    ]
    df = spark.createDataFrame(rows, kinds)
    specs = {"r": RADIO, "p'": PRINT}
    feeds = {n: df.where(F.col("tag") == t).select(*s.source_types) for n, t, s in (("radio", "r", RADIO), ("print", "p'", PRINT))}
    want = conform_all(feeds, {"radio": RADIO, "print": PRINT})
    got = conform_tagged(df, "tag", specs)
    assert got.dtypes == want.dtypes

    def rows_of(x):
        return sorted((tuple(r) for r in x.collect()), key=str)

    assert rows_of(got) == rows_of(want) and got.count() > 80
    for platforms in (["Radio"], ["O'Print"], [], ["Radio", "none"]):
        part = conform_tagged(df, "tag", specs, platforms)
        assert part.columns == want.columns
        assert rows_of(part) == rows_of(want.where(F.col("platform").isin(platforms)) if platforms else want.limit(0))
