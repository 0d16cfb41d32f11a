"""Invariants over the derived channel feeds."""

import pytest
from pyspark.sql import functions as F

from adfuse.operators import (
    daily_rollup,
    platform_rollup,
    portfolio_kpis,
    rolling_mean,
    share_of_total,
    stack,
)
from adfuse.plans.catalog import fact
from adfuse.sources.lineitem_feeds import raw_feeds
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def f(spark):
    return fact(spark, SF_SMALL)


def test_union_count_is_sum_of_feeds(spark, f):
    assert f.count() == sum(df.count() for df in raw_feeds(spark, SF_SMALL).values())


def test_platform_rollup_adds_up_to_portfolio(f):
    plat = platform_rollup(f).agg(F.sum("spend").alias("s"), F.sum("conversions").alias("c")).first()
    k = portfolio_kpis(f).first()
    assert plat.s == k.total_spend and plat.c == k.total_conversions


def test_shares_sum_to_one(f):
    s = share_of_total(platform_rollup(f).select("platform", "spend"), "spend")
    assert abs(s.agg(F.sum("spend_share")).first()[0] - 1.0) < 1e-12


def test_last_stack_layer_is_daily_total(f):
    daily = daily_rollup(f)
    st = stack(daily.select("date", "platform", "conversions"), "conversions")
    per_day = st.groupBy("date").agg(F.max("conversions_stacked").alias("top"), F.sum("conversions").alias("tot"))
    assert per_day.where("top != tot").count() == 0


def test_rolling_window_of_one_is_identity(f):
    r = rolling_mean(daily_rollup(f), "spend", 1, out="a")
    assert r.where("a != spend").count() == 0
