"""Randomised checks of the trickier operators against plain-Python models."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from adfuse.operators import best_worst, global_row_number, rolling_mean

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(
    keys=st.lists(st.tuples(st.integers(-5, 5), st.text("abc", max_size=2)), min_size=1, max_size=60, unique=True),
    parts=st.integers(1, 6),
)
def test_global_row_number_is_sorted_position(spark, keys, parts):
    df = spark.createDataFrame([Row(k=k, s=s) for k, s in keys]).repartition(parts)
    out = global_row_number(df, [F.col("k").desc(), F.col("s").asc()], "pos").collect()
    want = sorted(keys, key=lambda t: (-t[0], t[1]))
    got = sorted(((r.k, r.s), r.pos) for r in out)
    assert sorted(p for _, p in got) == list(range(1, len(keys) + 1))
    assert {key: pos for key, pos in got} == {key: i + 1 for i, key in enumerate(want)}


@SETTINGS
@given(
    days=st.lists(st.integers(1, 40), min_size=1, max_size=25, unique=True),
    n=st.integers(1, 8),
)
def test_rolling_mean_matches_model(spark, days, n):
    days = sorted(days)
    rows = [Row(date=dt.date(2024, 1, 1) + dt.timedelta(days=d), platform="P", spend=float(d * 3 % 17)) for d in days]
    df = spark.createDataFrame(rows)
    by_rows = {r.date: r.a for r in rolling_mean(df, "spend", n, "rows", out="a").collect()}
    by_days = {r.date: r.a for r in rolling_mean(df, "spend", n, "days", out="a").collect()}
    for i, r in enumerate(rows):
        last = [x.spend for x in rows[max(0, i - n + 1): i + 1]]
        assert math.isclose(by_rows[r.date], sum(last) / len(last))
        window = [x.spend for x in rows if 0 <= (r.date - x.date).days <= n - 1]
        assert math.isclose(by_days[r.date], sum(window) / len(window))


@SETTINGS
@given(
    camps=st.lists(
        st.tuples(st.sampled_from(["F", "G", "T"]), st.sampled_from(["a", "b", "c", "d"]),
                  st.integers(0, 5), st.integers(0, 3)),
        min_size=1, max_size=12, unique_by=lambda t: (t[0], t[1]),
    )
)
def test_best_worst_matches_model(spark, camps):
    rows = [Row(platform=p, campaign_name=n, spend=float(s), conversions=c, cpa=(s / c if c else None))
            for p, n, s, c in camps]
    df = spark.createDataFrame(rows, "platform string, campaign_name string, spend double, conversions bigint, cpa double")
    got = {r.kind: (r.platform, r.campaign_name) for r in best_worst(df, "cpa").collect()}

    def key(r):
        if r.conversions == 0 and r.spend > 0:
            return math.inf
        return r.cpa

    ranked = [r for r in rows if key(r) is not None]
    if not ranked:
        assert got == {}
        return
    best = min(ranked, key=lambda r: (key(r), r.platform, r.campaign_name))
    worst = min(ranked, key=lambda r: (-key(r), r.platform, r.campaign_name))
    assert got == {"best": (best.platform, best.campaign_name), "worst": (worst.platform, worst.campaign_name)}


@SETTINGS
@given(
    values=st.lists(
        st.one_of(
            st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False),
            st.sampled_from([0.125, 2.675, 1234.5, -0.125, 0.005, 1e-7, 999999.995]),
        ),
        min_size=1, max_size=30,
    )
)
def test_formatting_matches_python_format(spark, values):
    from adfuse.functions import fmt_currency, fmt_fixed, fmt_multiple, fmt_number, fmt_percent

    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    out = df.select(
        "x",
        fmt_currency("x", 2).alias("cur"),
        fmt_currency("x", 3, grouping=False).alias("cur3"),
        fmt_fixed("x", 2).alias("fix"),
        fmt_number("x", 0).alias("num"),
        fmt_multiple("x", 2).alias("mul"),
        fmt_percent("x", 2).alias("pct"),
    ).collect()
    for r in out:
        x = r.x
        assert r.cur == "$" + format(x, ",.2f"), x
        assert r.cur3 == "$" + format(x, ".3f"), x
        assert r.fix == format(x, ".2f"), x
        assert r.num == format(x, ",.0f"), x
        assert r.mul == format(x, ".2f") + "×", x
        assert r.pct == format(x * 100, ".2f") + "%", x
