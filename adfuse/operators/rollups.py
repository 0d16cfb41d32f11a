"""Roll-ups of the unified fact.

Every roll-up is a hash aggregate with map-side partial aggregation, so a
hot key (one platform or campaign holding a third of the rows) contributes
one partial row per map task to the shuffle, never its raw rows.  Ratios are
computed after aggregation as ratio of sums.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfuse.functions.exact import exact_mean_sql, exact_sum_sql
from adfuse.functions.ratios import RATIOS, q, safe_div
from adfuse.schema import CAMPAIGN_MEASURES, DAILY_MEASURES, FACT_ROLES, PLATFORM_MEASURES


def _sum0_sql(c: str, exact: bool = False) -> str:
    # An all-NULL group sums to 0 (e.g. conv_value of channels without it).
    if exact and FACT_ROLES.get(c) in ("money", "value"):
        return f"coalesce({exact_sum_sql(q(c), wide=True)}, 0D)"
    return f"coalesce(sum({q(c)}), 0)"


def _sum0(c: str, exact: bool = False) -> Column:
    return F.expr(f"{_sum0_sql(c, exact)} AS {q(c)}")


def _ratio_of_sums(name: str, exact: bool = False) -> Column:
    r = RATIOS[name]
    return F.expr(f"{r.sql(_sum0_sql(r.numerator, exact), _sum0_sql(r.denominator, exact))} AS {q(name)}")


def daily_rollup(fact: DataFrame, measures: Sequence[str] = DAILY_MEASURES) -> DataFrame:
    """(date, platform) series: daily sums of spend, conversions, impressions, clicks.

    As in every roll-up, NULL measures add nothing and an all-NULL day is 0.
    """
    return fact.groupBy("date", "platform").agg(*[_sum0(m) for m in measures])


def rollup(
    fact: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    ratios: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Sum ``measures`` by ``keys`` and add ratio-of-sums ``ratios``, in one
    aggregate (each ``sum`` is computed once however often it is referenced).

    ``exact`` sums amounts of money without rounding in between
    (``functions.exact``), so the last digits do not depend on how the rows are
    partitioned; it costs about as much again as the plain sums.  The sums are
    wide: ``fact`` may itself hold sums."""
    sums = [_sum0(m, exact) for m in measures]
    return fact.groupBy(*keys).agg(*sums, *[_ratio_of_sums(r, exact) for r in ratios])


def campaign_day_rollup(fact: DataFrame, exact: bool = False) -> DataFrame:
    """(date, platform, campaign_name) sums of every additive measure.

    Every filter dimension and every roll-up of the dashboard can be answered
    from this table (sums of sums), and its size is days x campaigns rather
    than fact rows: aggregate the fact once, derive the rest from it.
    """
    return rollup(fact, ["date", "platform", "campaign_name"], PLATFORM_MEASURES, exact=exact)


def platform_rollup(fact: DataFrame) -> DataFrame:
    """One row per platform: 7 sums plus ctr, cpc, cpa."""
    return rollup(fact, ["platform"], PLATFORM_MEASURES, ["ctr", "cpc", "cpa"])


def campaign_rollup(fact: DataFrame, exact: bool = False) -> DataFrame:
    """One row per (platform, campaign_name): 5 sums plus ctr, cpa, roas."""
    return rollup(fact, ["platform", "campaign_name"], CAMPAIGN_MEASURES, ["ctr", "cpa", "roas"], exact)


def platform_cpm(fact: DataFrame) -> DataFrame:
    """Cost per thousand impressions per platform."""
    return rollup(fact, ["platform"], ["spend", "impressions"], ["cpm"])


def daily_ctr(series: DataFrame) -> DataFrame:
    """Daily CTR in percent from the (date, platform) series."""
    return series.select("date", "platform", "clicks", "impressions", RATIOS["ctr_pct"].column().alias("ctr_pct"))


_PORTFOLIO_SUMS = [
    f"{exact_sum_sql('spend', wide=True)} AS _s",
    "sum(conversions) AS _v",
    "sum(impressions) AS _i",
    "sum(clicks) AS _c",
]


def _portfolio_cols() -> list[Column]:
    zero = F.lit(0.0)
    return [
        F.coalesce(F.col("_s"), zero).alias("total_spend"),
        F.coalesce(F.col("_v"), F.lit(0).cast("bigint")).alias("total_conversions"),
        F.coalesce(F.col("_i"), F.lit(0).cast("bigint")).alias("total_impressions"),
        F.coalesce(F.col("_c"), F.lit(0).cast("bigint")).alias("total_clicks"),
        F.coalesce(safe_div("_s", "_v"), zero).alias("portfolio_cpa"),
        F.coalesce(safe_div("_c", "_i") * F.lit(100.0), zero).alias("portfolio_ctr_pct"),
        F.coalesce(safe_div("_s", "_c"), zero).alias("portfolio_cpc"),
    ]


def portfolio_kpis(fact: DataFrame) -> DataFrame:
    """One-row KPI tile values; ratios are 0 when their denominator is 0.

    Works on the fact or on any roll-up of it (sums of sums).  A global
    aggregate: partial sums per task, a single final row.  An empty input
    yields a row of zeros.
    """
    return fact.agg(*[F.expr(e) for e in _PORTFOLIO_SUMS]).select(*_portfolio_cols())


def kpi_summary(camp: DataFrame, platform: str = "Google") -> DataFrame:
    """Portfolio KPIs plus the ROAS KPI of ``platform`` in one aggregate.

    ``camp`` is the campaign roll-up (one row per platform x campaign with its
    ``roas``): the totals are sums of campaign sums and the ROAS mean is the
    mean over that platform's campaigns, so the fact is read once.  All sums
    are exact: they do not depend on the order of the campaigns.
    """
    own = ["roas", "conv_value", "spend"]
    mine = camp.select("*", *[F.when(F.col("platform") == F.lit(platform), F.col(c)).alias(f"_own_{c}") for c in own])
    agg = mine.agg(
        *[F.expr(e) for e in _PORTFOLIO_SUMS],
        F.expr(f"{exact_mean_sql('_own_roas', wide=True)} AS _m"),
        F.expr(f"{exact_sum_sql('_own_conv_value', wide=True)} AS _pv"),
        F.expr(f"{exact_sum_sql('_own_spend', wide=True)} AS _ps"),
    )
    return agg.select(
        *_portfolio_cols(),
        F.coalesce(F.col("_m"), F.lit(0.0)).alias("mean_campaign_roas"),
        safe_div("_pv", "_ps").alias("pooled_roas"),
    )


def mean_campaign_roas(fact: DataFrame, platform: str = "Google") -> DataFrame:
    """The ROAS KPI two ways, for one platform.

    mean_campaign_roas  unweighted mean of per-campaign ROAS (the dashboard's
                        tile); campaigns with undefined ROAS are skipped, 0
                        when none is defined
    pooled_roas         sum(conv_value) / sum(spend) over the same rows

    Both come from one pass: the pooled sums are sums of the per-campaign sums.
    All sums are exact, so the result has the same bits in whatever order the
    rows come.
    """
    rows = fact.where(F.col("platform") == F.lit(platform))
    per_campaign = rollup(rows, ["campaign_name"], ["spend", "conv_value"], ["roas"], exact=True)
    return per_campaign.agg(
        F.expr(f"coalesce({exact_mean_sql('roas', wide=True)}, 0D) AS mean_campaign_roas"),
        F.expr(f"try_divide({exact_sum_sql('conv_value', wide=True)}, {exact_sum_sql('spend', wide=True)}) AS pooled_roas"),
    )


def date_extent(fact: DataFrame) -> DataFrame:
    """Earliest and latest date (bounds of the date picker)."""
    return fact.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def campaign_names(fact: DataFrame) -> DataFrame:
    """Distinct campaign names (options of the campaign picker)."""
    return fact.select("campaign_name").distinct()
