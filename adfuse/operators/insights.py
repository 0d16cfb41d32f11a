"""Rankings, leaders and target flags behind the dashboard's insights.

Arg-min / arg-max use ``min_by`` over a struct ordering key (metric, then the
name columns as tie-break) inside an ordinary aggregate: partial per task,
one small final merge, no global sort and no single-task window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfuse.operators.windows import global_row_number, top_n

NAME_KEYS: tuple[str, ...] = ("platform", "campaign_name")

# Fixed value: the ROAS target line of the search-channel view.
ROAS_TARGET = 4.0


def cpa_rank_key(cpa: str = "cpa", spend: str = "spend", conversions: str = "conversions") -> Column:
    """CPA as a ranking key: money spent with no conversion ranks as +Infinity
    (worst); 0 spend with 0 conversions stays NULL (never best nor worst)."""
    return F.when(
        (F.col(conversions) == F.lit(0)) & (F.col(spend) > F.lit(0)), F.lit(float("inf"))
    ).otherwise(F.col(cpa))


def _key(metric: str) -> Column:
    return cpa_rank_key() if metric == "cpa" else F.col(metric)


def _ordering(key: Column, largest: bool, tie: Sequence[str]) -> Column:
    # NULL keys become a NULL ordering value, which min_by skips.
    k = -key if largest else key
    return F.when(key.isNotNull(), F.struct(k.alias("k"), *[F.col(t) for t in tie]))


def _arg_best(df: DataFrame, key: Column, largest: bool, tie: Sequence[str]) -> Column:
    payload = F.struct(*[F.col(c) for c in df.columns])
    return F.min_by(payload, _ordering(key, largest, tie))


def best_worst(
    camp: DataFrame,
    metric: str = "cpa",
    lower_is_better: bool = True,
    tie: Sequence[str] = NAME_KEYS,
) -> DataFrame:
    """Two rows (kind = 'best' / 'worst') holding the whole winning rows.

    Ties go to the first row in ``tie`` order for both kinds.
    """
    key = _key(metric)
    both = camp.agg(
        _arg_best(camp, key, not lower_is_better, tie).alias("best"),
        _arg_best(camp, key, lower_is_better, tie).alias("worst"),
    )
    rows = both.select(
        F.inline(
            F.array(
                F.struct(F.lit("best").alias("kind"), F.col("best").alias("r")),
                F.struct(F.lit("worst").alias("kind"), F.col("worst").alias("r")),
            )
        )
    )
    return rows.where(F.col("r").isNotNull()).select("kind", "r.*")


def leader(
    df: DataFrame, metric: str, largest: bool = True, tie: Sequence[str] = NAME_KEYS
) -> DataFrame:
    """The single row with the largest (or smallest) ``metric``; no row if all NULL."""
    one = df.agg(_arg_best(df, _key(metric), largest, tie).alias("r"))
    return one.where(F.col("r").isNotNull()).select("r.*")


def best_per_group(
    camp: DataFrame,
    by: Sequence[str] = ("platform",),
    metric: str = "cpa",
    lower_is_better: bool = True,
    tie: Sequence[str] = ("campaign_name",),
) -> DataFrame:
    """Best row of each group (e.g. best campaign within each platform).

    A grouped ``min_by``: partial aggregation keeps a hot group cheap.
    """
    payload_cols = [c for c in camp.columns if c not in by]
    payload = F.struct(*[F.col(c) for c in payload_cols])
    best = camp.groupBy(*by).agg(
        F.min_by(payload, _ordering(_key(metric), not lower_is_better, tie)).alias("r")
    )
    return best.where(F.col("r").isNotNull()).select(*by, "r.*")


def rank_order(metric: str, ascending: bool = True, tie: Sequence[str] = NAME_KEYS) -> list[Column]:
    """Total order on ``metric`` (NULLs last) with name tie-breaks."""
    key = _key(metric)
    first = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    return [first, *[F.col(t).asc_nulls_last() for t in tie]]


def rank_campaigns(
    camp: DataFrame, metric: str = "cpa", ascending: bool = True, out: str | None = None
) -> DataFrame:
    """Every campaign with its 1-based position in the ``metric`` order."""
    return global_row_number(camp, rank_order(metric, ascending), out or f"{metric}_rank")


def top_campaigns(
    camp: DataFrame, metric: str = "cpa", n: int = 5, ascending: bool = True, out: str = "rank"
) -> DataFrame:
    """The best ``n`` campaigns by ``metric`` (a top-k report)."""
    return top_n(camp, rank_order(metric, ascending), n, out)


def below_target(
    camp: DataFrame,
    platform: str = "Google",
    metric: str = "roas",
    target: float = ROAS_TARGET,
) -> DataFrame:
    """Campaigns of ``platform`` whose defined ``metric`` misses ``target``,
    with the spend at stake and the gap to target."""
    return camp.where(
        (F.col("platform") == F.lit(platform)) & (F.col(metric) < F.lit(target))
    ).select(
        "platform",
        "campaign_name",
        metric,
        "spend",
        (F.lit(target) - F.col(metric)).alias("gap_to_target"),
    )


def platform_leaders(plat: DataFrame) -> DataFrame:
    """Platform with most conversions and platform with the lowest CPM.

    ``plat`` needs platform, conversions and cpm columns (one row per platform).
    """
    tie = ("platform",)
    most = _arg_best(plat, F.col("conversions"), True, tie)
    cheapest = _arg_best(plat, F.col("cpm"), False, tie)
    both = plat.agg(most.alias("a"), cheapest.alias("b"))
    rows = both.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("most_conversions").alias("leader"),
                    F.col("a.platform").alias("platform"),
                    F.col("a.conversions").cast("double").alias("value"),
                ),
                F.struct(
                    F.lit("lowest_cpm").alias("leader"),
                    F.col("b.platform").alias("platform"),
                    F.col("b.cpm").alias("value"),
                ),
            )
        )
    )
    return rows.where(F.col("platform").isNotNull())
