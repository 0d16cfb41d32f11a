"""Ratio metrics declared once, usable at row level and after any roll-up.

All divisions go through ``try_divide`` so a zero (or NULL) denominator
yields NULL instead of an ANSI DIVIDE_BY_ZERO error; NaN never appears.
Ratios are always ratio-of-sums after aggregation: never average row ratios.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> str:
    """Backtick-quote an identifier for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def safe_div(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator, NULL when the denominator is 0 or NULL."""
    return F.try_divide(_col(numerator), _col(denominator))


def nan_to_null(c: str | Column) -> Column:
    """Map a floating NaN to NULL (Spark sorts NaN above +Infinity)."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


@dataclass(frozen=True)
class Ratio:
    name: str
    numerator: str
    denominator: str
    multiplier: float = 1.0

    def column(self) -> Column:
        c = safe_div(self.numerator, self.denominator)
        if self.multiplier != 1.0:
            c = c * F.lit(self.multiplier)
        return c

    def sql(self, numerator: str | None = None, denominator: str | None = None) -> str:
        """The ratio as SQL expression text, over the named columns or over
        the given operand expressions (e.g. their sums inside an aggregate)."""
        num = numerator if numerator is not None else q(self.numerator)
        den = denominator if denominator is not None else q(self.denominator)
        e = f"try_divide(({num}), ({den}))"
        if self.multiplier != 1.0:
            e = f"({e} * {float(self.multiplier)!r}D)"
        return e


# Fixed metric definitions (name, numerator, denominator, multiplier).
RATIOS: dict[str, Ratio] = {
    r.name: r
    for r in [
        Ratio("ctr", "clicks", "impressions"),
        Ratio("ctr_pct", "clicks", "impressions", 100.0),
        Ratio("cpc", "spend", "clicks"),
        Ratio("cpa", "spend", "conversions"),
        Ratio("roas", "conv_value", "spend"),
        Ratio("cpm", "spend", "impressions", 1000.0),
        Ratio("vid_compl_rate", "video_watch_100", "video_views"),
    ]
}


def ratio(name: str) -> Column:
    """Row-level ratio column by metric name, aliased to that name."""
    return RATIOS[name].column().alias(name)


def with_ratios(df, names: list[str]):
    """Append ratio columns computed from columns already present in ``df``
    (typically sums after a roll-up, so the result is ratio-of-sums)."""
    return df.select("*", *[ratio(n) for n in names])
