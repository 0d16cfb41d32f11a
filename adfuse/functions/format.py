"""Presentation helpers: labels, unit scaling and display formatting.

All are built-in column expressions (no Python UDFs).  ``format_number``
rounds half-even on the binary value, like Python's ``format``; numeric
columns stay next to the text so nothing authoritative is lost.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed unit divisors used by the KPI tiles.
UNITS: dict[str, float] = {"K": 1000.0, "M": 1_000_000.0}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_label(c: str | Column) -> Column:
    """Campaign names are snake_case in the feeds; display with spaces."""
    return F.translate(_col(c), "_", " ")


def scale(c: str | Column, unit: str) -> Column:
    """Express a value in thousands ("K"), millions ("M") or percent ("%")."""
    if unit == "%":
        return _col(c) * F.lit(100.0)
    return _col(c) / F.lit(UNITS[unit])


def fmt_number(c: str | Column, decimals: int = 0) -> Column:
    """Thousands-separated fixed-point text: 12345.6 -> '12,346'."""
    return F.format_number(_col(c), decimals)


def fmt_fixed(c: str | Column, decimals: int = 2) -> Column:
    """Fixed-point text without separators: 12345.678 -> '12345.68'.

    A DecimalFormat pattern ('0.00') keeps the half-even rounding of
    ``format_number`` without grouping.
    """
    pattern = "0." + "0" * decimals if decimals > 0 else "0"
    return F.call_function("format_number", _col(c), F.lit(pattern))


def _num(c: str | Column, decimals: int, grouping: bool) -> Column:
    return fmt_number(c, decimals) if grouping else fmt_fixed(c, decimals)


def fmt_currency(
    c: str | Column, decimals: int = 2, symbol: str = "$", grouping: bool = True
) -> Column:
    """'$1,234.50' (or '$1234.50' without grouping); NULL stays NULL."""
    return F.concat(F.lit(symbol), _num(c, decimals, grouping))


def fmt_percent(
    c: str | Column, decimals: int = 2, already_pct: bool = False, grouping: bool = False
) -> Column:
    """Fraction -> '1.23%' (multiplies by 100 first unless ``already_pct``)."""
    v = _col(c) if already_pct else _col(c) * F.lit(100.0)
    return F.concat(_num(v, decimals, grouping), F.lit("%"))


def fmt_multiple(c: str | Column, decimals: int = 2, grouping: bool = False) -> Column:
    """ROAS-style multiple: 9.8058 -> '9.81×'."""
    return F.concat(_num(c, decimals, grouping), F.lit("×"))


def fmt_scaled(
    c: str | Column, unit: str, decimals: int = 1, prefix: str = "", grouping: bool = False
) -> Column:
    """KPI tile text: spend 130244.9 with unit K -> '$130.2K'."""
    return F.concat(F.lit(prefix), _num(scale(c, unit), decimals, grouping), F.lit(unit))
