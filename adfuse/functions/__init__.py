from adfuse.functions.format import (
    clean_label,
    fmt_currency,
    fmt_fixed,
    fmt_multiple,
    fmt_number,
    fmt_percent,
    fmt_scaled,
    scale,
)
from adfuse.functions.ratios import RATIOS, Ratio, nan_to_null, ratio, safe_div, with_ratios

__all__ = [
    "RATIOS",
    "Ratio",
    "clean_label",
    "fmt_currency",
    "fmt_fixed",
    "fmt_multiple",
    "fmt_number",
    "fmt_percent",
    "fmt_scaled",
    "nan_to_null",
    "ratio",
    "safe_div",
    "scale",
    "with_ratios",
]
