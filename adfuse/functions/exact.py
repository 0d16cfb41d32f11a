"""Sums of doubles that do not depend on the order of the rows.

A double is cut into a whole number of 2**-20 and one of 2**-80; both are
summed as decimals, which is exact, and put together once at the end.  So the
result is the same bits however the rows are partitioned or merged.  Bits of a
value below 2**-80 do not count; a value of 2**43 or more in size fails the
job, as does infinity (NULL adds nothing).  Wide sums take values of that size
too, as sums of sums reach them: the multiples of 2**43 are counted apart, and
only sums of 2**106 or more fail.
"""

from __future__ import annotations

#: The two units are 1 / HIGH and 1 / (HIGH * LOW), that of wide sums is TOP.
HIGH, LOW, TOP = 1 << 20, 1 << 60, 1 << 43
_UNIT = f"CAST({LOW} AS DECIMAL(19,0))"


def exact_sum_sql(value: str, wide: bool = False) -> str:
    """SQL text of the sum of a double expression; NULL without values."""
    above = ""
    if wide:  # the rest is exact: it has the value's sign and is a multiple of its last bit
        top = f"CAST(({value}) * {1 / TOP!r}D AS BIGINT)"
        above = f"CAST(sum({top}) AS DECIMAL(19,0)) * CAST({TOP * HIGH} AS DECIMAL(19,0)) + "
        value = f"({value}) - {top} * {TOP}D"
    scaled = f"(({value}) * {HIGH}D)"
    high = f"sum(CAST(floor({scaled}) AS DECIMAL(20,0)))"
    low = f"sum(CAST(CAST(({scaled} - floor({scaled})) * {LOW}D AS BIGINT) AS DECIMAL(19,0)))"
    whole = f"CAST({above}{high} + ({low} div {_UNIT}) AS DOUBLE) / {HIGH}D"
    return f"({whole} + CAST({low} % {_UNIT} AS DOUBLE) / {HIGH * LOW}D)"


def exact_mean_sql(value: str, wide: bool = False) -> str:
    """SQL text of the mean of a double expression; NULL without values."""
    return f"({exact_sum_sql(value, wide)} / count({value}))"
