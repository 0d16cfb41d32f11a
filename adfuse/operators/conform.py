"""Conform heterogeneous channel feeds to the unified fact, and union them.

``conform`` is one projection per feed (Catalyst collapses it and prunes
every raw column the fact does not need down to the scan's ReadSchema).  The
projection is emitted as SQL expression text in a single ``selectExpr`` call,
which keeps plan construction cheap for wide specs.
``unify`` is a by-name union: no shuffle, duplicates kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfuse.functions.ratios import RATIOS, q
from adfuse.schema import FACT_COLUMNS, FACT_ROLES, FACT_TYPES
from adfuse.sources.spec import FeedSpec


def _typed(expr: str, dtype: T.DataType) -> str:
    cast = f"CAST(({expr}) AS {dtype.simpleString()})"
    if isinstance(dtype, T.DoubleType):
        # NaN from an upstream float becomes NULL (Spark sorts NaN above +Inf).
        return f"nanvl({cast}, CAST(NULL AS DOUBLE))"
    return cast


def _text(value: str) -> str:
    """A SQL string literal holding any text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _check_sources(df: DataFrame, spec: FeedSpec) -> None:
    """Every renamed column exists, and no other column already has its new name."""
    missing = sorted(raw for raw in spec.rename if raw not in df.columns)
    if missing:
        raise ValueError(f"feed {spec.name!r}: renamed columns {missing} not found in {df.columns}")
    taken = sorted(c for raw, c in spec.rename.items() if c != raw and c in df.columns and c not in spec.rename)
    if taken:
        raise ValueError(f"feed {spec.name!r}: {taken} exist in the feed and are the targets of renames as well")


def _date_expr(df: DataFrame, raw: str, date_format: str) -> str:
    if isinstance(df.schema[raw].dataType, T.StringType):
        return f"try_to_date({q(raw)}, {_text(date_format)})"
    return f"CAST({q(raw)} AS DATE)"


def conform_exprs(df: DataFrame, spec: FeedSpec) -> list[str]:
    """SQL text of the conform projection, one aliased expression per fact column."""
    return [f"{expr} AS {q(name)}" for name, expr in _columns(df, spec).items()]


def _columns(df: DataFrame, spec: FeedSpec) -> dict[str, str]:
    """SQL text of each fact column.

    Resolution per canonical column, in order: ``spec.derived`` expression,
    raw column (renamed or same name), role default.  Ratios not supplied by
    the feed are recomputed from the canonical numerator / denominator
    expressions with a NULL-on-zero division (Catalyst eliminates the repeated
    subexpressions); additive measures default to 0, value to NULL.
    """
    _check_sources(df, spec)
    present = set(df.columns)
    base: dict[str, str | None] = {}
    for name in FACT_COLUMNS:
        role, dtype = FACT_ROLES[name], FACT_TYPES[name]
        raw = spec.source_for(name)
        if name in spec.derived:
            base[name] = _typed(spec.derived[name], dtype)
        elif name == "platform":
            base[name] = _text(spec.platform)
        elif name == "date" and raw in present:
            base[name] = _date_expr(df, raw, spec.date_format)
        elif raw in present:
            base[name] = _typed(q(raw), dtype)
        elif role in ("count", "money"):
            base[name] = f"CAST(0 AS {dtype.simpleString()})"
        elif role == "ratio":
            base[name] = None  # derived from the canonical columns below
        else:
            base[name] = f"CAST(NULL AS {dtype.simpleString()})"

    out = {}
    for name in FACT_COLUMNS:
        expr = base[name]
        if expr is None:
            r = RATIOS.get(name)
            if r is not None and base.get(r.numerator) and base.get(r.denominator):
                expr = r.sql(base[r.numerator], base[r.denominator])
            else:
                expr = "CAST(NULL AS DOUBLE)"
        out[name] = expr
    return out


def conform(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Project one raw feed onto the 16 canonical fact columns (one projection)."""
    try:
        return df.selectExpr(*conform_exprs(df, spec))
    except AnalysisException as e:
        raise ValueError(f"feed {spec.name!r} does not fit its spec: {e}") from e


def conform_tagged(
    df: DataFrame, tag: str, specs: Mapping[str, FeedSpec], platforms: Sequence[str] | None = None
) -> DataFrame:
    """Conform channels that share one table, in one scan and one projection.

    ``specs`` has the spec of each value of the column ``tag``; rows with any
    other value are no channel's and are left out.  A spec sees only the
    columns that it declares (all but ``tag`` if it declares none), so another
    channel's column of a canonical name is not taken for its own.  Fact
    columns that all channels express alike are that expression (so filters on
    them reach the scan), the others choose by tag.  ``platforms`` keeps only
    these platforms (none if empty): the choice becomes a filter on ``tag``,
    which the scan can use, while one on the computed ``platform`` would not
    get there.
    """
    chosen = {v: s for v, s in specs.items() if platforms is None or s.platform in platforms}
    texts = {}
    for value, spec in (chosen or specs).items():
        own = [c for c in df.columns if (c in spec.source_types if spec.source_types else c != tag)]
        texts[value] = _columns(df.select(*[df[q(c)] for c in own]), spec)
    out = []
    for name in FACT_COLUMNS:
        kinds = {value: t[name] for value, t in texts.items()}
        if len(set(kinds.values())) == 1:
            expr = next(iter(kinds.values()))
        else:
            expr = f"CASE {q(tag)} " + " ".join(f"WHEN {_text(v)} THEN {e}" for v, e in kinds.items()) + " END"
        out.append(f"{expr} AS {q(name)}")
    return df.where(F.col(q(tag)).isin(list(chosen)) if chosen else F.lit(False)).selectExpr(*out)


def unify(conformed: Iterable[DataFrame]) -> DataFrame:
    """Union conformed feeds by column name (duplicates kept, no shuffle).

    Conformed feeds share the canonical column order, so the cheaper
    positional union is used when the names line up exactly; otherwise the
    union matches columns by name.
    """
    frames = list(conformed)
    if not frames:
        raise ValueError("unify needs at least one feed")
    first = frames[0].columns
    if all(f.columns == first for f in frames[1:]):
        return reduce(lambda a, b: a.union(b), frames)
    return reduce(lambda a, b: a.unionByName(b), frames)


def conform_all(feeds: dict[str, DataFrame], specs: dict[str, FeedSpec]) -> DataFrame:
    """Conform every raw feed with its spec and union them."""
    return unify(conform(df, specs[name]) for name, df in feeds.items())
