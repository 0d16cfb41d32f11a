"""Declarative feed specifications.

A channel is added by writing a ``FeedSpec``, not code: which raw column
plays which canonical role, which canonical columns are computed from raw
columns, and (for text sources) the raw column types.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping

from adfuse.schema import FACT_COLUMNS


def _frozen(m: Mapping[str, str] | None) -> Mapping[str, str]:
    return MappingProxyType(dict(m or {}))


@dataclass(frozen=True)
class FeedSpec:
    """How one channel feed maps onto the unified fact.

    name          short identifier of the feed (``"google"``)
    platform      literal written to the ``platform`` column
    source_types  raw column -> Spark SQL type name; used by typed readers
                  (CSV is read as header-named strings and cast by name)
    rename        raw column -> canonical fact column (``cost -> spend``)
    derived       canonical fact column -> SQL expression over raw columns
                  (``social_eng -> likes + shares + comments``)
    date_format   pattern for string dates in text sources

    Canonical columns not provided are defaulted by role: additive measures
    to 0, monetary value to NULL, row ratios recomputed from the canonical
    numerator/denominator when both exist, otherwise NULL.  Only columns the
    spec does not mention are defaulted: a ``rename`` target or ``derived`` key
    that is no fact column, or two sources for one column, raise ValueError.
    """

    name: str
    platform: str
    source_types: Mapping[str, str] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    derived: Mapping[str, str] = field(default_factory=dict)
    date_format: str = "yyyy-MM-dd"

    def __post_init__(self) -> None:
        object.__setattr__(self, "source_types", _frozen(self.source_types))
        object.__setattr__(self, "rename", _frozen(self.rename))
        object.__setattr__(self, "derived", _frozen(self.derived))
        targets = [*self.rename.values(), *self.derived]
        unknown = sorted({t for t in targets if t not in FACT_COLUMNS})
        if unknown:
            raise ValueError(f"feed {self.name!r}: {unknown} are not columns of the fact")
        twice = sorted({t for t in targets if targets.count(t) > 1})
        if twice:
            raise ValueError(f"feed {self.name!r}: more than one source for {twice}")

    def source_for(self, canonical: str) -> str:
        """Raw column that feeds ``canonical`` (identity unless renamed)."""
        for raw, canon in self.rename.items():
            if canon == canonical:
                return raw
        return canonical
