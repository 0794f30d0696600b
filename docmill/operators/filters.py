"""Predicates built on the driver from optional parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


@dataclass(frozen=True)
class SearchFilters:
    """Several values of one filter mean OR, different filters mean AND; bounds are inclusive."""

    source: Sequence[str] = field(default_factory=tuple)
    decision_type: Sequence[str] = field(default_factory=tuple)
    sector: Sequence[str] = field(default_factory=tuple)
    date_from: date | None = None
    date_to: date | None = None

    def condition(self) -> Column:
        parts = []
        if self.source:
            parts.append(F.col("source").isin(*self.source))
        if self.decision_type:
            parts.append(F.col("decision_type").isin(*self.decision_type))
        if self.sector:
            parts.append(F.arrays_overlap("sectors", F.array(*[F.lit(s) for s in self.sector])))
        if self.date_from is not None:
            parts.append(F.col("decision_date") >= F.lit(self.date_from))
        if self.date_to is not None:
            parts.append(F.col("decision_date") <= F.lit(self.date_to))
        return all_of(parts)


def optional(df: DataFrame, **values: object) -> DataFrame:
    """Equality or membership per given parameter; None or an empty list means all."""
    parts = []
    for name, value in values.items():
        if value is None or (isinstance(value, (list, tuple)) and not value):
            continue
        many = isinstance(value, (list, tuple))
        parts.append(F.col(name).isin(*value) if many else F.col(name) == value)
    return df.filter(all_of(parts))


def time_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows between two moments, both included."""
    return df.filter(F.col(column).between(F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end))))
