"""Validation predicates, with SQL's three-valued logic left intact."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F

from netpulse import fixed

__all__ = ["any_at_least", "matches_id", "valid_cell_id", "valid_site_id", "valid_kpi", "in_range"]


def any_at_least(limits: dict[str, float]) -> Column:
    """True when any named column reaches its limit."""
    return reduce(or_, [F.col(name) >= F.lit(limit) for name, limit in limits.items()])


def matches_id(column: str | Column, pattern: str) -> Column:
    """Identifier check that is never NULL: a missing id does not match."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.rlike(pattern), F.lit(False))


def valid_cell_id(column: str = "cell_id") -> Column:
    return matches_id(column, fixed.CELL_ID_PATTERN)


def valid_site_id(column: str = "site_id") -> Column:
    return matches_id(column, fixed.SITE_ID_PATTERN)


def in_range(name: str, low: float, high: float | None) -> Column:
    column = F.col(name)
    return column >= low if high is None else column.between(low, high)


def valid_kpi() -> Column:
    """KPI plausibility; NULL (neither valid nor invalid) when a missing input decides."""
    ranges = [in_range(name, low, high) for name, (low, high) in fixed.KPI_RANGES.items()]
    return reduce(and_, ranges) & F.col("failure_event").isin(fixed.FAILURE_VALUES)
