"""Scalar guards with the null behaviour of the published pipeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_or_zero(column: Column) -> Column:
    """Sum where a group of only nulls gives 0."""
    return F.coalesce(F.sum(column), F.lit(0))


def clip_lower(column: Column, bound: int = 0) -> Column:
    """Raise smaller values to the bound; nulls stay null (`greatest` alone would drop them)."""
    return F.when(column < bound, F.lit(bound)).otherwise(column)


def cap_upper(column: Column, cap: Column) -> Column:
    """Lower larger values to the cap, rounded half away from zero to a whole number."""
    whole_cap = F.round(cap, 0).cast("bigint")
    return F.when(column > cap, whole_cap).otherwise(F.round(column, 0).cast("bigint"))


def nearest_rank(count: Column, q: float) -> Column:
    """0-based position of the q-quantile among `count` sorted values: an observed value, never interpolated."""
    return F.floor((count - 1) * F.lit(q) + F.lit(0.5))


def millions(column: Column, digits: int, unit: float = 1e6) -> Column:
    return F.round(column / F.lit(float(unit)), digits)
