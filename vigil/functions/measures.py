"""Additive 0/1 measures and rates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def count_when(condition: Column, n: Column | None = None) -> Column:
    """The row's count when the condition holds, else 0. Sums to a conditional count."""
    one = F.lit(1) if n is None else F.coalesce(n, F.lit(1))
    return F.when(condition, one).otherwise(0).cast("int")


def counts_by_value(value: Column, names: dict[str, str], n: Column | None = None) -> list[Column]:
    """One measure per value: {value: output name}."""
    return [count_when(value == v, n).alias(name) for v, name in names.items()]


def rate(part: Column, whole: Column) -> Column:
    """Percentage to two decimals, null when the whole is zero or missing."""
    return F.round(100 * F.try_divide(part.cast("double"), whole.cast("double")), 2)
