"""Weekly trends over already aggregated totals.

Frames count rows, not calendar weeks: a week without data is not filled in. A partition
holds one row per week, so its size is bounded by the length of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vigil.functions.measures import rate


def totals(df: DataFrame, by: list, measures: dict[str, str | Column]) -> DataFrame:
    """Sum measures per group: {output name: column or expression}."""
    return df.groupBy(*by).agg(
        *(F.sum(c).cast("bigint").alias(name) for name, c in measures.items())
    )


def year_to_date(df: DataFrame, by: list[str], year: str, week: str, measures: dict[str, str]) -> DataFrame:
    """Running totals inside a year: {output name: measure}."""
    frame = (
        W.partitionBy(*by, year)
        .orderBy(week)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return df.withColumns({name: F.sum(c).over(frame) for name, c in measures.items()})


def moving_average(df: DataFrame, by: list[str], order: list[str], measure: str, rows: int, name: str) -> DataFrame:
    """Mean over the row and the `rows - 1` before it."""
    frame = W.partitionBy(*by).orderBy(*order).rowsBetween(1 - rows, W.currentRow)
    return df.withColumn(name, F.round(F.avg(measure).over(frame), 2))


def change_from_previous(df: DataFrame, by: list[str], order: list[str], measure: str, names: tuple[str, str, str]) -> DataFrame:
    """Previous row's total, the change from it, and the change in percent."""
    previous, change, percent = names
    frame = W.partitionBy(*by).orderBy(*order)
    before = F.lag(measure).over(frame)
    return (
        df.withColumn(previous, before)
        .withColumn(change, F.col(measure) - F.col(previous))
        .withColumn(percent, rate(F.col(change), F.col(previous)))
    )


def with_rates(df: DataFrame, rates: dict[str, tuple[str, str]]) -> DataFrame:
    """{output name: (part column, whole column)}"""
    return df.withColumns({n: rate(F.col(p), F.col(w)) for n, (p, w) in rates.items()})
