"""Bring rows of several sources into one shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vigil.functions.text import blank_to_null


def conformed_union(branches: list[DataFrame]) -> DataFrame:
    """UNION ALL of branches that must carry exactly the same columns and types."""
    want = {f.name: f.dataType for f in branches[0].schema}
    for branch in branches[1:]:
        have = {f.name: f.dataType for f in branch.schema}
        if have != want:
            odd = sorted(n for n in want.keys() | have.keys() if want.get(n) != have.get(n))
            raise ValueError(f"branch differs from the canonical columns: {odd}")
    return reduce(DataFrame.unionByName, branches)


def canonical_spelling(df: DataFrame, column: str) -> DataFrame:
    """One spelling (the smallest, in byte order) per case-folded value.

    Equal spellings collapse in a hash aggregate first; only the distinct ones are compared.
    """
    spellings = df.select(blank_to_null(F.col(column)).alias(column)).distinct()
    return (
        spellings.filter(F.col(column).isNotNull())
        .groupBy(F.lower(column).alias(f"{column}_normalized"))
        .agg(F.min(column).alias(column))
    )


def zero_filled_union(branches: list[DataFrame], measures: list[str]) -> DataFrame:
    """UNION ALL of branches with different measures; measures a branch lacks become 0."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    return union.fillna(0, measures)

