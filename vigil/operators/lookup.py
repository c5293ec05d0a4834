"""Dimension lookups.

All are left joins against a side that is unique on its key, so rows are kept one to one.
No side is forced to broadcast: Spark broadcasts it when its measured size is under
spark.sql.autoBroadcastJoinThreshold and otherwise shuffles, with skewed keys split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from vigil.functions.temporal import epi_week_start
from vigil.functions.text import folded
from vigil.session import stored_bytes

MISSING_DATE_KEY = -1


class RepeatedKey(ValueError):
    """A dimension holds a key more than once, so a lookup gave more rows than it got."""


@dataclass
class RowGuard:
    """Row numbers around each lookup of a plan, counted while the plan runs."""

    steps: list[tuple[str, Observation, Observation]] = field(default_factory=list)
    last: tuple[DataFrame, Observation] | None = None

    def around(self, name: str, df: DataFrame, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
        if self.last is not None and self.last[0] is df:
            before = self.last[1]  # what the lookup before gave is what this one gets
        else:
            before = Observation()
            df = df.observe(before, F.count(F.lit(1)).alias("n"))
        after = Observation()
        out = join(df).observe(after, F.count(F.lit(1)).alias("n"))
        self.steps.append((name, before, after))
        self.last = out, after
        return out

    def check(self) -> None:
        """After the plan has run once."""
        for name, before, after in self.steps:
            if before.get["n"] != after.get["n"]:
                raise RepeatedKey(f"{name}: {before.get['n']} rows became {after.get['n']}")


_guard: ContextVar[RowGuard | None] = ContextVar("row_guard", default=None)


@contextmanager
def guarded_rows() -> Iterator[RowGuard]:
    """Lookups made inside count their rows. It costs no pass over any table."""
    guard = RowGuard()
    token = _guard.set(guard)
    try:
        yield guard
    finally:
        _guard.reset(token)


def _one_to_one(name: str, df: DataFrame, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
    guard = _guard.get()
    return join(df) if guard is None else guard.around(name, df, join)


def date_keys(df: DataFrame, dim_date: DataFrame, roles: dict[str, Column]) -> DataFrame:
    """Add one date key per role: {key column: date expression}. -1 outside the calendar."""
    return _one_to_one("lookup by full_date", df, lambda rows: _date_keys(rows, dim_date, roles))


def _date_keys(df: DataFrame, dim_date: DataFrame, roles: dict[str, Column]) -> DataFrame:
    for name, day in roles.items():
        side = dim_date.select(
            F.col("full_date").alias("__day"), F.col("date_key").alias("__found")
        )
        df = (
            df.withColumn("__date", day)
            .join(side, F.col("__date") == F.col("__day"), "left")
            .withColumn(name, F.coalesce(F.col("__found"), F.lit(MISSING_DATE_KEY)))
            .drop("__date", "__day", "__found")
        )
    return df


def attributes(
    df: DataFrame, dim: DataFrame, on: Column, columns: dict[str, str], dim_key: str
) -> DataFrame:
    """Resolve a key to dimension columns: {output name: dimension column}."""
    side = dim.select(
        F.col(dim_key).alias("__dim_key"),
        *(F.col(c).alias(name) for name, c in columns.items()),
    )
    return _one_to_one(
        f"lookup of {', '.join(columns.values())} by {dim_key}",
        df,
        lambda rows: rows.withColumn("__key", on)
        .join(side, F.col("__key") == F.col("__dim_key"), "left")
        .drop("__key", "__dim_key"),
    )


def enclosing_week(
    df: DataFrame, dim_epiweek: DataFrame, day: Column, columns: dict[str, str]
) -> DataFrame:
    """Columns of the week a date falls in: {output name: week column}.

    Weeks tile the calendar, so "day between week start and week end" is equality on the
    computed week start, which Spark hash-joins; the range itself would be a nested loop.
    """
    return attributes(df, dim_epiweek, epi_week_start(day), columns, "start_of_week")


def one_key_per(dim: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Lookup table: the smallest key of each case-folded value (all columns present)."""
    values = {c: folded(F.col(c).cast("string")) for c in columns}
    present = reduce(Column.__and__, (v.isNotNull() for v in values.values()))
    return (
        dim.filter(present)
        .groupBy(*(v.alias(c) for c, v in values.items()))
        .agg(F.min(key).alias("__found"))
    )


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's size statistics put the side under the broadcast threshold."""
    session = df.sparkSession
    limit = session._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return stored_bytes(df) <= limit


def cascade(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    steps: list[dict[str, str]],
    name: str,
    direct: bool | None = None,
) -> DataFrame:
    """Resolve `name` by the first step that finds a key.

    Each step maps dimension columns to columns of `df`; its values match case-folded.
    A small dimension is joined step by step, broadcast, without moving `df`. For a large
    one the steps run over the distinct value combinations only, and `df` is joined once.
    `direct` overrides the choice.
    """
    if fits_broadcast(dim) if direct is None else direct:
        return _first_found(df, dim, key, steps, name)
    sources = sorted({c for step in steps for c in step.values()})
    combos = df.select(*(folded(F.col(c)).alias(f"__c_{c}") for c in sources)).distinct()
    renamed = [{d: f"__c_{c}" for d, c in step.items()} for step in steps]
    resolved = _first_found(combos, dim, key, renamed, name).filter(F.col(name).isNotNull())
    on = reduce(
        Column.__and__, (folded(F.col(c)).eqNullSafe(F.col(f"__c_{c}")) for c in sources)
    )
    return df.join(resolved, on, "left").drop(*(f"__c_{c}" for c in sources))


def _first_found(
    df: DataFrame, dim: DataFrame, key: str, steps: list[dict[str, str]], name: str
) -> DataFrame:
    found = []
    for i, step in enumerate(steps):
        side = one_key_per(dim, list(step), key).withColumnsRenamed(
            {**{c: f"__d{i}_{c}" for c in step}, "__found": f"__found{i}"}
        )
        on = reduce(
            Column.__and__,
            (folded(F.col(source)) == F.col(f"__d{i}_{c}") for c, source in step.items()),
        )
        df = df.join(side, on, "left").drop(*(f"__d{i}_{c}" for c in step))
        found.append(f"__found{i}")
    return df.withColumn(name, F.coalesce(*found)).drop(*found)


def not_in(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key the other side does not hold yet."""
    return df.join(other.select(on), on, "left_anti").select(df.columns)
