"""Surrogate keys and source record identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vigil.functions.text import first_present

# Fixed value: stands for a missing part, so that (a, null) and (null, a) differ.
NULL_PART = "_dbt_utils_surrogate_key_null_"
UNKNOWN_MEMBER = "UNKNOWN"


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts as text, joined by dashes."""
    texts = (F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts)
    return F.md5(F.concat_ws("-", *texts))


def unknown_key() -> Column:
    return surrogate_key(F.lit(UNKNOWN_MEMBER))


def record_id(row_id: Column, *candidates: Column) -> Column:
    """First candidate that is not blank, else the row id."""
    return F.coalesce(first_present(*candidates), row_id.cast("string"))
