"""Numbers carried as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: plain decimal notation, no exponent, no sign but minus.
PLAIN_NUMBER = r"^-?[0-9]+(\.[0-9]+)?\z"


def bounded_double(c: Column, low: float, high: float) -> Column:
    text = F.trim(c)
    number = F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))
    return F.when(number.between(low, high), number)


def latitude(c: Column) -> Column:
    return bounded_double(c, -90, 90)


def longitude(c: Column) -> Column:
    return bounded_double(c, -180, 180)


def safe_decimal(c: Column) -> Column:
    text = F.trim(c)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("decimal(38,10)"))
