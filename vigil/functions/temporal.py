"""Dates and times: tolerant parsing, ages, calendar and epidemiological weeks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted text forms.
# Year 0000 fits none of them.
ISO_DATE = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
DMY_DATE = r"^[0-9]{2}/[0-9]{2}/(?!0000)[0-9]{4}\z"
ISO_MOMENT = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?)?\z"
ISO_INSTANT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?"
    r"([+-][0-9]{2}(:?[0-9]{2})?|Z)?\z"
)
STARTS_WITH_DATE = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"
LOCAL_ZONE = "Africa/Nairobi"


def safe_date(c: Column) -> Column:
    """YYYY-MM-DD or DD/MM/YYYY with a real calendar day of year 1-9999, else null."""
    text = F.trim(c)
    return F.when(text.rlike(ISO_DATE), text.try_cast("date")).when(text.rlike(DMY_DATE), _day_first(text))


def _day_first(text: Column) -> Column:
    """DD/MM/YYYY by a cast, which is several times faster than a pattern; null if there is no such day."""
    parts = (F.substring(text, at, n) for at, n in ((7, 4), (4, 2), (1, 2)))
    return F.concat_ws("-", *parts).try_cast("date")


def safe_timestamp(c: Column, day_first: bool = True) -> Column:
    """A date, or date and time with optional fraction; day_first also takes DD/MM/YYYY.

    A text with a zone offset fits none of the forms and gives null.
    """
    text = F.trim(c)
    parsed = F.when(text.rlike(ISO_MOMENT), text.try_cast("timestamp"))
    if day_first:
        parsed = parsed.when(text.rlike(DMY_DATE), _day_first(text).cast("timestamp"))
    return parsed


def instant(c: Column) -> Column:
    """ISO text, usually with an offset, to the instant it names; other text is null."""
    text = F.trim(c)
    return F.when(text.rlike(STARTS_WITH_DATE), text.try_cast("timestamp"))


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def full_years(later: Column, earlier: Column) -> Column:
    """Whole years between two dates, truncated toward zero, negative if reversed.

    As numbers of the form yyyymmdd two dates differ by 10000 a year, whatever the day.
    """

    def number(day: Column) -> Column:
        return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)

    return ((number(later) - number(earlier)) / 10000).cast("int")


def banded(number: Column, bands: list[tuple[int, str]], last: str) -> Column:
    """First band whose inclusive upper bound holds the number (0 or more), else `last`.

    The label is read from a constant array by position: one use of the number.
    """
    labels, low = [], 0
    for upper, label in bands:
        labels += [label] * (upper - low + 1)
        low = upper + 1
    return F.coalesce(F.get(F.array(*map(F.lit, labels)), number), F.lit(last))


# The two sets of age groups, as (highest age, label).
CASE_AGE_BANDS = [
    (4, "0-4"), (14, "5-14"), (24, "15-24"), (34, "25-34"),
    (44, "35-44"), (54, "45-54"), (64, "55-64"),
]
PERSON_AGE_BANDS = [
    (0, "<1"), (4, "1-4"), (9, "5-9"), (14, "10-14"), (19, "15-19"), (24, "20-24"),
    (34, "25-34"), (44, "35-44"), (54, "45-54"), (64, "55-64"),
]
OLDEST_BAND = "65+"


def case_age(event: Column, birth: Column) -> Column:
    return F.when(birth <= event, full_years(event, birth))


def case_age_group(event: Column, birth: Column) -> Column:
    return (
        F.when(birth.isNull() | event.isNull(), "UNKNOWN")
        .when(birth > event, "INVALID")
        .otherwise(banded(full_years(event, birth), CASE_AGE_BANDS, OLDEST_BAND))
    )


def person_age_group(age: Column) -> Column:
    return F.when(age.isNull() | (age < 0), "UNKNOWN").otherwise(
        banded(age, PERSON_AGE_BANDS, OLDEST_BAND)
    )


def padded_name(day: Column, pattern: str) -> Column:
    """Full month or day name, blank-padded to nine characters."""
    return F.rpad(F.date_format(day, pattern), 9, " ")


def epi_week_start(day: Column) -> Column:
    """Sunday on or before the day; weeks run Sunday to Saturday."""
    return F.date_sub(F.to_date(F.date_trunc("week", F.date_add(day, 1))), 1)


def epi_week_number(saturday: Column) -> Column:
    return F.weekofyear(saturday)


def epi_year(saturday: Column) -> Column:
    """Year of the closing Saturday, less one when January still counts week 52 or 53."""
    carried = (F.month(saturday) == 1) & F.weekofyear(saturday).isin(52, 53)
    return F.year(saturday) - carried.cast("int")


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)


def week_label(year: Column, week: Column) -> Column:
    """`YYYY-Www`; missing parts leave their place empty, so no date gives `-W`."""
    return F.concat(
        F.coalesce(year.cast("string"), F.lit("")),
        F.lit("-W"),
        F.coalesce(F.lpad(week.cast("string"), 2, "0"), F.lit("")),
    )


def calendar_parts(day: Column) -> dict[str, Column]:
    """Reporting columns derived from one date, with ISO (Monday) weeks."""
    year, week = iso_year(day).cast("int"), F.weekofyear(day)
    return {
        "reporting_year": F.year(day),
        "reporting_quarter": F.quarter(day),
        "reporting_month": F.month(day),
        "reporting_month_name": F.date_format(day, "MMMM"),
        "reporting_year_month": F.date_format(day, "yyyy-MM"),
        "reporting_epi_year": year,
        "reporting_epi_week": week,
        "reporting_epi_week_label": week_label(year, week),
    }


def turnaround_days(collected: Column, resulted: Column) -> Column:
    days = F.datediff(F.to_date(resulted), collected)
    return F.when(days >= 0, days)


def turnaround_hours(collected: Column, resulted: Column) -> Column:
    start = collected.cast("timestamp")
    # Hundredths of an hour, halves up, as whole numbers.
    micros = F.unix_micros(resulted) - F.unix_micros(start)
    hundredths = F.call_function("div", micros + 18_000_000, F.lit(36_000_000))
    hours = hundredths.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")
    return F.when(resulted >= start, hours.cast("decimal(18,2)"))


def turnaround_band(collected: Column, resulted: Column) -> Column:
    days = F.datediff(F.to_date(resulted), collected)
    return (
        F.when(days.isNull(), "UNKNOWN")
        .when(days < 0, "INVALID")
        .otherwise(
            banded(
                days,
                [(0, "SAME DAY"), (1, "1 DAY"), (3, "2-3 DAYS"), (7, "4-7 DAYS")],
                "OVER 7 DAYS",
            )
        )
    )
