"""Calendar spine and epidemiological weeks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.functions import temporal as tm
from vigil.functions.keys import surrogate_key

# Default spine bounds.
SPINE_START, SPINE_END = date(2020, 1, 1), date(2035, 12, 31)
UNSET_DAY, UNSET_NUMBER, UNSET_TEXT = date(1900, 1, 1), -999, "unset"


def date_spine(
    spark: SparkSession, start: date, end: date, include_end: bool = False
) -> DataFrame:
    """One row per day. The end is left out unless asked for."""
    days = (end - start).days + int(include_end)
    return spark.range(0, max(days, 0), 1, 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day")
    )


def spine_over(bounds: DataFrame) -> DataFrame:
    """One row per day from first_day up to, but without, last_day of a one-row table. The bounds
    are found when the calendar is, in one query; without them there are no days."""
    last = F.date_sub("last_day", 1)
    days = F.when(F.col("first_day") <= last, F.sequence("first_day", last))
    return bounds.select(F.explode(days).alias("date_day"))


def date_attributes(spine: DataFrame) -> DataFrame:
    day = F.col("date_day")
    year, quarter = F.year(day), F.quarter(day)
    return spine.select(
        F.date_format(day, "yyyyMMdd").cast("bigint").alias("date_key"),
        day.alias("full_date"),
        year.alias("year"),
        quarter.alias("quarter"),
        F.month(day).alias("month"),
        tm.padded_name(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_short"),
        F.day(day).alias("day"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        (F.weekday(day) + 1).alias("day_of_week"),
        tm.padded_name(day, "EEEE").alias("day_name"),
        F.date_format(day, "E").alias("day_short"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        quarter.alias("quarter_number"),
        F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string")).alias("year_quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )


def epi_weeks(dim_date: DataFrame, as_of: date) -> DataFrame:
    """One row per Sunday-to-Saturday week touching the calendar, plus the unset member.

    `as_of` stands for today, so that a build can be repeated.
    """
    today = F.lit(as_of)
    start = F.col("start_of_week")
    weeks = (
        dim_date.filter(F.col("full_date").isNotNull())
        .select(tm.epi_week_start(F.col("full_date")).alias("start_of_week"))
        .distinct()
        .withColumn("end_of_week", F.date_add(start, 6))
        .withColumn("week_number", tm.epi_week_number(F.col("end_of_week")))
        .withColumn("epi_year", tm.epi_year(F.col("end_of_week")))
    )
    year, week, end = F.col("epi_year"), F.col("week_number"), F.col("end_of_week")
    members = weeks.select(
        surrogate_key(year, week).alias("epi_week_key"),
        "start_of_week",
        "end_of_week",
        "week_number",
        "epi_year",
        tm.week_label(year, week).alias("epi_week_label"),
        F.date_format(start, "EEEE").alias("start_week_day_name"),
        F.date_format(end, "EEEE").alias("end_week_day_name"),
        today.between(start, end).alias("current_epi_week_flag"),
        (F.year(today) == year).alias("current_epi_year_flag"),
    )
    unset = dim_date.sparkSession.range(1).select(
        F.lit(UNSET_TEXT).alias("epi_week_key"),
        F.lit(UNSET_DAY).alias("start_of_week"),
        F.lit(UNSET_DAY).alias("end_of_week"),
        F.lit(UNSET_NUMBER).alias("week_number"),
        F.lit(UNSET_NUMBER).alias("epi_year"),
        F.lit(UNSET_TEXT).alias("epi_week_label"),
        F.lit(UNSET_TEXT).alias("start_week_day_name"),
        F.lit(UNSET_TEXT).alias("end_week_day_name"),
        F.lit(False).alias("current_epi_week_flag"),
        F.lit(False).alias("current_epi_year_flag"),
    )
    return members.unionByName(unset).withColumn("load_date", today)
