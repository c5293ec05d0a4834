"""Conformed dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.functions.keys import surrogate_key, unknown_key
from vigil.functions.text import blank_to_null
from vigil.operators.calendar import SPINE_END, SPINE_START, date_attributes, date_spine, epi_weeks, spine_over
from vigil.operators.conform import canonical_spelling
from vigil.operators.dedup import representative_row

TEST_IDENTITY = ["test_code", "test_name", "component_code", "specimen_type", "unit"]


def dim_date(
    spark: SparkSession, start: date = SPINE_START, end: date = SPINE_END,
    include_end: bool = False, bounds: DataFrame | None = None,
) -> DataFrame:
    """Days from start to end, or those between first_day and last_day of `bounds`."""
    spine = date_spine(spark, start, end, include_end) if bounds is None else spine_over(bounds)
    return date_attributes(spine)


def dim_epiweek(dates: DataFrame, as_of: date) -> DataFrame:
    return epi_weeks(dates, as_of)


def dim_facilitylist(seed: DataFrame) -> DataFrame:
    code = F.col("Code").cast("string")
    return seed.filter(F.col("Code").isNotNull()).select(
        code.alias("facility_key"),
        code.alias("mfl_code"),
        F.trim("`Facility Name`").alias("facility_name"),
        F.trim("Province").alias("province"),
        F.trim("County").alias("county"),
        F.trim("`Sub County`").alias("subcounty"),
        F.trim("Ward").alias("ward"),
    )


def dim_laboratory(lab: DataFrame) -> DataFrame:
    code, name = F.col("laboratory_code"), F.col("laboratory_name")
    labs = lab.select(
        blank_to_null(F.col("testing_lab_code")).alias("laboratory_code"),
        blank_to_null(F.col("testing_lab_name")).alias("laboratory_name"),
    ).filter(code.isNotNull() | name.isNotNull())
    chosen = representative_row(
        labs,
        ["laboratory_code", "laboratory_name"],
        [code.asc_nulls_last(), name.asc_nulls_last()],
    )
    return chosen.select(surrogate_key(code, name).alias("laboratory_key"), code, name)


def dim_labtest(lab: DataFrame) -> DataFrame:
    tests = lab.select(
        blank_to_null(F.col("code")).alias("test_code"),
        blank_to_null(F.col("test_name")).alias("test_name"),
        blank_to_null(F.col("code_text")).alias("code_text"),
        blank_to_null(F.col("component_code")).alias("component_code"),
        blank_to_null(F.col("specimen_type")).alias("specimen_type"),
        blank_to_null(F.col("unit")).alias("unit"),
    ).filter(
        F.col("test_code").isNotNull()
        | F.col("test_name").isNotNull()
        | F.col("component_code").isNotNull()
    )
    # A described test wins over an undescribed one; the identity columns settle ties
    # between spellings so that the choice is the same on every run.
    order = [F.col(c).asc_nulls_last() for c in ["code_text", *TEST_IDENTITY]]
    chosen = representative_row(tests, TEST_IDENTITY, order)
    key = surrogate_key(*(F.col(c) for c in TEST_IDENTITY))
    return chosen.select(
        key.alias("labtest_key"), "test_code", "test_name", "code_text",
        "component_code", "specimen_type", "unit",
    )


def dim_location(travellers: DataFrame, border_cases: DataFrame) -> DataFrame:
    place = blank_to_null(F.col("point_of_entry")).alias("point_of_entry")
    places = (
        travellers.select(place)
        .unionByName(border_cases.select(place))
        .filter(F.col("point_of_entry").isNotNull())
        .distinct()
    )
    return places.select(
        surrogate_key(F.col("point_of_entry")).alias("point_of_entry_key"), "point_of_entry"
    )


def dim_point_of_entry(travellers: DataFrame) -> DataFrame:
    known = canonical_spelling(travellers, "point_of_entry").select(
        surrogate_key(F.col("point_of_entry_normalized")).alias("point_of_entry_key"),
        "point_of_entry",
        "point_of_entry_normalized",
        F.lit("ADAM").alias("source_system"),
        F.lit(True).alias("is_active"),
    )
    unknown = travellers.sparkSession.range(1).select(
        unknown_key().alias("point_of_entry_key"),
        F.lit("Unknown").alias("point_of_entry"),
        F.lit("unknown").alias("point_of_entry_normalized"),
        F.lit("SYSTEM").alias("source_system"),
        F.lit(True).alias("is_active"),
    )
    return known.unionByName(unknown)
