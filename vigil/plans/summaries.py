"""Weekly and daily summaries over the reports.

The guide these follow documents columns, not queries. Choices made here: totals are
brought to the trend's own grain (county, subcounty, facility, source, record type) before
running totals and averages; frames count rows and do not fill missing weeks; columns
today's facts do not carry (tests per case) are left out. The second screening system has no
fact, so its rows come from its cleaned entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigil.functions import temporal as tm, text as tx
from vigil.functions.keys import surrogate_key
from vigil.operators.conform import conformed_union, zero_filled_union
from vigil.operators.lookup import attributes
from vigil.operators.rollup import (
    change_from_previous, moving_average, totals, with_rates, year_to_date,
)

WEEK = ["epi_week_key", "epi_year", "epi_week", "epi_week_label", "start_of_week", "end_of_week"]
CASE_GROUP = ["county", "subcounty", "health_facility", "source_system", "record_type"]
CASE_TOTALS = {
    "total_cases": "n",
    "suspected_cases": "suspected",
    "probable_cases": "probable",
    "confirmed_cases": "confirmed",
    "samples_collected": "sampled",
    "recovered_cases": "recovered",
    "deaths": "deaths",
}
CASE_RATES = {
    "confirmation_rate": ("confirmed_cases", "total_cases"),
    "sample_collection_rate": ("samples_collected", "total_cases"),
    "recovery_rate": ("recovered_cases", "confirmed_cases"),
    "case_fatality_rate": ("deaths", "confirmed_cases"),
}


def _week(prefix: str = "reporting") -> list[Column]:
    named = {
        "epi_week_key": "epi_week_key",
        "epi_year": "epi_year",
        "epi_week": "epi_week",
        "epi_week_label": "epi_week_label",
        "epi_week_start_date": "start_of_week",
        "epi_week_end_date": "end_of_week",
    }
    return [F.col(f"{prefix}_{c}").alias(name) for c, name in named.items()]


def _is(column: str, value: str) -> Column:
    return F.when(F.col(column) == value, 1).otherwise(0)


def _screened() -> Column:
    """Records that say the person was screened; no answer does not count."""
    return F.when(F.col("screened"), F.col("total_screening_count")).otherwise(0)


def _case_rows(cases: DataFrame, outcomes: DataFrame, contacts: DataFrame) -> DataFrame:
    """Cases, contacts and outcomes as one stream of week-stamped counters.

    Outcomes come from their own report, so the domains are stacked, not joined. Days and
    weeks are those of the row, so that dates outside the calendar count as well.
    """
    investigated = cases.withColumn("reporting_date", F.col("investigation_date"))
    case = _with_epi_week(investigated).select(
        *WEEK, "reporting_date", "reporting_county", "reporting_subcounty",
        "health_facility", "source_system", F.lit("case").alias("record_type"),
        F.col("total_investigation_count").alias("n"),
        _is("reporting_case_classification", "SUSPECTED").alias("suspected"),
        _is("reporting_case_classification", "PROBABLE").alias("probable"),
        _is("reporting_case_classification", "CONFIRMED").alias("confirmed"),
        F.col("sample_collected_count").alias("sampled"),
        F.lit(0).alias("recovered"),
        F.lit(0).alias("deaths"),
    )
    registered = contacts.withColumn("reporting_date", F.col("registration_date"))
    contact = _with_epi_week(registered).select(
        *WEEK, "reporting_date", "reporting_county", "reporting_subcounty",
        "health_facility", "source_system", F.lit("contact").alias("record_type"),
        F.col("total_contact_registration_count").alias("n"),
        F.col("suspected_contact_count").alias("suspected"),
        F.col("probable_contact_count").alias("probable"),
        F.col("confirmed_contact_count").alias("confirmed"),
        F.col("sampled_contact_count").alias("sampled"),
        F.lit(0).alias("recovered"),
        F.lit(0).alias("deaths"),
    )
    outcome = _with_epi_week(outcomes).select(
        *WEEK, "reporting_date", "reporting_county", "reporting_subcounty",
        "health_facility", "source_system", F.lit("case").alias("record_type"),
        F.lit(0).alias("n"), F.lit(0).alias("suspected"), F.lit(0).alias("probable"),
        F.lit(0).alias("confirmed"), F.lit(0).alias("sampled"),
        F.col("recovered_count").alias("recovered"),
        F.col("deceased_count").alias("deaths"),
    )
    return conformed_union([case, contact, outcome]).withColumnsRenamed(
        {"reporting_county": "county", "reporting_subcounty": "subcounty"}
    )


def _with_epi_week(df: DataFrame, day: str = "reporting_date") -> DataFrame:
    """Sunday-to-Saturday week of a date, computed on the row."""
    start = tm.epi_week_start(F.col(day))
    end = F.date_add(start, 6)
    year, week = tm.epi_year(end), tm.epi_week_number(end)
    return df.drop(*WEEK).withColumns(
        {
            "epi_week_key": F.when(F.col(day).isNotNull(), surrogate_key(year, week)),
            "epi_year": year,
            "epi_week": week,
            "epi_week_label": F.when(F.col(day).isNotNull(), tm.week_label(year, week)),
            "start_of_week": start,
            "end_of_week": end,
        }
    )


def case_distribution(cases: DataFrame, contacts: DataFrame, outcomes: DataFrame) -> DataFrame:
    weekly = totals(_case_rows(cases, outcomes, contacts), WEEK + CASE_GROUP, CASE_TOTALS)
    return with_rates(
        weekly,
        {
            "suspected_case_rate": ("suspected_cases", "total_cases"),
            "probable_case_rate": ("probable_cases", "total_cases"),
            **CASE_RATES,
        },
    )


def case_trend(cases: DataFrame, contacts: DataFrame, outcomes: DataFrame) -> DataFrame:
    rows = _case_rows(cases, outcomes, contacts)
    # A trend needs a week; undated rows stay visible in the distribution.
    dated = rows.filter(F.col("start_of_week").isNotNull())
    weekly = totals(dated, WEEK + CASE_GROUP, CASE_TOTALS)
    trend = year_to_date(
        weekly, CASE_GROUP, "epi_year", "epi_week",
        {
            "cumulative_cases": "total_cases",
            "cumulative_confirmed_cases": "confirmed_cases",
            "cumulative_deaths": "deaths",
        },
    )
    order = ["start_of_week"]
    trend = moving_average(
        trend, CASE_GROUP, order, "total_cases", 4, "moving_average_4_week_cases"
    )
    trend = change_from_previous(
        trend, CASE_GROUP, order, "total_cases",
        ("previous_week_cases", "weekly_case_change", "weekly_case_change_percentage"),
    )
    return with_rates(trend, CASE_RATES)


PLACE = ["county", "subcounty", "ward", "point_of_entry", "mfl_code", "facility_name"]
SCREENING_TOTALS = {
    "total_screening_records": "n",
    "total_screened": "screened",
    "total_suspected": "suspected",
    "total_flagged": "flagged",
    "total_confirmed": "confirmed",
    "total_tested": "tested",
}
SCREENING_RATES = {
    "screening_completion_rate": ("total_screened", "total_screening_records"),
    "suspected_screening_rate": ("total_suspected", "total_screened"),
    "testing_rate": ("total_tested", "total_suspected"),
    "positivity_rate": ("total_confirmed", "total_tested"),
    "confirmed_screening_rate": ("total_confirmed", "total_screened"),
}


def _traveller_rows(screenings: DataFrame) -> DataFrame:
    """Screenings of the first system, which knows points of entry and no tests."""
    no_text, none = F.lit(None).cast("string"), F.lit(0)
    return screenings.select(
        F.col("reporting_date").alias("screening_date"),
        F.col("reporting_year").alias("screening_year"),
        F.col("reporting_month_number").alias("screening_month_number"),
        F.trim("reporting_month_name").alias("screening_month_name"),
        *_week(),
        *(no_text.alias(c) for c in PLACE if c != "point_of_entry"),
        F.col("reporting_point_of_entry").alias("point_of_entry"),
        "source_system",
        F.col("reporting_screening_category").alias("classification"),
        no_text.alias("test_result"),
        F.col("total_screening_count").alias("n"),
        _screened().alias("screened"),
        F.col("suspected_screening_count").alias("suspected"),
        F.col("flagged_screening_count").alias("flagged"),
        none.alias("confirmed"),
        none.alias("tested"),
    )


def border_screenings(border: DataFrame, dim_facility: DataFrame) -> DataFrame:
    """Screenings of the second system, with tests and their results, places and facilities.

    A record counts as screened if its answer is there and is no "no". It is classified by
    the gravest of what it says: confirmed, suspected, else normal.
    """
    named = attributes(
        border, dim_facility, F.col("facility_id"), {"facility_name": "facility_name"}, "facility_key"
    )
    dated = _with_epi_week(named.withColumn("screening_date", F.col("reporting_date")), "screening_date")
    day, answer = F.col("screening_date"), tx.blank_to_null(F.col("screening"))
    suspected, confirmed = tx.yes_flag(F.col("suspected")), tx.yes_flag(F.col("confirmed"))
    refused = F.coalesce(~tx.yes_no(answer), F.lit(False))
    return dated.select(
        day,
        F.year(day).alias("screening_year"),
        F.month(day).alias("screening_month_number"),
        F.date_format(day, "MMMM").alias("screening_month_name"),
        *WEEK,
        F.col("reporting_county").alias("county"),
        F.col("reporting_subcounty").alias("subcounty"),
        "ward",
        F.coalesce(tx.blank_to_null(F.col("point_of_entry")), F.lit("Unknown")).alias("point_of_entry"),
        F.col("facility_id").alias("mfl_code"),
        "facility_name",
        F.lit("UHAI").alias("source_system"),
        F.when(confirmed == 1, "CONFIRMED").when(suspected == 1, "SUSPECTED").otherwise("NORMAL").alias("classification"),
        F.col("result").alias("test_result"),
        F.lit(1).alias("n"),
        F.when(answer.isNotNull() & ~refused, 1).otherwise(0).alias("screened"),
        suspected.alias("suspected"),
        suspected.alias("flagged"),
        confirmed.alias("confirmed"),
        tx.yes_flag(F.col("tested")).alias("tested"),
    )


def screening_summary(screenings: DataFrame, border: DataFrame, dim_facility: DataFrame) -> DataFrame:
    """Daily screenings of both systems by place, facility and class, with testing rates."""
    by = [
        "screening_date", "screening_year", "screening_month_number", "screening_month_name", *WEEK, *PLACE,
        "source_system", "classification", "test_result",
    ]
    # Each system is summed by itself: its rows meet no others.
    daily = totals(_traveller_rows(screenings), by, SCREENING_TOTALS).unionByName(
        totals(border_screenings(border, dim_facility), by, SCREENING_TOTALS)
    )
    return with_rates(daily, SCREENING_RATES)


def laboratory_summary(labs: DataFrame, dim_facility: DataFrame) -> DataFrame:
    """Weekly and monthly totals; the result date counts, else the collection date.

    Groups are as many as rows nearly, so only what tells them apart is shuffled: of a week and a
    month their first days, from which the other columns are made again.
    """
    placed = attributes(
        labs, dim_facility, F.col("requesting_facility_key"),
        {"county": "county", "subcounty": "subcounty", "facility_name": "facility_name"},
        "facility_key",
    )
    day = F.coalesce("reporting_result_date", "reporting_collection_date")
    by = [
        tm.epi_week_start(day).alias("__week"), F.trunc(day, "month").alias("__month"), "county", "subcounty",
        F.col("reporting_requesting_facility_mfl").alias("mfl_code"),
        "facility_name", "source_system", "specimen_type",
        F.col("test_code").alias("loinc_code"), "test_name",
        F.col("test_code_text").alias("code_text"), "component_code",
        F.col("result_unit").alias("unit"), "result_category",
    ]
    summed = totals(
        placed,
        by,
        {
            "total_tests": "total_test_count",
            "positive_tests": "positive_test_count",
            "negative_tests": "negative_test_count",
            "inconclusive_tests": "inconclusive_test_count",
            "unknown_tests": "unknown_result_count",
            "other_tests": "other_result_count",
        },
    )
    month = F.col("__month")
    named = _with_epi_week(summed, "__week").select(
        *WEEK,
        F.year(month).alias("result_year"),
        F.month(month).alias("result_month_number"),
        F.date_format(month, "MMMM").alias("result_month_name"),
        *summed.drop("__week", "__month").columns,
    )
    return with_rates(
        named.withColumn("__decided", F.expr("positive_tests + negative_tests + inconclusive_tests")),
        {
            "positivity_rate": ("positive_tests", "__decided"),
            "negative_rate": ("negative_tests", "total_tests"),
            "inconclusive_rate": ("inconclusive_tests", "total_tests"),
            "unknown_result_rate": ("unknown_tests", "total_tests"),
            "result_completion_rate": ("__decided", "total_tests"),
        },
    ).drop("__decided")


GEO_MEASURES = [
    "total_cases", "confirmed_cases", "deaths", "total_screening_records",
    "total_screened", "suspected_screenings", "confirmed_screenings", "tested_screenings",
    "laboratory_tests", "positive_tests", "negative_tests", "inconclusive_tests",
]
GEO_GROUP = ["activity_date", "county", "subcounty", "point_of_entry", "facility"]


def geographic_summary(
    cases: DataFrame,
    contacts: DataFrame,
    outcomes: DataFrame,
    screenings: DataFrame,
    labs: DataFrame,
    dim_facility: DataFrame,
    border: DataFrame,
) -> DataFrame:
    """Three domains per day and place, stacked and zero-filled, then summed.

    Each domain is summed first, so that rows, not measures, meet in the union.
    """
    no_text = F.lit(None).cast("string")
    case = totals(
        _case_rows(cases, outcomes, contacts).filter(F.col("record_type") == "case"),
        [
            F.col("reporting_date").alias("activity_date"), "county", "subcounty",
            no_text.alias("point_of_entry"), F.col("health_facility").alias("facility"),
        ],
        {"total_cases": "n", "confirmed_cases": "confirmed", "deaths": "deaths"},
    )
    screening = totals(
        screenings,
        [
            F.col("reporting_date").alias("activity_date"), no_text.alias("county"),
            no_text.alias("subcounty"),
            F.col("reporting_point_of_entry").alias("point_of_entry"),
            no_text.alias("facility"),
        ],
        {
            "total_screening_records": "total_screening_count",
            "total_screened": _screened(),
            "suspected_screenings": "suspected_screening_count",
        },
    )
    at_borders = totals(
        border_screenings(border, dim_facility),
        [
            F.col("screening_date").alias("activity_date"), "county", "subcounty", "point_of_entry",
            F.col("facility_name").alias("facility"),
        ],
        {
            "total_screening_records": "n",
            "total_screened": "screened",
            "suspected_screenings": "suspected",
            "confirmed_screenings": "confirmed",
            "tested_screenings": "tested",
        },
    )
    placed = attributes(
        labs, dim_facility, F.col("requesting_facility_key"),
        {"county": "county", "subcounty": "subcounty", "facility": "facility_name"},
        "facility_key",
    ).withColumn(
        "activity_date", F.coalesce("reporting_result_date", "reporting_collection_date")
    )
    lab = totals(
        placed,
        ["activity_date", "county", "subcounty", no_text.alias("point_of_entry"), "facility"],
        {
            "laboratory_tests": "total_test_count",
            "positive_tests": "positive_test_count",
            "negative_tests": "negative_test_count",
            "inconclusive_tests": "inconclusive_test_count",
        },
    )
    stacked = zero_filled_union([case, screening, at_borders, lab], GEO_MEASURES)
    summed = totals(stacked, GEO_GROUP, {m: m for m in GEO_MEASURES})
    day = F.col("activity_date")
    return with_rates(
        _with_epi_week(summed, "activity_date").withColumns(
            {
                "activity_year": F.year(day),
                "activity_month_number": F.month(day),
                "activity_month_name": F.date_format(day, "MMMM"),
                "__decided": F.expr("positive_tests + negative_tests + inconclusive_tests"),
            }
        ),
        {
            "confirmation_rate": ("confirmed_cases", "total_cases"),
            "case_fatality_rate": ("deaths", "confirmed_cases"),
            "suspected_screening_rate": ("suspected_screenings", "total_screened"),
            "screening_testing_rate": ("tested_screenings", "suspected_screenings"),
            "screening_positivity_rate": ("confirmed_screenings", "tested_screenings"),
            "laboratory_positivity_rate": ("positive_tests", "__decided"),
        },
    ).drop("__decided")
