"""Row-grain reports: fact columns, resolved attributes and summable measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigil.functions import rules, temporal as tm
from vigil.functions.measures import count_when, counts_by_value
from vigil.functions.text import blank_to_null
from vigil.operators.lookup import attributes, enclosing_week

# Report column suffix: calendar column.
DATE_PARTS = {
    "date": "full_date",
    "year": "year",
    "quarter": "quarter",
    "month_number": "month",
    "month_name": "month_name",
}
WEEK_PARTS = {
    "epi_week_key": "epi_week_key",
    "epi_year": "epi_year",
    "epi_week": "week_number",
    "epi_week_label": "epi_week_label",
    "epi_week_start_date": "start_of_week",
    "epi_week_end_date": "end_of_week",
}
WEEK_DAY_PARTS = {
    "epi_week_start_day_name": "start_week_day_name",
    "epi_week_end_day_name": "end_week_day_name",
}
CURRENT_PARTS = {
    "current_epi_week_flag": "current_epi_week_flag",
    "current_epi_year_flag": "current_epi_year_flag",
}


def _prefixed(prefix: str, *groups: dict[str, str]) -> dict[str, str]:
    return {f"{prefix}_{name}": c for group in groups for name, c in group.items()}


def _dated(df: DataFrame, dim_date: DataFrame, key: str, prefix: str) -> DataFrame:
    return attributes(df, dim_date, F.col(key), _prefixed(prefix, DATE_PARTS), "date_key")


def case_investigation(fact: DataFrame, dim_date: DataFrame, dim_epiweek: DataFrame) -> DataFrame:
    df = enclosing_week(
        _dated(fact, dim_date, "investigation_date_key", "reporting"),
        dim_epiweek, F.col("reporting_date"),
        _prefixed("reporting", WEEK_PARTS, WEEK_DAY_PARTS, CURRENT_PARTS),
    )
    df = attributes(
        df, dim_date, F.col("date_of_birth_key"),
        {
            "reporting_date_of_birth": "full_date",
            "reporting_birth_year": "year",
            "reporting_birth_month_number": "month",
            "reporting_birth_month_name": "month_name",
        },
        "date_key",
    )
    event, birth = F.col("investigation_date"), F.col("source_person_date_of_birth")
    initial, final = F.col("initial_classification"), F.col("final_classification")
    n = F.col("investigation_count")
    sampled = F.coalesce(F.col("sample_collected_flag"), F.lit(0))
    open_classes = final.isin("SUSPECTED", "PROBABLE", "UNKNOWN") | final.isNull()
    return df.select(
        "*",
        tm.case_age(event, birth).alias("age_at_investigation"),
        tm.case_age_group(event, birth).alias("reporting_age_group"),
        rules.reporting_classification(final, initial).alias("reporting_case_classification"),
        rules.investigation_status(final).alias("investigation_status"),
        F.coalesce(n, F.lit(1)).cast("int").alias("total_investigation_count"),
        *_classification_counts("initial", initial, n),
        *_classification_counts("final", final, n),
        count_when(final.isin("CONFIRMED", "DISCARDED"), n).alias("concluded_investigation_count"),
        count_when(open_classes, n).alias("open_investigation_count"),
        count_when(sampled == 1, n).alias("sample_collected_count"),
        count_when(sampled == 0, n).alias("sample_not_collected_count"),
    )


def _classification_counts(prefix: str, value: Column, n: Column) -> list[Column]:
    named = ("SUSPECTED", "PROBABLE", "CONFIRMED", "DISCARDED")
    return [
        *counts_by_value(value, {v: f"{prefix}_{v.lower()}_count" for v in named}, n),
        count_when((value == "UNKNOWN") | value.isNull(), n).alias(f"{prefix}_unknown_count"),
    ]


def screening(
    fact: DataFrame, dim_date: DataFrame, dim_epiweek: DataFrame, dim_point_of_entry: DataFrame
) -> DataFrame:
    df = enclosing_week(
        _dated(fact, dim_date, "screening_date_key", "reporting"),
        dim_epiweek, F.col("reporting_date"),
        _prefixed("reporting", WEEK_PARTS, WEEK_DAY_PARTS, CURRENT_PARTS),
    )
    df = attributes(
        df, dim_point_of_entry, F.col("point_of_entry_key"),
        {"reporting_point_of_entry": "point_of_entry"}, "point_of_entry_key",
    ).withColumn(
        "reporting_point_of_entry",
        F.coalesce("reporting_point_of_entry", "point_of_entry", F.lit("Unknown")),
    )
    n = F.col("screening_count")
    flag = {
        f: F.coalesce(F.col(f"{f}_flag"), F.lit(0))
        for f in ("normal", "flagged", "suspected", "probable")
    }
    none_set = (
        (flag["normal"] == 0) & (flag["flagged"] == 0)
        & (flag["suspected"] == 0) & (flag["probable"] == 0)
    )
    return df.select(
        "*",
        rules.screening_category(
            flag["suspected"], flag["probable"], flag["normal"], flag["flagged"],
            F.col("screening_outcome"),
        ).alias("reporting_screening_category"),
        F.coalesce(n, F.lit(1)).cast("int").alias("total_screening_count"),
        *(count_when(c == 1, n).alias(f"{f}_screening_count") for f, c in flag.items()),
        count_when(none_set, n).alias("unknown_screening_count"),
    )


def lab_result(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_epiweek: DataFrame,
    dim_facility: DataFrame,
    dim_laboratory: DataFrame,
) -> DataFrame:
    df = enclosing_week(
        _dated(fact, dim_date, "collection_date_key", "reporting_collection"),
        dim_epiweek, F.col("reporting_collection_date"),
        _prefixed("reporting_collection", WEEK_PARTS),
    )
    df = enclosing_week(
        _dated(df, dim_date, "result_date_key", "reporting_result"),
        dim_epiweek, F.col("reporting_result_date"),
        {**_prefixed("reporting_result", WEEK_PARTS), **_prefixed("reporting", CURRENT_PARTS)},
    )
    df = attributes(
        df, dim_facility, F.col("requesting_facility_key"),
        {"reporting_requesting_facility_mfl": "mfl_code"}, "facility_key",
    )
    df = attributes(
        df, dim_laboratory, F.col("testing_laboratory_key"),
        {
            "reporting_testing_laboratory_code": "laboratory_code",
            "reporting_testing_laboratory_name": "laboratory_name",
        },
        "laboratory_key",
    )
    collected, resulted = F.col("collection_date"), F.col("result_datetime")
    category, n = F.col("result_category"), F.col("test_count")
    unknown = (category == "UNKNOWN") | category.isNull()
    return df.select(
        "*",
        tm.turnaround_days(collected, resulted).alias("turnaround_time_days"),
        tm.turnaround_hours(collected, resulted).alias("turnaround_time_hours"),
        tm.turnaround_band(collected, resulted).alias("turnaround_time_band"),
        F.coalesce(n, F.lit(1)).cast("int").alias("total_test_count"),
        *counts_by_value(
            category,
            {
                "POSITIVE": "positive_test_count",
                "NEGATIVE": "negative_test_count",
                "INCONCLUSIVE": "inconclusive_test_count",
                "OTHER": "other_result_count",
            },
            n,
        ),
        count_when(unknown, n).alias("unknown_result_count"),
        count_when(category.isin("POSITIVE", "NEGATIVE", "INCONCLUSIVE", "OTHER"), n).alias(
            "result_available_count"
        ),
        count_when(unknown, n).alias("result_not_available_count"),
        count_when(blank_to_null(F.col("specimen_identifier")).isNotNull(), n).alias(
            "specimen_identified_count"
        ),
        count_when(blank_to_null(F.col("case_identifier")).isNotNull(), n).alias(
            "case_linked_test_count"
        ),
        count_when(F.col("requesting_facility_key").isNotNull(), n).alias(
            "requesting_facility_matched_count"
        ),
        count_when(F.col("testing_laboratory_key").isNotNull(), n).alias(
            "testing_laboratory_matched_count"
        ),
    )


CONTACT_COLUMNS = [
    "contact_registration_key", "registration_date_key", "contact_date_of_birth_key",
    "source_system", "source_row_id", "source_record_id", "source_contact_name",
    "source_contact_identifier", "source_contact_sex", "source_contact_date_of_birth",
    "source_contact_nationality", "age_at_registration", "reporting_age_group",
    "registration_date", "registration_datetime", "reporting_year", "reporting_quarter",
    "reporting_month", "reporting_month_name", "reporting_year_month",
    "reporting_epi_year", "reporting_epi_week", "reporting_epi_week_label", "disease",
    "reporting_county", "reporting_subcounty", "health_facility", "latitude",
    "longitude", "source_initial_classification", "initial_classification",
    "source_final_classification", "final_classification", "specimen_identifier",
    "sample_collected_flag", "source_samples_collected",
    "source_final_laboratory_result", "checked_by",
]
AUDIT_COLUMNS = ["ingested_at", "batch_id", "source_file"]


def contact_registration(fact: DataFrame) -> DataFrame:
    event = F.col("registration_date")
    age = tm.full_years(event, F.col("source_contact_date_of_birth"))
    df = fact.withColumns({"age_at_registration": age, **tm.calendar_parts(event)})
    df = df.withColumn("reporting_age_group", tm.person_age_group(F.col("age_at_registration")))
    n = F.col("contact_registration_count")
    sampled = F.col("sample_collected_flag")
    return df.select(
        *CONTACT_COLUMNS,
        n.alias("total_contact_registration_count"),
        *counts_by_value(
            F.col("initial_classification"),
            {
                "SUSPECTED": "suspected_contact_count",
                "PROBABLE": "probable_contact_count",
                "CONFIRMED": "confirmed_contact_count",
                "DISCARDED": "discarded_contact_count",
                "UNKNOWN": "unknown_classification_count",
            },
            n,
        ),
        count_when(sampled == 1, n).alias("sampled_contact_count"),
        count_when(sampled == 0, n).alias("not_sampled_contact_count"),
        *_present_counts(
            {
                "specimen_identifier": "specimen_identifier_available_count",
                "source_contact_identifier": "contact_identifier_available_count",
                "disease": "disease_available_count",
                "registration_date": "registration_date_available_count",
            },
            n,
        ),
        *AUDIT_COLUMNS,
    )


def _present_counts(columns: dict[str, str], n: Column) -> list[Column]:
    return [count_when(F.col(c).isNotNull(), n).alias(name) for c, name in columns.items()]


OUTCOME_COLUMNS = [
    "treatment_outcome_key", "outcome_date_key", "outcome_recorded_date_key",
    "date_of_birth_key", "source_system", "source_row_id", "source_record_id",
    "source_person_name", "source_person_identifier", "source_person_sex",
    "source_person_date_of_birth", "source_person_nationality", "age_at_outcome",
    "reporting_age_group", "disease", "reporting_date", "reporting_year",
    "reporting_quarter", "reporting_month", "reporting_month_name",
    "reporting_year_month", "reporting_epi_year", "reporting_epi_week",
    "reporting_epi_week_label", "outcome_date", "date_of_death",
    "outcome_recorded_datetime", "source_initial_classification",
    "initial_classification", "source_final_classification", "final_classification",
    "source_final_laboratory_result", "final_laboratory_result", "source_outcome",
    "treatment_outcome", "died_flag", "outcome_validation_status",
    "specimen_identifier", "reporting_county", "reporting_subcounty",
    "health_facility", "latitude", "longitude", "checked_by",
]


def treatment_outcome(fact: DataFrame) -> DataFrame:
    reported = F.coalesce(F.col("outcome_date"), F.to_date("outcome_recorded_datetime"))
    df = fact.withColumn("reporting_date", reported)
    event = F.col("reporting_date")
    age = tm.full_years(event, F.col("source_person_date_of_birth"))
    df = df.withColumns({"age_at_outcome": age, **tm.calendar_parts(event)})
    df = df.withColumn("reporting_age_group", tm.person_age_group(F.col("age_at_outcome")))
    n = F.col("treatment_outcome_count")
    status = F.col("outcome_validation_status")
    return df.select(
        *OUTCOME_COLUMNS,
        n.alias("total_treatment_outcome_count"),
        *counts_by_value(
            F.col("treatment_outcome"),
            {
                "ALIVE": "alive_count",
                "RECOVERED": "recovered_count",
                "DECEASED": "deceased_count",
                "ON_TREATMENT": "on_treatment_count",
                "TRANSFERRED": "transferred_count",
                "LOST_TO_FOLLOW_UP": "lost_to_follow_up_count",
                "UNKNOWN": "unknown_outcome_count",
            },
            n,
        ),
        *counts_by_value(
            F.col("final_classification"),
            {
                "CONFIRMED": "confirmed_case_outcome_count",
                "PROBABLE": "probable_case_outcome_count",
                "SUSPECTED": "suspected_case_outcome_count",
                "DISCARDED": "discarded_case_outcome_count",
            },
            n,
        ),
        *counts_by_value(
            F.col("final_laboratory_result"),
            {
                "POSITIVE": "positive_lab_outcome_count",
                "NEGATIVE": "negative_lab_outcome_count",
            },
            n,
        ),
        count_when(status.isNull(), n).alias("valid_outcome_count"),
        count_when(status.isNotNull(), n).alias("outcome_validation_issue_count"),
        *counts_by_value(
            status,
            {
                "DEATH_DATE_WITHOUT_CONFIRMED_CLASSIFICATION":
                    "death_without_confirmed_classification_count",
                "DEATH_DATE_WITH_NEGATIVE_LAB_RESULT": "death_with_negative_lab_result_count",
                "DEATH_DATE_WITHOUT_POSITIVE_LAB_RESULT":
                    "death_without_positive_lab_result_count",
            },
            n,
        ),
        count_when(F.col("treatment_outcome") != "UNKNOWN", n).alias("known_outcome_count"),
        *_present_counts(
            {"reporting_date": "outcome_date_available_count", "disease": "disease_available_count"},
            n,
        ),
        *AUDIT_COLUMNS,
    )
