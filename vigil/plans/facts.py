"""Event-grain facts with dimension keys and additive measures.

The entities they read are clean already: text is trimmed and never blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigil.functions import rules
from vigil.functions.keys import record_id, surrogate_key, unknown_key
from vigil.functions.text import folded, yes_flag
from vigil.functions.temporal import local_date
from vigil.operators.conform import conformed_union
from vigil.operators.lookup import attributes, cascade, date_keys

AUDIT = {"ingested_at": "_ingested_at", "batch_id": "_batch_id", "source_file": "_source_file"}


def _is_type(value: str) -> Column:
    return folded(F.col("type")) == value


def _identity(system: str, *candidates: str) -> dict[str, Column]:
    return {
        "source_system": F.lit(system),
        "source_row_id": F.col("id"),
        "source_record_id": record_id(F.col("id"), *(F.col(c) for c in candidates)),
    }


def _person(prefix: str) -> dict[str, Column]:
    return {
        f"source_{prefix}_name": F.col("name"),
        f"source_{prefix}_identifier": F.col("identifier"),
        f"source_{prefix}_sex": F.col("sex"),
        f"source_{prefix}_date_of_birth": F.col("date_of_birth"),
        f"source_{prefix}_nationality": F.col("nationality"),
    }


def _classification() -> dict[str, Column]:
    return {
        "source_initial_classification": F.col("initial_classification"),
        "initial_classification": rules.initial_classification(F.col("initial_classification")),
        "source_final_classification": F.col("final_classification"),
        "final_classification": rules.final_classification(F.col("final_classification")),
    }


def _place() -> dict[str, Column]:
    return {c: F.col(c) for c in ("reporting_county", "reporting_subcounty", "health_facility")}


def _audit() -> dict[str, Column]:
    return {name: F.col(c) for name, c in AUDIT.items()}


def _select(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*(c.alias(name) for name, c in columns.items()))


def _keyed(df: DataFrame, key: str, parts: list[str], first: list[str]) -> DataFrame:
    """Add the surrogate key and put the key columns in front."""
    rest = [c for c in df.columns if c not in first]
    return df.select(
        surrogate_key(*(F.col(p) for p in parts)).alias(key), *first, *rest
    )


def _surveillance_events(cases: DataFrame, kind: str, person: str, event: str, count: str) -> DataFrame:
    """Case and contact records share one landing table and all their rules."""
    return _select(
        cases.filter(_is_type(kind)),
        {
            **_identity("ADAM", "id_field", "identifier"),
            **_person(person),
            f"{event}_date": F.coalesce(
                F.col("date_of_investigation"), F.to_date("created_timestamp")
            ),
            f"{event}_datetime": F.col("created_timestamp"),
            "disease": F.col("vhf_disease"),
            **_place(),
            **_classification(),
            "source_samples_collected": F.col("samples_collected"),
            "sample_collected_flag": yes_flag(F.col("samples_collected")),
            "specimen_identifier": F.col("specimen_id"),
            "source_final_laboratory_result": F.col("final_laboratory_results"),
            "checked_by": F.col("checked_by"),
            count: F.lit(1),
            "latitude": F.col("latitude"),
            "longitude": F.col("longitude"),
            **_audit(),
        },
    )


def case_investigations(
    cases: DataFrame, dim_date: DataFrame, other_sources: tuple[DataFrame, ...] = ()
) -> DataFrame:
    """`other_sources` must bring the same canonical columns."""
    events = conformed_union(
        [
            _surveillance_events(cases, "case", "person", "investigation", "investigation_count"),
            *other_sources,
        ]
    )
    roles = {
        "investigation_date_key": F.col("investigation_date"),
        "date_of_birth_key": F.col("source_person_date_of_birth"),
    }
    return _keyed(
        date_keys(events, dim_date, roles),
        "case_investigation_key", ["source_system", "source_record_id"], list(roles),
    )


def contact_registrations(
    cases: DataFrame, dim_date: DataFrame, other_sources: tuple[DataFrame, ...] = ()
) -> DataFrame:
    events = conformed_union(
        [
            _surveillance_events(
                cases, "contact", "contact", "registration", "contact_registration_count"
            ),
            *other_sources,
        ]
    )
    roles = {
        "registration_date_key": F.col("registration_date"),
        "contact_date_of_birth_key": F.col("source_contact_date_of_birth"),
    }
    return _keyed(
        date_keys(events, dim_date, roles),
        "contact_registration_key", ["source_system", "source_record_id"], list(roles),
    )


OUTCOME_COLUMNS = [
    "source_system", "source_row_id", "source_record_id", "source_person_name",
    "source_person_identifier", "source_person_sex", "source_person_date_of_birth",
    "source_person_nationality", "disease", "source_outcome", "treatment_outcome",
    "died_flag", "outcome_date", "date_of_death", "outcome_recorded_datetime",
    "outcome_validation_status", "source_initial_classification",
    "initial_classification", "source_final_classification", "final_classification",
    "source_final_laboratory_result", "final_laboratory_result", "specimen_identifier",
    "reporting_county", "reporting_subcounty", "health_facility", "checked_by",
    "treatment_outcome_count", "latitude", "longitude", "ingested_at", "batch_id",
    "source_file",
]


def treatment_outcomes(
    cases: DataFrame, dim_date: DataFrame, other_sources: tuple[DataFrame, ...] = ()
) -> DataFrame:
    """Cases with an outcome text or a death date; deaths count only once validated."""
    reported = cases.filter(
        _is_type("case") & (F.col("outcome").isNotNull() | F.col("date_of_death").isNotNull())
    )
    prepared = _select(
        reported,
        {
            **_identity("ADAM", "id_field", "identifier"),
            **_person("person"),
            "disease": F.col("vhf_disease"),
            "outcome_text": F.col("outcome"),
            "date_of_death": F.col("date_of_death"),
            "outcome_recorded_datetime": F.col("created_timestamp"),
            **_classification(),
            "source_final_laboratory_result": F.col("final_laboratory_results"),
            "final_laboratory_result": rules.case_result_category(
                F.col("final_laboratory_results")
            ),
            "specimen_identifier": F.col("specimen_id"),
            **_place(),
            "checked_by": F.col("checked_by"),
            "treatment_outcome_count": F.lit(1),
            "latitude": F.col("latitude"),
            "longitude": F.col("longitude"),
            **_audit(),
        },
    )
    death, final, lab = (
        F.col(c) for c in ("date_of_death", "final_classification", "final_laboratory_result")
    )
    judged = prepared.withColumns(
        {
            "source_outcome": rules.source_outcome(F.col("outcome_text"), lab),
            "died_flag": rules.validated_death(death, final, lab),
            "outcome_validation_status": rules.outcome_validation(death, final, lab),
        }
    ).withColumns(
        {
            "treatment_outcome": rules.treatment_outcome(
                F.col("died_flag"), F.col("source_outcome")
            ),
            "outcome_date": F.when(F.col("died_flag") == 1, death),
        }
    )
    events = conformed_union([judged.select(OUTCOME_COLUMNS), *other_sources])
    roles = {
        "outcome_date_key": F.col("outcome_date"),
        "outcome_recorded_date_key": F.to_date("outcome_recorded_datetime"),
        "date_of_birth_key": F.col("source_person_date_of_birth"),
    }
    return _keyed(
        date_keys(events, dim_date, roles),
        "treatment_outcome_key", ["source_system", "source_record_id"], list(roles),
    )


def screenings(
    travellers: DataFrame,
    dim_date: DataFrame,
    dim_point_of_entry: DataFrame,
    other_sources: tuple[DataFrame, ...] = (),
) -> DataFrame:
    """`travellers` already holds one row per person record."""
    word = folded(F.col("classification"))
    events = conformed_union(
        [
            _select(
                travellers,
                {
                    "source_system": F.lit("ADAM"),
                    "surveillance_pathway": F.lit("TRAVELLER"),
                    "source_row_id": F.col("id"),
                    "source_record_id": record_id(
                        F.col("id"), F.col("id_field"), F.col("identifier")
                    ),
                    "source_person_name": F.col("name"),
                    "source_person_identifier": F.col("identifier"),
                    "screening_date": local_date(F.col("created_timestamp")),
                    "screening_datetime": F.col("created_timestamp"),
                    "point_of_entry": F.col("point_of_entry"),
                    "source_classification": F.col("classification"),
                    "screening_outcome": rules.screening_outcome(F.col("classification")),
                    "screened": F.col("screened"),
                    "screening_count": F.lit(1),
                    "normal_flag": word.isNull().cast("int"),
                    "flagged_flag": F.when(word.isin("suspected", "probable"), 1).otherwise(0),
                    "suspected_flag": F.when(word == "suspected", 1).otherwise(0),
                    "probable_flag": F.when(word == "probable", 1).otherwise(0),
                    "latitude": F.col("latitude"),
                    "longitude": F.col("longitude"),
                    **_audit(),
                },
            ),
            *other_sources,
        ]
    )
    roles = {"screening_date_key": F.col("screening_date")}
    # A place really called "unknown" has a member of its own beside the default one;
    # looking it up among the named places keeps one row per screening.
    named_places = dim_point_of_entry.filter(F.col("source_system") != "SYSTEM")
    placed = attributes(
        date_keys(events, dim_date, roles),
        named_places,
        folded(F.col("point_of_entry")),
        {"point_of_entry_key": "point_of_entry_key"},
        "point_of_entry_normalized",
    ).withColumn("point_of_entry_key", F.coalesce("point_of_entry_key", unknown_key()))
    return _keyed(
        placed,
        "screening_key",
        ["source_system", "surveillance_pathway", "source_record_id"],
        ["screening_date_key", "point_of_entry_key"],
    )


LAB_FACT_COLUMNS = [
    "lab_test_key", "requesting_facility_key", "testing_laboratory_key",
    "collection_date_key", "result_date_key", "source_system", "source_row_id",
    "source_record_id", "subject_identifier", "identifier", "case_identifier",
    "order_identifier", "specimen_identifier", "specimen_type", "collection_date",
    "result_datetime", "requesting_facility_mfl", "testing_laboratory_code",
    "testing_laboratory_name", "test_code", "test_name", "test_code_text",
    "component_code", "source_result", "source_value_code", "result_value",
    "result_category", "result_unit", "reference_range_low", "reference_range_high",
    "test_count", "lab_test_matched_flag", "requesting_facility_matched_flag",
    "testing_laboratory_matched_flag", "ingested_at", "batch_id", "source_file",
]


def lab_events(lab: DataFrame) -> DataFrame:
    result = F.coalesce(F.col("conclusion"), F.col("value_code"))
    return _select(
        lab,
        {
            **_identity(
                "LIMS", "id_field", "identifier", "specimen_identifier", "order_identifier"
            ),
            **{
                c: F.col(c)
                for c in (
                    "subject_identifier", "identifier", "case_identifier",
                    "order_identifier", "specimen_identifier", "specimen_type",
                )
            },
            "collection_date": F.col("collect_date"),
            "result_datetime": F.col("effective_date_time"),
            "requesting_facility_mfl": F.col("performer_mfl"),
            "testing_laboratory_code": F.col("testing_lab_code"),
            "testing_laboratory_name": F.col("testing_lab_name"),
            "test_code": F.col("code"),
            "test_name": F.col("test_name"),
            "test_code_text": F.col("code_text"),
            "component_code": F.col("component_code"),
            "result_unit": F.col("unit"),
            "source_result": F.col("conclusion"),
            "source_value_code": F.col("value_code"),
            "result_value": result,
            "result_category": rules.lab_result_category(result),
            "reference_range_low": F.col("reference_range_low"),
            "reference_range_high": F.col("reference_range_high"),
            **_audit(),
        },
    )


def lab_results(
    lab: DataFrame,
    dim_date: DataFrame,
    dim_facility: DataFrame,
    dim_laboratory: DataFrame,
    dim_labtest: DataFrame,
    other_sources: tuple[DataFrame, ...] = (),
) -> DataFrame:
    df = conformed_union([lab_events(lab), *other_sources])
    df = cascade(
        df,
        dim_labtest,
        "labtest_key",
        [
            {"test_code": "test_code", "component_code": "component_code"},
            {"test_code": "test_code"},
            {"test_name": "test_name"},
            {"code_text": "test_code_text"},
        ],
        "lab_test_key",
    )
    df = cascade(
        df,
        dim_facility,
        "facility_key",
        [{"mfl_code": "requesting_facility_mfl"}],
        "requesting_facility_key",
    )
    df = cascade(
        df,
        dim_laboratory,
        "laboratory_key",
        [
            {"laboratory_code": "testing_laboratory_code"},
            {"laboratory_name": "testing_laboratory_name"},
        ],
        "testing_laboratory_key",
    )
    df = date_keys(
        df,
        dim_date,
        {
            "collection_date_key": F.col("collection_date"),
            "result_date_key": F.to_date("result_datetime"),
        },
    ).withColumns(
        {
            "test_count": F.lit(1),
            "lab_test_matched_flag": F.col("lab_test_key").isNotNull().cast("int"),
            "requesting_facility_matched_flag": F.col("requesting_facility_key")
            .isNotNull()
            .cast("int"),
            "testing_laboratory_matched_flag": F.col("testing_laboratory_key")
            .isNotNull()
            .cast("int"),
        }
    )
    return _keyed(
        df.select(LAB_FACT_COLUMNS), "lab_result_key", ["source_system", "source_record_id"], []
    )
