"""Typed, latest-record entities from the landing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigil.functions import numeric as num, temporal as tm, text as tx
from vigil.operators.dedup import latest_per_key
from vigil.operators.profile import timestamp_profile

ENVELOPE = ["id", "_ingested_at", "_source", "_batch_id", "_source_file", "_processed"]

CASE_TEXT = [
    "id_field", "name", "nationality", "identifier", "type", "initial_classification",
    "outcome", "samples_collected", "specimen_id", "final_laboratory_results",
    "reporting_county", "reporting_subcounty", "health_facility", "vhf_disease",
    "final_classification", "checked_by",
]
CASE_COLUMNS = ENVELOPE + [
    "id_field", "name", "sex", "date_of_birth", "nationality", "identifier", "type",
    "initial_classification", "outcome", "samples_collected", "specimen_id",
    "final_laboratory_results", "reporting_county", "reporting_subcounty",
    "health_facility", "date_of_investigation", "created_timestamp", "latitude",
    "longitude", "vhf_disease", "date_of_death", "final_classification", "checked_by",
]
TRAVELLER_TEXT = [
    "id_field", "name", "sex", "nationality", "identifier", "classification",
    "point_of_entry",
]
TRAVELLER_COLUMNS = ENVELOPE + [
    "id_field", "name", "sex", "date_of_birth", "nationality", "identifier",
    "classification", "screened", "point_of_entry", "created_timestamp", "latitude",
    "longitude",
]
LAB_TEXT = [
    "subject_identifier", "identifier", "order_identifier", "specimen_identifier",
    "specimen_type", "performer_mfl", "code", "test_name", "code_text",
    "component_code", "unit", "conclusion", "value_code", "dlt_load_id", "dlt_id",
    "case_identifier", "id_field", "testing_lab_code", "testing_lab_name",
]
LAB_COLUMNS = [
    "id", "_ingested_at", "_source", "_batch_id", "_source_file", "_raw_hash",
    "_processed", "subject_identifier", "identifier", "order_identifier",
    "specimen_identifier", "specimen_type", "collect_date", "performer_mfl",
    "effective_date_time", "code", "test_name", "code_text", "component_code", "unit",
    "conclusion", "value_code", "reference_range_low", "reference_range_high",
    "dlt_load_id", "dlt_id", "case_identifier", "id_field", "testing_lab_code",
    "testing_lab_name",
]


def _landed(raw: DataFrame, columns: list[str]) -> DataFrame:
    """The wanted landing columns; one that no file has brought yet reads as null text."""
    have = set(raw.columns)
    return raw.select(
        *(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns)
    )


def _envelope(trimmed: list[str]) -> dict[str, Column]:
    cleaned = {c: tx.blank_to_null(F.col(c)) for c in trimmed}
    return {**cleaned, "_processed": F.coalesce(F.col("_processed"), F.lit(False))}


def _text(names: list[str]) -> dict[str, Column]:
    # A JSON boolean may have landed typed; cleaning works on text.
    return {c: tx.blank_to_null(F.col(c).cast("string")) for c in names}


def _row_key() -> Column:
    return F.concat(F.lit("__bronze_id_"), F.col("id").cast("string"))


def cases(raw: DataFrame) -> DataFrame:
    cleaned = _landed(raw, CASE_COLUMNS).withColumns(
        {
            **_envelope(["_source", "_source_file"]),
            **_text(CASE_TEXT),
            "sex": tx.normalise_sex(F.col("sex")),
            "date_of_birth": tm.safe_date(F.col("date_of_birth")),
            "date_of_investigation": tm.safe_date(F.col("date_of_investigation")),
            "created_timestamp": tm.safe_timestamp(F.col("created_timestamp")),
            "latitude": num.latitude(F.col("latitude")),
            "longitude": num.longitude(F.col("longitude")),
            "date_of_death": tm.safe_date(F.col("date_of_death")),
        }
    )
    key = F.coalesce(F.col("id_field"), _row_key())
    return latest_per_key(cleaned, key, "_ingested_at", "id")


def traveller_key() -> Column:
    return F.coalesce(
        tx.blank_to_null(F.col("id_field")),
        tx.blank_to_null(F.col("identifier")),
        F.col("id").cast("string"),
    )


def travellers(raw: DataFrame) -> DataFrame:
    cleaned = _landed(raw, TRAVELLER_COLUMNS).withColumns(
        {
            **_envelope(["_source", "_source_file"]),
            **_text(TRAVELLER_TEXT),
            "date_of_birth": tm.safe_date(F.col("date_of_birth")),
            "screened": tx.yes_no(F.col("screened").cast("string")),
            "created_timestamp": tm.instant(F.col("created_timestamp")),
            "latitude": num.latitude(F.col("latitude")),
            "longitude": num.longitude(F.col("longitude")),
        }
    )
    return latest_per_key(cleaned, traveller_key(), "_ingested_at", "id")


def lab_results(raw: DataFrame) -> DataFrame:
    cleaned = _landed(raw, LAB_COLUMNS).withColumns(
        {
            **_envelope(["_source", "_source_file", "_raw_hash"]),
            **_text(LAB_TEXT),
            "collect_date": tm.safe_date(F.col("collect_date")),
            "effective_date_time": tm.safe_timestamp(
                F.col("effective_date_time"), day_first=False
            ),
            "reference_range_low": num.safe_decimal(F.col("reference_range_low")),
            "reference_range_high": num.safe_decimal(F.col("reference_range_high")),
        }
    )
    key = F.coalesce(
        "identifier", "specimen_identifier", "order_identifier", "id_field", _row_key()
    )
    return latest_per_key(cleaned, key, "_ingested_at", "id")


# Output column of the second traveller system: landing column.
BORDER_TEXT = {
    "system_id": "system_id",
    "names": "names",
    "sex": "sex",
    "date_of_birth": "date_of_birth",
    "nationality": "nationality",
    "identifier_type": "identifier_type",
    "identifier_number": "identifier",
    "suspected": "suspected",
    "screening": "screening",
    "confirmed": "confirmed",
    "died": "died",
    "recovered": "recovered",
    "tested": "tested",
    "result": "result",
    "point_of_entry": "point_of_entry",
    "reporting_county": "reporting_county",
    "reporting_subcounty": "reporting_sub_county",
    "ward": "ward",
    "facility_id": "facility_fid",
    "community_health_unit": "community_health_unit_chu",
    "reporting_date": "reporting_date",
    "reporting_time": "reporting_time",
    "created_at": "created_at",
}


def border_cases(raw: DataFrame) -> DataFrame:
    """Every landed row is kept: this system sends no updates to deduplicate."""
    landed = _landed(raw, [*BORDER_TEXT.values(), "dlt_load_id", "dlt_id"])
    text = {o: tx.empty_to_null(F.col(c).cast("string")) for o, c in BORDER_TEXT.items()}
    typed = {
        **text,
        "sex": F.upper(text["sex"]),
        "date_of_birth": text["date_of_birth"].try_cast("date"),
        "reporting_date": text["reporting_date"].try_cast("date"),
        "created_at": text["created_at"].try_cast("timestamp_ntz"),
    }
    return landed.select(
        *(c.alias(name) for name, c in typed.items()), "dlt_load_id", "dlt_id"
    )


def traveller_timestamp_profile(raw: DataFrame) -> DataFrame:
    return timestamp_profile(
        raw, "created_timestamp", ["id", "_ingested_at", "id_field", "identifier"]
    )
