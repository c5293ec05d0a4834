"""The models once more as plain SQL for DuckDB, to check the Spark results against.

Written independently of the Spark code: different parsing functions, range joins instead
of computed keys, correlated lookups instead of joins where that is clearer.
"""

from __future__ import annotations

import re

from table_feeds import FEEDS, duckdb_feed


def cl(c: str) -> str:
    return f"nullif(trim({c}, ' '), '')"


def day(c: str) -> str:
    t = f"trim({c}, ' ')"
    return f"""CASE WHEN regexp_full_match({t}, '\\d\\d\\d\\d-\\d\\d-\\d\\d') AND {t}[1:4] <> '0000'
        THEN CAST(try_strptime({t}, '%Y-%m-%d') AS DATE)
        WHEN regexp_full_match({t}, '\\d\\d/\\d\\d/\\d\\d\\d\\d') AND {t}[7:10] <> '0000'
        THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE) END"""


def moment(c: str, day_first: bool) -> str:
    t = f"trim({c}, ' ')"
    dmy = f"WHEN {t} LIKE '__/__/____' THEN CAST({day(c)} AS TIMESTAMP)" if day_first else ""
    return f"""CASE WHEN regexp_full_match({t}, '\\d\\d\\d\\d-\\d\\d-\\d\\d') THEN CAST({day(c)} AS TIMESTAMP)
        WHEN regexp_full_match({t}, '\\d\\d\\d\\d-\\d\\d-\\d\\d[ T]\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?')
        THEN try_cast(replace({t}, 'T', ' ') AS TIMESTAMP) {dmy} END"""


def number(c: str, kind: str) -> str:
    t = f"trim({c}, ' ')"
    return f"CASE WHEN regexp_full_match({t}, '-?\\d+(\\.\\d+)?') THEN try_cast({t} AS {kind}) END"


def within(c: str, limit: int) -> str:
    n = number(c, "DOUBLE")
    return f"CASE WHEN ({n}) BETWEEN -{limit} AND {limit} THEN {n} END"


def key(*parts: str) -> str:
    texts = ", ".join(
        f"coalesce(CAST({p} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for p in parts
    )
    return f"md5(concat_ws('-', {texts}))"


def newest(table: str, part: str) -> str:
    return f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {part}
        ORDER BY _ingested_at DESC NULLS LAST, id DESC) AS rn FROM {table}) WHERE rn = 1"""


def cleaned(names: str) -> str:
    return ", ".join(f"{cl(n)} AS {n}" for n in names.split())


ENV = f"""id, _ingested_at, {cl('_source')} AS _source, _batch_id, {cl('_source_file')} AS _source_file,
    coalesce(_processed, false) AS _processed"""


def title(c: str) -> str:
    return f"""array_to_string(list_transform(regexp_extract_all(lower({c}), '[a-z0-9]+|[^a-z0-9]+'),
        lambda w: upper(w[1]) || w[2:]), '')"""


def classify(c: str, extra: str = "") -> str:
    t = f"lower(trim({c}, ' '))"
    return f"""CASE coalesce({t}, '') WHEN '' THEN 'UNKNOWN' WHEN 'suspected' THEN 'SUSPECTED'
        WHEN 'probable' THEN 'PROBABLE' WHEN 'confirmed' THEN 'CONFIRMED'
        ELSE CASE WHEN {t} IN ('discarded', 'not a case', 'no case'{extra}) THEN 'DISCARDED' ELSE upper({t}) END END"""


def classes() -> str:
    return f"""{cl('initial_classification')} AS source_initial_classification,
        {classify('initial_classification')} AS initial_classification,
        {cl('final_classification')} AS source_final_classification,
        {classify('final_classification', ", 'negative'")} AS final_classification"""


AUDIT = "_ingested_at AS ingested_at, _batch_id AS batch_id, _source_file AS source_file"


def date_key(d: str) -> str:
    return f"coalesce((SELECT date_key FROM dim_date WHERE full_date = {d}), -1)"


def person(who: str) -> str:
    return f"""name AS source_{who}_name, identifier AS source_{who}_identifier, sex AS source_{who}_sex,
        date_of_birth AS source_{who}_date_of_birth, nationality AS source_{who}_nationality"""


RECORD_ID = "coalesce(id_field, identifier, CAST(id AS VARCHAR))"


def surveillance(kind: str, who: str, event: str, count: str, fact_key: str, birth_key: str) -> str:
    return f"""SELECT {key("source_system", "source_record_id")} AS {fact_key},
            {date_key(event + '_date')} AS {event}_date_key,
            {date_key('source_' + who + '_date_of_birth')} AS {birth_key}, *
        FROM (SELECT 'ADAM' AS source_system, id AS source_row_id, {RECORD_ID} AS source_record_id,
            {person(who)}, coalesce(date_of_investigation, CAST(created_timestamp AS DATE)) AS {event}_date,
            created_timestamp AS {event}_datetime, vhf_disease AS disease, reporting_county,
            reporting_subcounty, health_facility, {classes()},
            samples_collected AS source_samples_collected,
            CASE WHEN lower(samples_collected) IN ('yes', 'y', 'true', '1') THEN 1 ELSE 0 END AS sample_collected_flag,
            specimen_id AS specimen_identifier, final_laboratory_results AS source_final_laboratory_result,
            checked_by, 1 AS {count}, latitude, longitude, {AUDIT}
        FROM slv_adam_cases WHERE lower(type) = '{kind}')"""


def lab_result_of(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN 'UNKNOWN'
        WHEN lower({c}) IN ('positive', 'detected', 'reactive', 'positive/detected', 'positive / detected') THEN 'POSITIVE'
        WHEN lower({c}) IN ('negative', 'not detected', 'not_detected', 'non-reactive', 'non reactive', 'nonreactive',
            'negative/not detected', 'negative / not detected') THEN 'NEGATIVE'
        WHEN lower({c}) IN ('inconclusive', 'indeterminate', 'invalid') THEN 'INCONCLUSIVE' ELSE 'OTHER' END"""


def outcome_of(c: str, lab: str) -> str:
    w = f"lower({c})"
    return f"""CASE
        WHEN regexp_full_match({w}, 'dead|death|died|deceased( ?/ ?dead)?') THEN CASE WHEN {lab} = 'NEGATIVE' THEN 'ALIVE' END
        WHEN {w} IN ('alive', 'living') THEN 'ALIVE'
        WHEN {w} IN ('recovered', 'recovery', 'discharged', 'alive and discharged') THEN 'RECOVERED'
        WHEN {w} IN ('admitted', 'on treatment', 'under treatment', 'ongoing', 'hospitalized', 'hospitalised') THEN 'ON_TREATMENT'
        WHEN {w} IN ('transferred', 'referred', 'transfer out', 'transferred out') THEN 'TRANSFERRED'
        WHEN {w} IN ('lost to follow up', 'lost to follow-up', 'lost', 'ltfu') THEN 'LOST_TO_FOLLOW_UP'
        ELSE upper({c}) END"""


def lookup(dim: str, result: str, where: str) -> str:
    return f"(SELECT min({result}) FROM {dim} d WHERE {where})"


def years(a: str, b: str) -> str:
    return f"CAST(date_part('year', age({a}, {b})) AS INTEGER)"


def tally(column: str, names: dict[str, str]) -> str:
    return ", ".join(
        f"CAST(coalesce({column}, 'UNKNOWN') = '{v}' AS INTEGER) AS {n}" for v, n in names.items()
    )


def flags(conditions: dict[str, str]) -> str:
    return ", ".join(
        f"CASE WHEN {c} THEN 1 ELSE 0 END AS {n}" for n, c in conditions.items()
    )


def week_cols(alias: str, prefix: str, more: bool) -> str:
    out = f"""{alias}.epi_week_key AS {prefix}_epi_week_key, {alias}.epi_year AS {prefix}_epi_year,
        {alias}.week_number AS {prefix}_epi_week, {alias}.epi_week_label AS {prefix}_epi_week_label,
        {alias}.start_of_week AS {prefix}_epi_week_start_date, {alias}.end_of_week AS {prefix}_epi_week_end_date"""
    if more:
        out += f""", {alias}.start_week_day_name AS {prefix}_epi_week_start_day_name,
            {alias}.end_week_day_name AS {prefix}_epi_week_end_day_name"""
    return out


def date_cols(alias: str, prefix: str) -> str:
    return f"""{alias}.full_date AS {prefix}_date, {alias}.year AS {prefix}_year, {alias}.quarter AS {prefix}_quarter,
        {alias}.month AS {prefix}_month_number, {alias}.month_name AS {prefix}_month_name"""


CURRENT = """{0}.current_epi_week_flag AS reporting_current_epi_week_flag,
    {0}.current_epi_year_flag AS reporting_current_epi_year_flag"""


def iso_parts(d: str) -> str:
    return f"""year({d}) AS reporting_year, quarter({d}) AS reporting_quarter, month({d}) AS reporting_month,
        monthname({d}) AS reporting_month_name, strftime({d}, '%Y-%m') AS reporting_year_month,
        CAST(isoyear({d}) AS INTEGER) AS reporting_epi_year, week({d}) AS reporting_epi_week,
        CASE WHEN {d} IS NULL THEN '-W' ELSE strftime({d}, '%G-W%V') END AS reporting_epi_week_label"""


def person_band(a: str) -> str:
    return f"""CASE WHEN {a} IS NULL OR {a} < 0 THEN 'UNKNOWN' WHEN {a} = 0 THEN '<1' WHEN {a} < 5 THEN '1-4'
        WHEN {a} < 25 THEN concat({a} // 5 * 5, '-', {a} // 5 * 5 + 4)
        WHEN {a} < 65 THEN concat(({a} - 5) // 10 * 10 + 5, '-', ({a} - 5) // 10 * 10 + 14) ELSE '65+' END"""


def pct(a: str, b: str) -> str:
    return f"round(100.0 * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 2)"


SPINE = """SELECT (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) AS first_day,
    (SELECT max(CAST(ts AS DATE)) FROM events) AS last_day,
    (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS today"""

WEEK_OF = """(SELECT DISTINCT CAST(full_date AS DATE) - CAST(isodow(full_date) % 7 AS INTEGER) AS s FROM dim_date)"""

_LAB_WORDS = """CASE WHEN result_value IS NULL THEN 'UNKNOWN'
    WHEN lower(result_value) IN ('positive', 'detected', 'reactive', 'present') THEN 'POSITIVE'
    WHEN lower(result_value) IN ('negative', 'not detected', 'non-reactive', 'non reactive', 'absent') THEN 'NEGATIVE'
    WHEN lower(result_value) IN ('indeterminate', 'inconclusive', 'invalid', 'equivocal') THEN 'INCONCLUSIVE'
    ELSE 'OTHER' END"""


def by_min(name: str, dim: str, columns: str, result: str) -> str:
    """Smallest key per case-folded value."""
    cols = columns.split()
    out = ", ".join(f"lower(trim({c}, ' ')) AS {c}" for c in cols)
    present = " AND ".join(f"{cl(c)} IS NOT NULL" for c in cols)
    return f"(SELECT {out}, min({result}) AS k FROM {dim} WHERE {present} GROUP BY ALL) {name}"


def sunday_week(d: str) -> str:
    start = f"({d} - CAST(isodow({d}) % 7 AS INTEGER))"
    end = f"({start} + 6)"
    year = f"(year({end}) - CASE WHEN month({end}) = 1 AND week({end}) > 50 THEN 1 ELSE 0 END)"
    return f"""CASE WHEN {d} IS NOT NULL THEN {key(year, f'week({end})')} END AS epi_week_key,
        {year} AS epi_year, week({end}) AS epi_week,
        CASE WHEN {d} IS NOT NULL THEN concat({year}, '-W', lpad(CAST(week({end}) AS VARCHAR), 2, '0')) END AS epi_week_label,
        {start} AS start_of_week, {end} AS end_of_week"""


_WEEK = "epi_week_key, epi_year, epi_week, epi_week_label, start_of_week, end_of_week"
_GROUP = "county, subcounty, health_facility, source_system, record_type"
_CASE_SUMS = """sum(n) AS total_cases, sum(suspected) AS suspected_cases, sum(probable) AS probable_cases,
    sum(confirmed) AS confirmed_cases, sum(sampled) AS samples_collected, sum(recovered) AS recovered_cases,
    sum(died) AS deaths"""
_CASE_RATES = f"""{pct('confirmed_cases', 'total_cases')} AS confirmation_rate,
    {pct('samples_collected', 'total_cases')} AS sample_collection_rate,
    {pct('recovered_cases', 'confirmed_cases')} AS recovery_rate,
    {pct('deaths', 'confirmed_cases')} AS case_fatality_rate"""

MODELS: dict[str, str] = {
    "slv_adam_cases": newest(
        f"""(SELECT {ENV}, {cleaned('''id_field name nationality identifier type initial_classification outcome
            samples_collected specimen_id final_laboratory_results reporting_county reporting_subcounty health_facility
            vhf_disease final_classification checked_by''')},
            CASE WHEN lower(trim(sex, ' ')) IN ('m', 'male') THEN 'Male' WHEN lower(trim(sex, ' ')) IN ('f', 'female') THEN 'Female'
                 ELSE {title(cl('sex'))} END AS sex,
            {day('date_of_birth')} AS date_of_birth, {day('date_of_investigation')} AS date_of_investigation,
            {moment('created_timestamp', True)} AS created_timestamp, {within('latitude', 90)} AS latitude,
            {within('longitude', 180)} AS longitude, {day('date_of_death')} AS date_of_death FROM adam_cases_raw)""",
        "coalesce(id_field, '__bronze_id_' || id)",
    ),
    "slv_adam_travellers": newest(
        f"""(SELECT {ENV}, {cleaned('id_field name sex nationality identifier classification point_of_entry')},
            {day('date_of_birth')} AS date_of_birth,
            CASE WHEN list_contains(['yes', 'y', 'true', '1'], lower(trim(screened, ' '))) THEN true
                 WHEN list_contains(['no', 'n', 'false', '0'], lower(trim(screened, ' '))) THEN false END AS screened,
            try_cast({cl('created_timestamp')} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS created_timestamp,
            {within('latitude', 90)} AS latitude, {within('longitude', 180)} AS longitude FROM adam_travellers_raw)""",
        "coalesce(id_field, identifier, CAST(id AS VARCHAR))",
    ),
    "slv_lims_results": newest(
        f"""(SELECT {ENV}, {cleaned('''_raw_hash subject_identifier identifier order_identifier specimen_identifier
            specimen_type performer_mfl code test_name code_text component_code unit conclusion value_code dlt_load_id
            dlt_id case_identifier id_field testing_lab_code testing_lab_name''')},
            {day('collect_date')} AS collect_date, {moment('effective_date_time', False)} AS effective_date_time,
            {number('reference_range_low', 'DECIMAL(38,10)')} AS reference_range_low,
            {number('reference_range_high', 'DECIMAL(38,10)')} AS reference_range_high FROM lims_raw)""",
        "coalesce(identifier, specimen_identifier, order_identifier, id_field, '__bronze_id_' || id)",
    ),
    "slv_uhai_cases": """SELECT nullif(system_id, '') AS system_id, nullif(names, '') AS names, upper(nullif(sex, '')) AS sex,
        try_cast(nullif(date_of_birth, '') AS DATE) AS date_of_birth, nullif(nationality, '') AS nationality,
        nullif(identifier_type, '') AS identifier_type, nullif(identifier, '') AS identifier_number,
        nullif(suspected, '') AS suspected, nullif(screening, '') AS screening, nullif(confirmed, '') AS confirmed,
        nullif(died, '') AS died, nullif(recovered, '') AS recovered, nullif(tested, '') AS tested,
        nullif(result, '') AS result, nullif(point_of_entry, '') AS point_of_entry,
        nullif(reporting_county, '') AS reporting_county, nullif(reporting_sub_county, '') AS reporting_subcounty,
        nullif(ward, '') AS ward, nullif(facility_fid, '') AS facility_id,
        nullif(community_health_unit_chu, '') AS community_health_unit,
        try_cast(nullif(reporting_date, '') AS DATE) AS reporting_date, nullif(reporting_time, '') AS reporting_time,
        try_cast(nullif(created_at, '') AS TIMESTAMP) AS created_at, dlt_load_id, dlt_id FROM uhai_raw""",
    "slv_test_time": f"""SELECT id, _ingested_at, id_field, identifier, created_timestamp AS raw_created_timestamp,
        trim(created_timestamp, ' ') AS trimmed_created_timestamp, length(created_timestamp) AS raw_character_length,
        length(trim(created_timestamp, ' ')) AS trimmed_character_length,
        CASE WHEN created_timestamp IS NULL THEN 'SOURCE_NULL' WHEN trim(created_timestamp, ' ') = '' THEN 'SOURCE_EMPTY'
             WHEN regexp_full_match(trim(created_timestamp, ' '),
                 '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?(Z|[+-]\\d\\d(:?\\d\\d)?)?') THEN 'ISO_TIMESTAMP_MATCH'
             ELSE 'NO_PATTERN_MATCH' END AS timestamp_pattern_status,
        try_cast({cl('created_timestamp')} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS parsed_created_timestamp,
        CAST(try_cast({cl('created_timestamp')} AS TIMESTAMPTZ) AT TIME ZONE 'Africa/Nairobi' AS DATE) AS parsed_screening_date
        FROM adam_travellers_raw""",
    "spine": SPINE,
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, year(d) AS year,
        quarter(d) AS quarter, month(d) AS month, rpad(monthname(d), 9, ' ') AS month_name, strftime(d, '%b') AS month_short,
        day(d) AS day, dayofyear(d) AS day_of_year, week(d) AS week_of_year, isodow(d) AS day_of_week,
        rpad(dayname(d), 9, ' ') AS day_name, strftime(d, '%a') AS day_short, isodow(d) > 5 AS is_weekend,
        (month(d) + 2) // 3 AS quarter_number, concat(year(d), '-Q', quarter(d)) AS year_quarter,
        strftime(d, '%Y-%m') AS year_month
        FROM (SELECT CAST(unnest(generate_series(first_day, last_day - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM spine)""",
    "dim_epiweek": f"""SELECT {key('y', 'w')} AS epi_week_key, s AS start_of_week, e AS end_of_week, w AS week_number,
        y AS epi_year, concat(y, '-W', lpad(CAST(w AS VARCHAR), 2, '0')) AS epi_week_label,
        dayname(s) AS start_week_day_name, dayname(e) AS end_week_day_name, today BETWEEN s AND e AS current_epi_week_flag,
        year(today) = y AS current_epi_year_flag, today AS load_date
        FROM (SELECT s, s + 6 AS e, CAST(week(s + 6) AS INTEGER) AS w, CAST(isoyear(s + 6) AS INTEGER) AS y
              FROM {WEEK_OF}), spine
        UNION ALL SELECT 'unset', DATE '1900-01-01', DATE '1900-01-01', -999, -999, 'unset', 'unset', 'unset', false, false, today
        FROM spine""",
    "dim_facilitylist": """SELECT "Code" AS facility_key, "Code" AS mfl_code, trim("Facility Name", ' ') AS facility_name,
        trim("Province", ' ') AS province, trim("County", ' ') AS county, trim("Sub County", ' ') AS subcounty,
        trim("Ward", ' ') AS ward FROM facility_seed WHERE "Code" IS NOT NULL""",
    "dim_laboratory": f"""SELECT {key('c', 'n')} AS laboratory_key, c AS laboratory_code, n AS laboratory_name
        FROM (SELECT testing_lab_code AS c, testing_lab_name AS n, row_number() OVER (
              PARTITION BY lower(coalesce(testing_lab_code, '')), lower(coalesce(testing_lab_name, ''))
              ORDER BY testing_lab_code NULLS LAST, testing_lab_name NULLS LAST) AS rn
              FROM slv_lims_results WHERE coalesce(testing_lab_code, testing_lab_name) IS NOT NULL) WHERE rn = 1""",
    "dim_labtest": f"""SELECT {key('test_code', 'test_name', 'component_code', 'specimen_type', 'unit')} AS labtest_key,
        * EXCLUDE rn FROM (SELECT code AS test_code, test_name, code_text, component_code, specimen_type, unit,
            row_number() OVER (PARTITION BY lower(coalesce(code, '')), lower(coalesce(test_name, '')),
                lower(coalesce(component_code, '')), lower(coalesce(specimen_type, '')), lower(coalesce(unit, ''))
                ORDER BY code_text IS NULL, code_text, code NULLS LAST, test_name NULLS LAST, component_code NULLS LAST,
                    specimen_type NULLS LAST, unit NULLS LAST) AS rn
            FROM slv_lims_results WHERE coalesce(code, test_name, component_code) IS NOT NULL) WHERE rn = 1""",
    "dim_location": f"""SELECT {key('p')} AS point_of_entry_key, p AS point_of_entry FROM (
        SELECT {cl('point_of_entry')} AS p FROM slv_adam_travellers UNION SELECT {cl('point_of_entry')} FROM slv_uhai_cases)
        WHERE p IS NOT NULL""",
    "dim_point_of_entry": f"""SELECT {key('lower(point_of_entry)')} AS point_of_entry_key, min(point_of_entry) AS point_of_entry,
        lower(point_of_entry) AS point_of_entry_normalized, 'ADAM' AS source_system, true AS is_active
        FROM slv_adam_travellers WHERE point_of_entry IS NOT NULL GROUP BY lower(point_of_entry)
        UNION ALL SELECT md5('UNKNOWN'), 'Unknown', 'unknown', 'SYSTEM', true""",
    "fct_case_investigation": surveillance(
        "case", "person", "investigation", "investigation_count", "case_investigation_key", "date_of_birth_key"),
    "fct_contact_registration": surveillance(
        "contact", "contact", "registration", "contact_registration_count", "contact_registration_key",
        "contact_date_of_birth_key"),
    "fct_treatment_outcome": f"""SELECT {key('source_system', 'source_record_id')} AS treatment_outcome_key,
        {date_key('outcome_date')} AS outcome_date_key,
        {date_key('CAST(outcome_recorded_datetime AS DATE)')} AS outcome_recorded_date_key,
        {date_key('source_person_date_of_birth')} AS date_of_birth_key, *
        FROM (SELECT *, CASE WHEN died_flag = 1 THEN 'DECEASED' WHEN source_outcome IN ('ALIVE', 'RECOVERED', 'ON_TREATMENT',
                'TRANSFERRED', 'LOST_TO_FOLLOW_UP') THEN source_outcome ELSE 'UNKNOWN' END AS treatment_outcome,
            CASE WHEN died_flag = 1 THEN date_of_death END AS outcome_date, 1 AS treatment_outcome_count
        FROM (SELECT * EXCLUDE outcome, {outcome_of('outcome', 'final_laboratory_result')} AS source_outcome,
            CAST(date_of_death IS NOT NULL AND final_classification = 'CONFIRMED' AND final_laboratory_result = 'POSITIVE'
                AS INTEGER) AS died_flag,
            CASE WHEN date_of_death IS NULL THEN NULL
                WHEN final_classification <> 'CONFIRMED' THEN 'DEATH_DATE_WITHOUT_CONFIRMED_CLASSIFICATION'
                WHEN final_laboratory_result = 'NEGATIVE' THEN 'DEATH_DATE_WITH_NEGATIVE_LAB_RESULT'
                WHEN final_laboratory_result <> 'POSITIVE' THEN 'DEATH_DATE_WITHOUT_POSITIVE_LAB_RESULT'
            END AS outcome_validation_status
        FROM (SELECT 'ADAM' AS source_system, id AS source_row_id, {RECORD_ID} AS source_record_id, {person('person')},
            vhf_disease AS disease, outcome, date_of_death, created_timestamp AS outcome_recorded_datetime, {classes()},
            final_laboratory_results AS source_final_laboratory_result,
            {lab_result_of('final_laboratory_results')} AS final_laboratory_result, specimen_id AS specimen_identifier,
            reporting_county, reporting_subcounty, health_facility, checked_by, latitude, longitude, {AUDIT}
        FROM slv_adam_cases WHERE lower(type) = 'case' AND (outcome IS NOT NULL OR date_of_death IS NOT NULL))))""",
    "fct_screening": f"""SELECT {key('source_system', 'surveillance_pathway', 'source_record_id')} AS screening_key,
        {date_key('screening_date')} AS screening_date_key,
        coalesce((SELECT point_of_entry_key FROM dim_point_of_entry p
                  WHERE p.point_of_entry_normalized = lower(s.point_of_entry)), md5('UNKNOWN')) AS point_of_entry_key, s.*
        FROM (SELECT 'ADAM' AS source_system, 'TRAVELLER' AS surveillance_pathway, id AS source_row_id,
            {RECORD_ID} AS source_record_id, name AS source_person_name, identifier AS source_person_identifier,
            CAST((created_timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Africa/Nairobi' AS DATE) AS screening_date,
            created_timestamp AS screening_datetime, point_of_entry, classification AS source_classification,
            coalesce(upper(classification), 'NORMAL') AS screening_outcome, screened, 1 AS screening_count,
            CAST(classification IS NULL AS INTEGER) AS normal_flag,
            CAST(coalesce(lower(classification) IN ('suspected', 'probable'), false) AS INTEGER) AS flagged_flag,
            CAST(coalesce(lower(classification) = 'suspected', false) AS INTEGER) AS suspected_flag,
            CAST(coalesce(lower(classification) = 'probable', false) AS INTEGER) AS probable_flag,
            latitude, longitude, {AUDIT} FROM slv_adam_travellers) s""",
    "fct_lab_result": f"""SELECT {key('source_system', 'source_record_id')} AS lab_result_key,
        {date_key('collection_date')} AS collection_date_key, {date_key('CAST(result_datetime AS DATE)')} AS result_date_key,
        *, 1 AS test_count, CAST(lab_test_key IS NOT NULL AS INTEGER) AS lab_test_matched_flag,
        CAST(requesting_facility_key IS NOT NULL AS INTEGER) AS requesting_facility_matched_flag,
        CAST(testing_laboratory_key IS NOT NULL AS INTEGER) AS testing_laboratory_matched_flag
        FROM (SELECT r.*, {_LAB_WORDS} AS result_category, coalesce(t1.k, t2.k, t3.k, t4.k) AS lab_test_key,
            f.k AS requesting_facility_key, coalesce(l1.k, l2.k) AS testing_laboratory_key
        FROM (SELECT 'LIMS' AS source_system, id AS source_row_id,
            coalesce(id_field, identifier, specimen_identifier, order_identifier, CAST(id AS VARCHAR)) AS source_record_id,
            subject_identifier, identifier, case_identifier, order_identifier, specimen_identifier, specimen_type,
            collect_date AS collection_date, effective_date_time AS result_datetime,
            performer_mfl AS requesting_facility_mfl, testing_lab_code AS testing_laboratory_code,
            testing_lab_name AS testing_laboratory_name, code AS test_code, test_name, code_text AS test_code_text,
            component_code, unit AS result_unit, conclusion AS source_result, value_code AS source_value_code,
            coalesce(conclusion, value_code) AS result_value, reference_range_low, reference_range_high, {AUDIT}
            FROM slv_lims_results) r
        LEFT JOIN {by_min('t1', 'dim_labtest', 'test_code component_code', 'labtest_key')}
            ON lower(r.test_code) = t1.test_code AND lower(r.component_code) = t1.component_code
        LEFT JOIN {by_min('t2', 'dim_labtest', 'test_code', 'labtest_key')} ON lower(r.test_code) = t2.test_code
        LEFT JOIN {by_min('t3', 'dim_labtest', 'test_name', 'labtest_key')} ON lower(r.test_name) = t3.test_name
        LEFT JOIN {by_min('t4', 'dim_labtest', 'code_text', 'labtest_key')} ON lower(r.test_code_text) = t4.code_text
        LEFT JOIN {by_min('f', 'dim_facilitylist', 'mfl_code', 'facility_key')} ON lower(r.requesting_facility_mfl) = f.mfl_code
        LEFT JOIN {by_min('l1', 'dim_laboratory', 'laboratory_code', 'laboratory_key')}
            ON lower(r.testing_laboratory_code) = l1.laboratory_code
        LEFT JOIN {by_min('l2', 'dim_laboratory', 'laboratory_name', 'laboratory_key')}
            ON lower(r.testing_laboratory_name) = l2.laboratory_name)""",
    "report_case_investigation": f"""SELECT c.* EXCLUDE (a), {date_cols('d', 'reporting')}, {week_cols('e', 'reporting', True)},
        {CURRENT.format('e')}, b.full_date AS reporting_date_of_birth, b.year AS reporting_birth_year,
        b.month AS reporting_birth_month_number, b.month_name AS reporting_birth_month_name,
        CASE WHEN c.source_person_date_of_birth <= c.investigation_date
             THEN {years('c.investigation_date', 'c.source_person_date_of_birth')} END AS age_at_investigation,
        CASE WHEN c.source_person_date_of_birth IS NULL OR c.investigation_date IS NULL THEN 'UNKNOWN'
             WHEN c.source_person_date_of_birth > c.investigation_date THEN 'INVALID'
             WHEN a < 5 THEN '0-4' WHEN a < 65 THEN concat((a - 5) // 10 * 10 + 5, '-', (a - 5) // 10 * 10 + 14)
             ELSE '65+' END AS reporting_age_group,
        CASE c.final_classification WHEN 'UNKNOWN' THEN c.initial_classification ELSE c.final_classification END
            AS reporting_case_classification,
        CASE WHEN c.final_classification IN ('CONFIRMED', 'DISCARDED') THEN 'CONCLUDED' ELSE 'OPEN' END AS investigation_status,
        1 AS total_investigation_count,
        {", ".join(tally(f'c.{w}_classification', {v: f'{w}_{v.lower()}_count' for v in
            ('SUSPECTED', 'PROBABLE', 'CONFIRMED', 'DISCARDED', 'UNKNOWN')}) for w in ('initial', 'final'))},
        {flags({
            'concluded_investigation_count': "c.final_classification IN ('CONFIRMED', 'DISCARDED')",
            'open_investigation_count': "c.final_classification IN ('SUSPECTED', 'PROBABLE', 'UNKNOWN')",
            'sample_collected_count': 'c.sample_collected_flag = 1',
            'sample_not_collected_count': 'c.sample_collected_flag = 0'})}
        FROM (SELECT *, {years('investigation_date', 'source_person_date_of_birth')} AS a FROM fct_case_investigation) c
        LEFT JOIN dim_date d ON c.investigation_date_key = d.date_key
        LEFT JOIN dim_epiweek e ON d.full_date BETWEEN e.start_of_week AND e.end_of_week
        LEFT JOIN dim_date b ON c.date_of_birth_key = b.date_key""",
    "report_screening": f"""SELECT s.*, {date_cols('d', 'reporting')}, {week_cols('e', 'reporting', True)}, {CURRENT.format('e')},
        coalesce(p.point_of_entry, s.point_of_entry, 'Unknown') AS reporting_point_of_entry,
        CASE WHEN s.suspected_flag = 1 THEN 'SUSPECTED' WHEN s.probable_flag = 1 THEN 'PROBABLE'
             WHEN s.normal_flag = 1 THEN 'NORMAL' ELSE s.screening_outcome END AS reporting_screening_category,
        1 AS total_screening_count, s.normal_flag AS normal_screening_count, s.flagged_flag AS flagged_screening_count,
        s.suspected_flag AS suspected_screening_count, s.probable_flag AS probable_screening_count,
        CASE WHEN s.normal_flag + s.flagged_flag = 0 THEN 1 ELSE 0 END AS unknown_screening_count
        FROM fct_screening s LEFT JOIN dim_date d ON s.screening_date_key = d.date_key
        LEFT JOIN dim_epiweek e ON d.full_date BETWEEN e.start_of_week AND e.end_of_week
        LEFT JOIN dim_point_of_entry p ON s.point_of_entry_key = p.point_of_entry_key""",
    "report_lab_result": f"""SELECT r.*, {date_cols('c', 'reporting_collection')}, {week_cols('ce', 'reporting_collection', False)},
        {date_cols('d', 'reporting_result')}, {week_cols('de', 'reporting_result', False)}, {CURRENT.format('de')},
        f.mfl_code AS reporting_requesting_facility_mfl, l.laboratory_code AS reporting_testing_laboratory_code,
        l.laboratory_name AS reporting_testing_laboratory_name,
        CASE WHEN tat >= 0 THEN tat END AS turnaround_time_days,
        CASE WHEN r.result_datetime >= r.collection_date THEN
            round(CAST(epoch_us(r.result_datetime) - epoch_us(CAST(r.collection_date AS TIMESTAMP)) AS DECIMAL(20, 0)) / 3600000000, 2)
            END AS turnaround_time_hours,
        CASE WHEN tat IS NULL THEN 'UNKNOWN' WHEN tat < 0 THEN 'INVALID' WHEN tat = 0 THEN 'SAME DAY' WHEN tat = 1 THEN '1 DAY'
             WHEN tat < 4 THEN '2-3 DAYS' WHEN tat < 8 THEN '4-7 DAYS' ELSE 'OVER 7 DAYS' END AS turnaround_time_band,
        1 AS total_test_count,
        {tally('r.result_category', {'POSITIVE': 'positive_test_count', 'NEGATIVE': 'negative_test_count',
            'INCONCLUSIVE': 'inconclusive_test_count', 'OTHER': 'other_result_count', 'UNKNOWN': 'unknown_result_count'})},
        {flags({
            'result_available_count': "r.result_category <> 'UNKNOWN'",
            'result_not_available_count': "r.result_category = 'UNKNOWN'",
            'specimen_identified_count': 'r.specimen_identifier IS NOT NULL',
            'case_linked_test_count': 'r.case_identifier IS NOT NULL',
            'requesting_facility_matched_count': 'r.requesting_facility_key IS NOT NULL',
            'testing_laboratory_matched_count': 'r.testing_laboratory_key IS NOT NULL'})}
        FROM fct_lab_result r LEFT JOIN LATERAL (SELECT CAST(r.result_datetime AS DATE) - r.collection_date AS tat) ON true
        LEFT JOIN dim_date c ON r.collection_date_key = c.date_key
        LEFT JOIN dim_epiweek ce ON c.full_date BETWEEN ce.start_of_week AND ce.end_of_week
        LEFT JOIN dim_date d ON r.result_date_key = d.date_key
        LEFT JOIN dim_epiweek de ON d.full_date BETWEEN de.start_of_week AND de.end_of_week
        LEFT JOIN dim_facilitylist f ON r.requesting_facility_key = f.facility_key
        LEFT JOIN dim_laboratory l ON r.testing_laboratory_key = l.laboratory_key""",
    "report_contact_registration": f"""SELECT * EXCLUDE (contact_registration_count), {iso_parts('registration_date')},
        {person_band('age_at_registration')} AS reporting_age_group, 1 AS total_contact_registration_count,
        {tally('initial_classification', {'SUSPECTED': 'suspected_contact_count', 'PROBABLE': 'probable_contact_count',
            'CONFIRMED': 'confirmed_contact_count', 'DISCARDED': 'discarded_contact_count',
            'UNKNOWN': 'unknown_classification_count'})},
        sample_collected_flag AS sampled_contact_count, 1 - sample_collected_flag AS not_sampled_contact_count,
        {flags({
            'specimen_identifier_available_count': 'specimen_identifier IS NOT NULL',
            'contact_identifier_available_count': 'source_contact_identifier IS NOT NULL',
            'disease_available_count': 'disease IS NOT NULL',
            'registration_date_available_count': 'registration_date IS NOT NULL'})}
        FROM (SELECT *, {years('registration_date', 'source_contact_date_of_birth')} AS age_at_registration
              FROM fct_contact_registration)""",
    "report_treatment_outcome": f"""SELECT * EXCLUDE (treatment_outcome_count), {iso_parts('reporting_date')},
        {person_band('age_at_outcome')} AS reporting_age_group, 1 AS total_treatment_outcome_count,
        {tally('treatment_outcome', {'ALIVE': 'alive_count', 'RECOVERED': 'recovered_count', 'DECEASED': 'deceased_count',
            'ON_TREATMENT': 'on_treatment_count', 'TRANSFERRED': 'transferred_count',
            'LOST_TO_FOLLOW_UP': 'lost_to_follow_up_count', 'UNKNOWN': 'unknown_outcome_count'})},
        {tally('final_classification', {v: f'{v.lower()}_case_outcome_count' for v in
            ('CONFIRMED', 'PROBABLE', 'SUSPECTED', 'DISCARDED')})},
        {tally('final_laboratory_result', {'POSITIVE': 'positive_lab_outcome_count', 'NEGATIVE': 'negative_lab_outcome_count'})},
        {flags({
            'valid_outcome_count': 'outcome_validation_status IS NULL',
            'outcome_validation_issue_count': 'outcome_validation_status IS NOT NULL',
            'death_without_confirmed_classification_count': "outcome_validation_status LIKE '%CONFIRMED_CLASSIFICATION'",
            'death_with_negative_lab_result_count': "outcome_validation_status LIKE '%NEGATIVE_LAB_RESULT'",
            'death_without_positive_lab_result_count': "outcome_validation_status LIKE '%POSITIVE_LAB_RESULT'",
            'known_outcome_count': "treatment_outcome <> 'UNKNOWN'",
            'outcome_date_available_count': 'reporting_date IS NOT NULL',
            'disease_available_count': 'disease IS NOT NULL'})}
        FROM (SELECT *, {years('reporting_date', 'source_person_date_of_birth')} AS age_at_outcome
              FROM (SELECT *, coalesce(outcome_date, CAST(outcome_recorded_datetime AS DATE)) AS reporting_date
                    FROM fct_treatment_outcome))""",
    "case_rows": f"""SELECT {sunday_week('investigation_date')}, investigation_date AS d, reporting_county AS county,
            reporting_subcounty AS subcounty, health_facility, source_system, 'case' AS record_type, 1 AS n,
            CAST(reporting_case_classification = 'SUSPECTED' AS INTEGER) AS suspected,
            CAST(reporting_case_classification = 'PROBABLE' AS INTEGER) AS probable,
            CAST(reporting_case_classification = 'CONFIRMED' AS INTEGER) AS confirmed,
            sample_collected_count AS sampled, 0 AS recovered, 0 AS died FROM report_case_investigation
        UNION ALL SELECT {sunday_week('registration_date')}, registration_date, reporting_county, reporting_subcounty,
            health_facility, source_system, 'contact', 1, suspected_contact_count, probable_contact_count,
            confirmed_contact_count, sampled_contact_count, 0, 0 FROM report_contact_registration
        UNION ALL SELECT {sunday_week('reporting_date')}, reporting_date, reporting_county, reporting_subcounty,
            health_facility, source_system, 'case', 0, 0, 0, 0, 0, recovered_count, deceased_count FROM report_treatment_outcome""",
    "report_case_distribution": f"""SELECT *, {pct('suspected_cases', 'total_cases')} AS suspected_case_rate,
        {pct('probable_cases', 'total_cases')} AS probable_case_rate, {_CASE_RATES}
        FROM (SELECT {_WEEK}, {_GROUP}, {_CASE_SUMS} FROM case_rows GROUP BY ALL)""",
    "report_case_trend": f"""SELECT *, total_cases - previous_week_cases AS weekly_case_change,
        {pct('(total_cases - previous_week_cases)', 'previous_week_cases')} AS weekly_case_change_percentage, {_CASE_RATES}
        FROM (SELECT *, sum(total_cases) OVER ytd AS cumulative_cases, sum(confirmed_cases) OVER ytd AS cumulative_confirmed_cases,
            sum(deaths) OVER ytd AS cumulative_deaths,
            round(avg(total_cases) OVER (PARTITION BY {_GROUP} ORDER BY start_of_week ROWS 3 PRECEDING), 2)
                AS moving_average_4_week_cases,
            lag(total_cases) OVER (PARTITION BY {_GROUP} ORDER BY start_of_week) AS previous_week_cases
            FROM (SELECT {_WEEK}, {_GROUP}, {_CASE_SUMS} FROM case_rows WHERE start_of_week IS NOT NULL GROUP BY ALL)
            WINDOW ytd AS (PARTITION BY {_GROUP}, epi_year ORDER BY epi_week ROWS UNBOUNDED PRECEDING))""",
    "border_rows": """SELECT reporting_date AS d, reporting_county AS county, reporting_subcounty AS subcounty, b.ward,
        coalesce(nullif(trim(point_of_entry, ' '), ''), 'Unknown') AS point_of_entry, facility_id AS mfl_code, facility_name,
        CASE WHEN confirmed_flag = 1 THEN 'CONFIRMED' WHEN suspected_flag = 1 THEN 'SUSPECTED' ELSE 'NORMAL' END AS classification,
        result AS test_result, suspected_flag, confirmed_flag, tested_flag,
        CASE WHEN nullif(trim(screening, ' '), '') IS NULL OR lower(trim(screening, ' ')) IN ('no', 'n', 'false', '0') THEN 0 ELSE 1 END AS screened_flag
        FROM (SELECT *, CASE WHEN lower(trim(suspected, ' ')) IN ('yes', 'y', 'true', '1') THEN 1 ELSE 0 END AS suspected_flag,
                CASE WHEN lower(trim(confirmed, ' ')) IN ('yes', 'y', 'true', '1') THEN 1 ELSE 0 END AS confirmed_flag,
                CASE WHEN lower(trim(tested, ' ')) IN ('yes', 'y', 'true', '1') THEN 1 ELSE 0 END AS tested_flag
              FROM slv_uhai_cases) b
        LEFT JOIN dim_facilitylist f ON b.facility_id = f.facility_key""",
    "report_screening_summary": f"""SELECT *, {pct('total_screened', 'total_screening_records')} AS screening_completion_rate,
        {pct('total_suspected', 'total_screened')} AS suspected_screening_rate, {pct('total_tested', 'total_suspected')} AS testing_rate,
        {pct('total_confirmed', 'total_tested')} AS positivity_rate, {pct('total_confirmed', 'total_screened')} AS confirmed_screening_rate
        FROM (SELECT reporting_date AS screening_date, reporting_year AS screening_year,
            reporting_month_number AS screening_month_number, trim(reporting_month_name) AS screening_month_name,
            reporting_epi_week_key AS epi_week_key, reporting_epi_year AS epi_year, reporting_epi_week AS epi_week,
            reporting_epi_week_label AS epi_week_label, reporting_epi_week_start_date AS start_of_week,
            reporting_epi_week_end_date AS end_of_week, NULL::VARCHAR AS county, NULL::VARCHAR AS subcounty, NULL::VARCHAR AS ward,
            reporting_point_of_entry AS point_of_entry, NULL::VARCHAR AS mfl_code, NULL::VARCHAR AS facility_name, source_system,
            reporting_screening_category AS classification, NULL::VARCHAR AS test_result, count(*) AS total_screening_records,
            count(*) FILTER (screened) AS total_screened,
            sum(suspected_screening_count) AS total_suspected, sum(flagged_screening_count) AS total_flagged,
            0::BIGINT AS total_confirmed, 0::BIGINT AS total_tested
            FROM report_screening GROUP BY ALL
        UNION ALL BY NAME SELECT d AS screening_date, year(d) AS screening_year, month(d) AS screening_month_number,
            monthname(d) AS screening_month_name, {sunday_week('d')}, county, subcounty, ward, point_of_entry, mfl_code,
            facility_name, 'UHAI' AS source_system, classification, test_result, count(*) AS total_screening_records,
            sum(screened_flag) AS total_screened, sum(suspected_flag) AS total_suspected, sum(suspected_flag) AS total_flagged,
            sum(confirmed_flag) AS total_confirmed, sum(tested_flag) AS total_tested
            FROM border_rows GROUP BY ALL)""",
    "lab_days": """SELECT r.*, coalesce(reporting_result_date, reporting_collection_date) AS d, f.county, f.subcounty, f.facility_name
        FROM report_lab_result r LEFT JOIN dim_facilitylist f ON r.requesting_facility_key = f.facility_key""",
    "report_laboratory_summary": f"""SELECT *, {pct('positive_tests', '(positive_tests + negative_tests + inconclusive_tests)')} AS positivity_rate,
        {pct('negative_tests', 'total_tests')} AS negative_rate, {pct('inconclusive_tests', 'total_tests')} AS inconclusive_rate,
        {pct('unknown_tests', 'total_tests')} AS unknown_result_rate,
        {pct('(positive_tests + negative_tests + inconclusive_tests)', 'total_tests')} AS result_completion_rate
        FROM (SELECT {sunday_week('d')}, year(d) AS result_year, month(d) AS result_month_number,
            monthname(d) AS result_month_name, county, subcounty, reporting_requesting_facility_mfl AS mfl_code, facility_name,
            source_system, specimen_type, test_code AS loinc_code, test_name, test_code_text AS code_text, component_code,
            result_unit AS unit, result_category, count(*) AS total_tests, sum(positive_test_count) AS positive_tests,
            sum(negative_test_count) AS negative_tests, sum(inconclusive_test_count) AS inconclusive_tests,
            sum(unknown_result_count) AS unknown_tests, sum(other_result_count) AS other_tests
            FROM lab_days GROUP BY ALL)""",
    "report_geographic_summary": f"""SELECT activity_date, county, subcounty, point_of_entry, facility, total_cases, confirmed_cases,
        deaths, total_screening_records, total_screened, suspected_screenings, confirmed_screenings, tested_screenings,
        laboratory_tests, positive_tests,
        negative_tests, inconclusive_tests, {sunday_week('activity_date')}, year(activity_date) AS activity_year,
        month(activity_date) AS activity_month_number, monthname(activity_date) AS activity_month_name,
        {pct('confirmed_cases', 'total_cases')} AS confirmation_rate, {pct('deaths', 'confirmed_cases')} AS case_fatality_rate,
        {pct('suspected_screenings', 'total_screened')} AS suspected_screening_rate,
        {pct('tested_screenings', 'suspected_screenings')} AS screening_testing_rate,
        {pct('confirmed_screenings', 'tested_screenings')} AS screening_positivity_rate,
        {pct('positive_tests', '(positive_tests + negative_tests + inconclusive_tests)')} AS laboratory_positivity_rate
        FROM (SELECT activity_date, county, subcounty, point_of_entry, facility, sum(a) AS total_cases, sum(b) AS confirmed_cases,
            sum(c) AS deaths, sum(s) AS total_screening_records, sum(t) AS total_screened, sum(u) AS suspected_screenings,
            sum(v) AS confirmed_screenings, sum(w) AS tested_screenings,
            sum(l) AS laboratory_tests, sum(p) AS positive_tests, sum(q) AS negative_tests, sum(i) AS inconclusive_tests
        FROM (SELECT d AS activity_date, county, subcounty, NULL AS point_of_entry, health_facility AS facility, n AS a,
                confirmed AS b, died AS c, 0 AS s, 0 AS t, 0 AS u, 0 AS v, 0 AS w, 0 AS l, 0 AS p, 0 AS q, 0 AS i
              FROM case_rows WHERE record_type = 'case'
            UNION ALL SELECT reporting_date, NULL, NULL, reporting_point_of_entry, NULL, 0, 0, 0, 1,
                CASE WHEN screened THEN 1 ELSE 0 END, suspected_screening_count, 0, 0, 0, 0, 0, 0
              FROM report_screening
            UNION ALL SELECT d, county, subcounty, point_of_entry, facility_name, 0, 0, 0, 1, screened_flag, suspected_flag,
                confirmed_flag, tested_flag, 0, 0, 0, 0 FROM border_rows
            UNION ALL SELECT d, county, subcounty, NULL, facility_name, 0, 0, 0, 0, 0, 0, 0, 0, 1, positive_test_count,
                negative_test_count, inconclusive_test_count FROM lab_days) GROUP BY ALL)""",
}


def _whole(text: str) -> str:
    """Sums of integers as BIGINT, the type Spark gives them."""
    return re.sub(r"sum\((\w+)\)( OVER ytd)?", r"CAST(sum(\1)\2 AS BIGINT)", text)


# Columns handed over as text: dates and times print alike on both sides.
TEXT_COLUMNS = (
    ".*(_date|_datetime|_at|start_of_week|end_of_week|_timestamp|_date_time|date_of_birth|"
    "date_of_death|date_of_investigation)"
)
DOUBLE_COLUMNS = "reference_range_low|reference_range_high|turnaround_time_hours"
NO_DATES = ("dim_facilitylist", "dim_laboratory", "dim_labtest", "dim_location", "dim_point_of_entry")


def model_query(name: str) -> str:
    if name in NO_DATES:
        return with_models(f"SELECT * FROM {name}")
    odd = f"{TEXT_COLUMNS}|{DOUBLE_COLUMNS}"
    doubles = (
        f", CAST(COLUMNS(lambda c: regexp_full_match(c, '{DOUBLE_COLUMNS}')) AS DOUBLE)"
        if name in ("slv_lims_results", "fct_lab_result", "report_lab_result")
        else ""
    )
    return with_models(
        f"""SELECT COLUMNS(lambda c: NOT regexp_full_match(c, '{odd}')),
        CAST(COLUMNS(lambda c: regexp_full_match(c, '{TEXT_COLUMNS}')) AS VARCHAR){doubles} FROM {name}"""
    )


def with_models(select: str) -> str:
    """The query, preceded by every feed and model it needs as a common table expression."""
    definitions = {**{n: duckdb_feed(n) for n in FEEDS}, **MODELS}
    ordered: list[str] = []

    def need(text: str, seen: tuple[str, ...]) -> None:
        for name in definitions:
            if name not in seen and re.search(rf"\b{name}\b", text):
                need(definitions[name], (*seen, name))
                if name not in ordered:
                    ordered.append(name)

    need(select, ())
    if not ordered:
        return select
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({_whole(definitions[n])})" for n in ordered)
    return f"WITH {ctes}\n{select}"
