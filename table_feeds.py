"""Landing-shaped rows derived from the benchmark tables.

The tables hold no surveillance data, so each landing table is rendered from one of them:
every row of the source table becomes a record whose text columns carry the formats,
synonyms, gaps and repeats the models have to deal with. The SQL below uses only what
Spark and DuckDB read alike, so both sides of a check start from the same rows.
"""

from __future__ import annotations

from vigil.session import stored_bytes


def iso(day: str) -> str:
    return f"CAST(CAST({day} AS DATE) AS STRING)"


def dmy(day: str) -> str:
    s = iso(day)
    return f"concat(substr({s}, 9, 2), '/', substr({s}, 6, 2), '/', substr({s}, 1, 4))"


def pick(key: str, n: int, values: list[str], other: str = "''") -> str:
    """One of the SQL values by key modulo n, so that every variant occurs."""
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {key} % {n} {whens} ELSE {other} END"


def words(key: str, n: int, values: list[str], other: str = "") -> str:
    return pick(key, n, [f"'{v}'" for v in values], f"'{other}'")


def envelope(key: str, at: str, source: str) -> str:
    return f"""{key} AS id, CAST({at} AS TIMESTAMP) AS _ingested_at, ' {source} ' AS _source,
        concat('b', {key} % 97) AS _batch_id, concat('{source}/', {key} % 97, '.json ') AS _source_file,
        concat('h', {key}) AS _raw_hash, CASE WHEN {key} % 2 = 0 THEN true END AS _processed"""


_k = "o_orderkey"
_birth = f"(CAST(o_orderdate AS DATE) - CAST((o_custkey * 37 + {_k} % 5 * 1009) % 36500 - 300 AS INT))"
_death = "(CAST(o_orderdate AS DATE) + 10)"
CASES = f"""
    SELECT {envelope(_k, 'o_orderdate', 'cases')},
        CASE WHEN {_k} % 11 = 5 THEN '  ' WHEN {_k} % 7 = 1 THEN concat('C', {_k} - 1)
             ELSE concat(' C', {_k}, ' ') END AS id_field,
        CASE WHEN {_k} % 13 = 0 THEN '' ELSE concat(' ', c_name) END AS name,
        {words(_k, 7, ['m', 'FEMALE', ' other-x y', ' ', 'Male ', 'f'])} AS sex,
        {pick(_k, 8, [iso(_birth), dmy(_birth), "'2026-02-30'", "'0000-01-01'", "' '",
                      f"concat(' ', {iso(_birth)}, ' ')", iso(_birth), "'n/a'"])} AS date_of_birth,
        concat('N', c_nationkey) AS nationality,
        CASE WHEN {_k} % 5 = 0 THEN '' ELSE concat('P', o_custkey) END AS identifier,
        {words(_k, 5, ['case', ' Case ', 'Contact', 'CASE', ' '])} AS type,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Suspected' WHEN '2-HIGH' THEN ' probable'
             WHEN '3-MEDIUM' THEN 'CONFIRMED' WHEN '4-NOT SPECIFIED' THEN 'Not a case'
             ELSE {words(_k, 3, ['', 'Pending review', 'negative'])} END AS initial_classification,
        {pick(_k, 19, ["'Dead'", "'deceased / dead'", "'alive'", "'Discharged'", "'admitted'",
                       "'referred'", "'LTFU'", "' '", "'unknown text'", "'died '", "'Living'",
                       "'recovery'", "'hospitalised'", "'transfer out'", "'lost'"])} AS outcome,
        {words(_k, 6, ['Yes', 'y', 'TRUE', '1', 'no', ''])} AS samples_collected,
        CASE WHEN {_k} % 3 = 0 THEN '' ELSE concat('SP', {_k}) END AS specimen_id,
        {words(_k, 9, ['Positive', 'DETECTED', 'negative', 'Not_detected', 'indeterminate', '',
                       'weird', 'positive / detected', 'nonreactive '])} AS final_laboratory_results,
        concat('County ', c_nationkey) AS reporting_county,
        c_mktsegment AS reporting_subcounty,
        concat('HF', {_k} % 5) AS health_facility,
        {pick(_k, 9, ["''", dmy('o_orderdate'), "'31/02/1999'"], iso('o_orderdate'))} AS date_of_investigation,
        {pick(_k, 8, [iso('o_orderdate'), f"concat({iso('o_orderdate')}, 'T10:20:30')",
                      f"concat({iso('o_orderdate')}, ' 10:20:30.123456')", dmy('o_orderdate'),
                      f"concat({iso('o_orderdate')}, 'T10:20:30+03:00')",
                      f"concat(' ', {iso('o_orderdate')}, ' 23:59:59.5')", "'junk'",
                      f"concat({iso('o_orderdate')}, ' 25:00:00')"])} AS created_timestamp,
        {pick(_k, 5, ["'91'", f"concat('-', {_k} % 90, '.', {_k} % 97)", "'abc'", "' 45 '", "'4.'"])} AS latitude,
        {pick(_k, 5, ["'-181.5'", f"concat({_k} % 180, '.5')", "''", "'36.8'", "'1e2'"])} AS longitude,
        CASE WHEN {_k} % 4 = 0 THEN ' ' ELSE concat('Disease ', {_k} % 3) END AS vhf_disease,
        {pick(_k, 5, [iso(_death), dmy(_death)])} AS date_of_death,
        CASE o_orderstatus WHEN 'F' THEN {words(_k, 3, ['confirmed', 'Negative', 'discarded'])}
             WHEN 'O' THEN {words(_k, 2, ['', 'suspected'])} ELSE 'Confirmed ' END AS final_classification,
        concat('U', {_k} % 10) AS checked_by
    FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey"""

_e = "event_id"
_ts = "CAST(ts AS STRING)"
TRAVELLERS = f"""
    SELECT {envelope(_e, 'ts', 'travellers')},
        CASE WHEN {_e} % 10 <= 2 THEN ' ' WHEN {_e} % 10 = 3 THEN concat('T', {_e} + 1)
             ELSE concat('T', {_e}) END AS id_field,
        concat('Traveller ', user_id) AS name,
        {words(_e, 3, ['M', ' ', 'f '])} AS sex,
        {pick(_e, 4, ["'1980-02-29'", "'29/02/1981'", "''", "'05/11/1990'"])} AS date_of_birth,
        concat('N', user_id % 25) AS nationality,
        CASE WHEN {_e} % 10 < 2 THEN '' ELSE concat('U', user_id) END AS identifier,
        CASE event_type WHEN 'error' THEN 'Suspected' WHEN 'purchase' THEN 'PROBABLE '
             WHEN 'click' THEN '' WHEN 'view' THEN 'Observed' ELSE '  ' END AS classification,
        {words(_e, 8, ['yes', 'N', 'TRUE', '0', 'maybe', '', '1', 'No '])} AS screened,
        CASE WHEN user_id % 30 >= 26 THEN ' ' ELSE concat({words(_e, 3, ['Border Post ', 'BORDER post ', ' border POST '])},
             user_id % 30) END AS point_of_entry,
        {pick(_e, 12, ["''", f"concat(substr({_ts}, 1, 19), 'Z')",
                       f"concat(substr({_ts}, 1, 10), 'T', substr({_ts}, 12), '+03:00')", "NULL"],
              f"concat(substr({_ts}, 1, 10), 'T', substr({_ts}, 12), '+00')")} AS created_timestamp,
        {pick(_e, 4, ["'-1.28'", "'90.01'", "''", f"concat({_e} % 90, '.25')"])} AS latitude,
        {pick(_e, 4, ["'36.8'", "'180'", "'east'", "'-180.0'"])} AS longitude
    FROM {{events}}"""

_l = "(l_orderkey * 8 + l_linenumber)"
_collect = f"(CAST(sd AS DATE) - CAST({_l} % 12 - 2 AS INT))"
LAB = f"""
    SELECT {envelope(_l, 'sd', 'lims')},
        concat('SUB', l_orderkey % 5000) AS subject_identifier,
        CASE {_l} % 4 WHEN 0 THEN '' WHEN 1 THEN concat('L', {_l} + 1) ELSE concat('L', {_l}) END AS identifier,
        concat('O', l_orderkey) AS order_identifier,
        CASE WHEN {_l} % 3 = 0 THEN ' ' ELSE concat('S', {_l}) END AS specimen_identifier,
        {words(_l, 3, ['Blood', 'blood', 'Swab'])} AS specimen_type,
        {pick(_l, 10, ["''", dmy(_collect), "'2001-02-29'"], iso(_collect))} AS collect_date,
        CASE WHEN {_l} % 13 = 0 THEN 'none' ELSE concat(' ', 10000 + sk) END AS performer_mfl,
        {pick(_l, 9, ["''", iso('sd'), f"concat({iso('sd')}, 'T08:30:00')",
                      f"concat({iso('sd')}, ' 23:59:59.25')", dmy('sd')],
              f"concat({iso('sd')}, ' 10:00:00')")} AS effective_date_time,
        CASE {_l} % 6 WHEN 0 THEN '' WHEN 1 THEN lower(p_brand) ELSE concat(p_brand, ' ') END AS code,
        CASE {_l} % 5 WHEN 0 THEN ' ' WHEN 1 THEN lower(p_type) ELSE p_type END AS test_name,
        CASE WHEN {_l} % 7 = 0 THEN '' ELSE p_name END AS code_text,
        CASE WHEN {_l} % 4 = 3 THEN '' ELSE concat('c', p_size % 5) END AS component_code,
        {words('p_size', 3, ['mg', 'MG', ''])} AS unit,
        {words(_l, 11, ['Positive', 'not detected', 'REACTIVE', '', 'Non-Reactive', 'equivocal',
                        'present', ' absent ', 'invalid', '', 'see note'])} AS conclusion,
        {words(_l, 4, ['negative', '', 'Detected', 'x1'])} AS value_code,
        {words(_l, 5, ['1.50', 'x', '', '-3', ' 7 '])} AS reference_range_low,
        {words(_l, 4, ['10', '2.25.1', '1e3', '00.5'])} AS reference_range_high,
        concat('load', {_l} % 9) AS dlt_load_id,
        concat('d', {_l}) AS dlt_id,
        CASE WHEN {_l} % 2 = 0 THEN '' ELSE concat('C', l_orderkey) END AS case_identifier,
        CASE {_l} % 5 WHEN 0 THEN '' WHEN 2 THEN concat('R', {_l} - 1) ELSE concat('R', {_l}) END AS id_field,
        CASE {_l} % 8 WHEN 0 THEN '' WHEN 1 THEN concat('lab', sk % 40) ELSE concat('LAB', sk % 40) END AS testing_lab_code,
        CASE {_l} % 9 WHEN 0 THEN '' WHEN 1 THEN concat('LAB NO ', sk % 40) ELSE concat('Lab no ', sk % 40) END AS testing_lab_name
    FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, min(l_suppkey) AS sk, min(l_shipdate) AS sd
          FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber) l
    JOIN {{part}} ON pk = p_partkey"""

_c = "c_custkey"
BORDER = f"""
    SELECT {envelope(_c, "DATE '2024-01-01'", 'uhai')},
        concat('X', {_c}) AS system_id, c_name AS names,
        {words(_c, 3, ['m', 'Female', ''])} AS sex,
        {pick(_c, 3, ["'1979-12-31'", "''", "'1985-06-07'"])} AS date_of_birth,
        concat('N', c_nationkey) AS nationality,
        {words(_c, 2, ['passport', ''])} AS identifier_type,
        concat('ID', {_c}) AS identifier,
        {words(_c, 3, ['yes', 'no', ''])} AS suspected,
        {words(_c, 5, ['done', 'yes', 'No', '', ' '])} AS screening,
        {words(_c, 4, ['yes', '', 'no', ' '])} AS confirmed,
        '' AS died,
        {words(_c, 2, ['', 'yes'])} AS recovered,
        {words(_c, 2, ['yes', ''])} AS tested,
        {words(_c, 3, ['neg', 'pos', ''])} AS result,
        CASE WHEN {_c} % 9 = 0 THEN '' ELSE concat('Airport ', {_c} % 50, ' ') END AS point_of_entry,
        concat('County ', c_nationkey) AS reporting_county,
        c_mktsegment AS reporting_sub_county,
        CASE WHEN {_c} % 2 = 0 THEN '' ELSE concat('Ward ', {_c} % 5) END AS ward,
        CASE WHEN {_c} % 3 = 0 THEN concat('F', {_c} % 100) ELSE concat('', 10000 + {_c} % 13) END AS facility_fid,
        '' AS community_health_unit_chu,
        {pick(_c, 2, ["'2024-02-29'", "''"])} AS reporting_date,
        '10:15' AS reporting_time,
        {pick(_c, 3, ["'2024-02-29 10:15:00'", "''", "'2024-03-01T00:00:01.5'"])} AS created_at,
        'l1' AS dlt_load_id, concat('d', {_c}) AS dlt_id
    FROM {{customer}}"""

FACILITY = """
    SELECT CASE WHEN s_suppkey % 50 <> 7 THEN concat('', 10000 + s_suppkey) END AS `Code`,
        concat(' ', s_name, ' ') AS `Facility Name`, r_name AS `Province`,
        concat(n_name, ' ') AS `County`, concat('Sub ', s_suppkey % 7) AS `Sub County`,
        concat('Ward ', s_suppkey % 11) AS `Ward`
    FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""

FEEDS = {
    "adam_cases_raw": CASES,
    "adam_travellers_raw": TRAVELLERS,
    "lims_raw": LAB,
    "uhai_raw": BORDER,
    "facility_seed": FACILITY,
}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "conversations",
)


def _sources(spark, sf_dir: str, name: str) -> dict:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in FEEDS[name]}


def spark_feed(spark, sf_dir: str, name: str):
    return spark.sql(FEEDS[name], **_sources(spark, sf_dir, name))


def feed_bytes(spark, sf_dir: str, name: str) -> int:
    """Size of the largest table a feed is made of."""
    return max(stored_bytes(df) for df in _sources(spark, sf_dir, name).values())


def duckdb_feed(name: str) -> str:
    text = FEEDS[name].replace("`", '"')
    for t in TABLES:
        text = text.replace(f"{{{t}}}", t)
    return text
