"""SQL that DuckDB runs beside each registered query."""

from __future__ import annotations

from oracle_models import (
    MODELS, cl, classify, day, key, lab_result_of, moment, model_query, outcome_of, pct,
    person_band, title, with_models, within, years,
)
from vigil.plans.pipeline import MODELS as SPARK_MODELS


def w(key_: str, words: list[str]) -> str:
    """The word at key modulo length."""
    listed = ", ".join(f"'{x}'" for x in words)
    return f"[{listed}][CAST({key_} % {len(words)} + 1 AS BIGINT)]"


SUNDAY = "(d - CAST(isodow(d) % 7 AS INTEGER))"
SATURDAY = f"({SUNDAY} + 6)"
EPI_WEEKLY = f"""(SELECT o_orderpriority, CAST(isoyear({SATURDAY}) AS INTEGER) AS epi_year,
        CAST(week({SATURDAY}) AS INTEGER) AS epi_week, count(*) AS total,
        count(*) FILTER (o_orderstatus = 'F') AS finished
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY ALL)"""

DAYS = """(SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders),
        (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)"""

EVENT_LEAVES = """(SELECT event_id, 'keventId' AS steps, false AS flag FROM events
    UNION ALL SELECT event_id, 'kuser/kid', false FROM events
    UNION ALL SELECT event_id, 'kuser/kact/kType', false FROM events
    UNION ALL SELECT event_id, 'kuser/kact/kcents', false FROM events
    UNION ALL SELECT event_id, 'kprops/kk', false FROM events WHERE event_type <> 'signup'
    UNION ALL SELECT event_id, 'kbig', true FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, 'ktags', false FROM events WHERE event_id % 4 = 0
    UNION ALL SELECT event_id, 'ktags/i0', false FROM events WHERE event_id % 4 > 0
    UNION ALL SELECT event_id, 'ktags/i1', false FROM events WHERE event_id % 4 > 1
    UNION ALL SELECT event_id, 'ktags/i2', false FROM events WHERE event_id % 4 > 2)"""

CLASS_WORDS = ["Suspected", " probable ", "CONFIRMED", "no case", "Not A Case", "negative", " ", "in review"]
RESULT_WORDS = ["Positive", "not detected", "equivocal", "present", "Not_Detected", "", "odd", "nonreactive"]
OUTCOME_WORDS = ["Died", "deceased /dead", "Living", "alive and discharged", "ongoing", "referred", "lost", "", "moved away"]

_DATE_TEXT = """CASE o_orderkey % 8 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-31')
    WHEN 4 THEN strftime(o_orderdate, '29/02/%Y') WHEN 5 THEN strftime(o_orderdate, '0000-%m-%d')
    WHEN 6 THEN strftime(o_orderdate, ' %Y-%m-%d  ') ELSE concat(strftime(o_orderdate, '%Y-%m-%d'), chr(10)) END"""
_STAMP_TEXT = """CASE event_id % 8 WHEN 0 THEN CAST(ts AS VARCHAR) WHEN 1 THEN replace(CAST(ts AS VARCHAR), ' ', 'T')
    WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%d') WHEN 4 THEN strftime(ts, '%d/%m/%Y')
    WHEN 5 THEN concat(CAST(ts AS VARCHAR), '+00') WHEN 6 THEN strftime(ts, '%Y-%m-%d 24:61:00') ELSE '' END"""
_NUMBER_TEXT = """CASE c_custkey % 6 WHEN 3 THEN '1e2' WHEN 4 THEN concat('+', c_custkey) WHEN 5 THEN concat(c_custkey, '.')
    ELSE concat(' ', CAST(floor(c_acctbal) AS BIGINT) % 250, '.75') END"""

_LAB_WORDS = """CASE WHEN r IN ('positive', 'detected', 'reactive', 'present') THEN 'POSITIVE'
    WHEN r IN ('negative', 'not detected', 'non-reactive', 'non reactive', 'absent') THEN 'NEGATIVE'
    WHEN r IN ('indeterminate', 'inconclusive', 'invalid', 'equivocal') THEN 'INCONCLUSIVE'
    WHEN coalesce(r, '') = '' THEN 'UNKNOWN' ELSE 'OTHER' END"""

_PARTS = """(SELECT concat('P', p_partkey) AS part_key, lower(p_name) AS name,
        CASE WHEN p_partkey % 2 = 0 THEN p_size END AS size, lower(p_brand) AS brand
    FROM part WHERE p_size < 30 AND CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) < 20)"""
_CASCADE = f"""SELECT coalesce(a.k, b.k, c.k) AS found_key, count(*) AS n_lines,
        CAST(count(coalesce(a.k, b.k, c.k)) AS BIGINT) AS n_matched, CAST(sum(l_orderkey) AS BIGINT) AS order_sum
    FROM lineitem JOIN part ON l_partkey = p_partkey
    LEFT JOIN (SELECT name, size, min(part_key) AS k FROM {_PARTS} WHERE size IS NOT NULL GROUP BY ALL) a
        ON a.name = lower(p_name) AND a.size = p_size
    LEFT JOIN (SELECT name, min(part_key) AS k FROM {_PARTS} GROUP BY ALL) b ON b.name = lower(p_name)
    LEFT JOIN (SELECT brand, min(part_key) AS k FROM {_PARTS} GROUP BY ALL) c ON c.brand = lower(p_brand)
    GROUP BY ALL"""

OPERATORS: dict[str, str] = {
    "confirmed_by_week_and_county": with_models(
        """SELECT reporting_epi_week_label, reporting_county, CAST(count(*) AS BIGINT) AS confirmed_cases
        FROM report_case_investigation WHERE reporting_case_classification = 'CONFIRMED' GROUP BY ALL"""
    ),
    "flatten_events": """SELECT event_id, CAST(event_id AS VARCHAR) AS eventid, CAST(user_id AS VARCHAR) AS user__id,
        event_type AS user__act__type, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS user__act__cents,
        CASE WHEN event_type <> 'signup' THEN props->>'$.k' END AS props__k,
        CASE WHEN event_type = 'click' THEN value > 50 END AS big, CAST(NULL AS VARCHAR) AS tags,
        CASE WHEN event_id % 4 > 0 THEN event_type END AS tags__0, CASE WHEN event_id % 4 > 1 THEN 'x' END AS tags__1,
        CASE WHEN event_id % 4 > 2 THEN 'y' END AS tags__2 FROM events""",
    "flatten_paths": f"""SELECT steps, CASE WHEN bool_or(flag) THEN 'boolean' ELSE 'text' END AS type,
        min(event_id) AS first_event FROM {EVENT_LEAVES} GROUP BY steps""",
    "flatten_leaf_counts": f"""SELECT steps, count(*) AS n_leaves, count(DISTINCT event_id) AS n_records
        FROM {EVENT_LEAVES} GROUP BY steps""",
    "record_hash_dedup": """SELECT event_id, event_id + spelling * 1000000000000 AS id
        FROM events, (VALUES (0), (2)) t(spelling) WHERE event_type <> 'view'""",
    "stream_ingest": """SELECT CAST(o_orderkey AS VARCHAR) AS "order", CAST(o_custkey AS VARCHAR) AS customer__id,
        o_orderpriority AS customer__rank, o_orderstatus = 'F' AS done, 'lims' AS _source, false AS _processed FROM orders""",
    "ingest_array_document": """SELECT CAST(o_orderkey AS VARCHAR) AS "order", CAST(o_custkey AS VARCHAR) AS customer__id,
        o_orderpriority AS customer__rank, concat('],{"', o_orderstatus) AS marks__0__status FROM orders""",
    "ingest_archived": """SELECT CAST(o_orderkey AS VARCHAR) AS "order", CAST(o_custkey AS VARCHAR) AS customer__id,
        0 AS n_left, 5 AS n_archived FROM orders""",
    "stream_ingest_loads": """SELECT count(*) AS rows_inserted, count(*) AS rows_deduped,
        'customer__id,customer__rank,done,order' AS columns_added FROM orders""",
    "preview_columns": """SELECT * FROM (VALUES ('order', 'string', true), ('customer__id', 'string', true),
        ('customer__rank', 'string', true), ('done', 'boolean', true)) t("column", "type", is_new)
        WHERE EXISTS (SELECT 1 FROM orders)""",
    "blank_to_null": """SELECT conv_id, turn, CASE WHEN turn % 5 <> 4 AND turn % 3 <> 0 THEN role END AS cleaned,
        CASE WHEN turn % 5 <> 4 AND turn % 3 <> 0 THEN role END AS emptied,
        CASE WHEN turn % 5 <> 4 AND turn % 3 <> 0 THEN upper(role) END AS code,
        lower(nullif(trim(text, ' '), '')) AS folded_text, nullif(trim(text, ' '), '') AS whole_text FROM conversations""",
    "yes_no_flag": """SELECT event_id, CASE WHEN event_id % 10 < 4 THEN true WHEN event_id % 10 < 8 THEN false END AS flag,
        CASE WHEN event_id % 10 < 4 THEN 1 ELSE 0 END AS yes_count, event_id % 2 = 0 AS defaulted FROM events""",
    "sex_normalised": f"""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN NULL
        ELSE {title("concat(c_mktsegment, '-x_y z#1a', c_name)")} END AS sex FROM customer""",
    "safe_date_parse": f"""SELECT o_orderkey, CAST({day('t')} AS VARCHAR) AS parsed_date
        FROM (SELECT o_orderkey, {_DATE_TEXT} AS t FROM orders)""",
    "safe_timestamp_parse": f"""SELECT event_id, CAST({moment('t', True)} AS VARCHAR) AS with_day_first,
        CAST({moment('t', False)} AS VARCHAR) AS iso_only,
        CAST(CASE WHEN t LIKE '____-__-__%' THEN try_cast(t AS TIMESTAMPTZ) AT TIME ZONE 'UTC' END AS VARCHAR) AS instant
        FROM (SELECT event_id, t
              FROM (SELECT event_id, {_STAMP_TEXT} AS t FROM events))""",
    "timestamp_profile": with_models(
        """SELECT timestamp_pattern_status, CAST(parsed_screening_date AS VARCHAR) AS parsed_screening_date,
        count(*) AS n_rows, count(parsed_created_timestamp) AS n_parsed, min(raw_character_length) AS shortest,
        max(trimmed_character_length) AS longest FROM slv_test_time GROUP BY ALL"""
    ),
    "bounded_numbers": f"""SELECT c_custkey, {within('t', 90)} AS latitude, {within('t', 180)} AS longitude,
        CASE WHEN regexp_full_match(trim(t), '-?[0-9]+(\\.[0-9]+)?') THEN CAST(trim(t) AS DOUBLE) END AS amount
        FROM (SELECT c_custkey, {_NUMBER_TEXT} AS t FROM customer)""",
    "latest_per_key": """SELECT event_id, user_id, event_type, value FROM (
        SELECT *, CASE WHEN event_id % 7 <> 0 THEN date_trunc('hour', ts) END AS hour FROM events) e
        WHERE event_type = 'error' OR NOT EXISTS (SELECT 1 FROM (
            SELECT *, CASE WHEN event_id % 7 <> 0 THEN date_trunc('hour', ts) END AS hour FROM events) n
            WHERE n.user_id = e.user_id AND n.event_type <> 'error'
            AND (coalesce(n.hour, TIMESTAMP '1900-01-01'), n.event_id) > (coalesce(e.hour, TIMESTAMP '1900-01-01'), e.event_id))""",
    "representative_row": """SELECT brand, kind, label FROM (SELECT *, row_number() OVER (
            PARTITION BY lower(brand), lower(coalesce(kind, '')) ORDER BY label NULLS LAST, brand, kind NULLS LAST) AS rn
        FROM (SELECT CASE p_partkey % 3 WHEN 0 THEN lower(p_brand) WHEN 1 THEN upper(p_brand) ELSE p_brand END AS brand,
            CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS kind, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS label
            FROM part)) WHERE rn = 1""",
    "duplicate_fact_keys": with_models(
        """SELECT lab_result_key, count(*) AS n_rows FROM fct_lab_result GROUP BY 1 HAVING count(*) > 1"""
    ),
    "calendar_activity": f"""SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS VARCHAR) AS full_date,
        year(d) AS year, quarter(d) AS quarter, month(d) AS month, rpad(monthname(d), 9, ' ') AS month_name,
        strftime(d, '%b') AS month_short, day(d) AS day, dayofyear(d) AS day_of_year, week(d) AS week_of_year,
        isodow(d) AS day_of_week, rpad(dayname(d), 9, ' ') AS day_name, strftime(d, '%a') AS day_short,
        isodow(d) > 5 AS is_weekend, quarter(d) AS quarter_number, concat(year(d), '-Q', quarter(d)) AS year_quarter,
        strftime(d, '%Y-%m') AS year_month,
        (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = d) AS n_orders FROM {DAYS}""",
    "date_key_lookup": """SELECT o_orderkey, CASE WHEN month(o_orderdate) < 7 THEN CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT)
        ELSE -1 END AS order_date_key FROM orders""",
    "role_playing_dates": f"""SELECT coalesce(CAST(strftime(a.d, '%Y%m%d') AS BIGINT), -1) AS order_date_key,
        coalesce(CAST(strftime(b.d, '%Y%m%d') AS BIGINT), -1) AS ship_date_key, count(*) AS n_lines
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN {DAYS} a ON a.d = CAST(o_orderdate AS DATE)
        LEFT JOIN {DAYS} b ON b.d = CAST(l_shipdate AS DATE) GROUP BY ALL""",
    "epi_week_range_join": f"""SELECT concat(CAST(isoyear(e) AS INTEGER), '-W', lpad(CAST(week(e) AS VARCHAR), 2, '0')) AS epi_week_label,
        CAST(s AS VARCHAR) AS start_of_week, today BETWEEN s AND e AS current_epi_week_flag, count(*) AS n_orders,
        CAST(sum(o_orderkey) AS BIGINT) AS key_sum
        FROM orders LEFT JOIN (SELECT DISTINCT {SUNDAY} AS s, {SATURDAY} AS e FROM {DAYS}) wk
            ON CAST(o_orderdate AS DATE) BETWEEN s AND e,
        (SELECT CAST(max(o_orderdate) AS DATE) AS today FROM orders) GROUP BY ALL""",
    "local_date": """SELECT CAST(CAST(ts + INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS screening_date,
        CAST(CAST(ts AS DATE) AS VARCHAR) AS utc_date, count(*) AS n_events FROM events GROUP BY ALL""",
    "age_years": f"""SELECT age, CASE WHEN b <= s THEN age END AS case_age,
        CASE WHEN b > s THEN 'INVALID' WHEN age < 5 THEN '0-4'
             WHEN age < 65 THEN concat((age - 5) // 10 * 10 + 5, '-', (age - 5) // 10 * 10 + 14) ELSE '65+' END AS case_age_group,
        {person_band('age')} AS person_age_group, count(*) AS n_lines
        FROM (SELECT s, b, {years('s', 'b')} AS age FROM (SELECT CAST(l_shipdate AS DATE) AS s,
            CAST(l_shipdate AS DATE) - CAST(l_partkey * 17 % 33000 - 500 AS INTEGER) AS b FROM lineitem)) GROUP BY ALL""",
    "turnaround": """SELECT l_returnflag, CASE WHEN n >= 0 THEN n END AS turnaround_time_days,
        CASE WHEN n IS NULL THEN 'UNKNOWN' WHEN n < 0 THEN 'INVALID' WHEN n = 0 THEN 'SAME DAY' WHEN n = 1 THEN '1 DAY'
             WHEN n <= 3 THEN '2-3 DAYS' WHEN n <= 7 THEN '4-7 DAYS' ELSE 'OVER 7 DAYS' END AS turnaround_time_band,
        count(*) AS n_lines,
        CAST(sum(CASE WHEN done >= asked THEN round(CAST(epoch_us(done) - epoch_us(asked) AS DECIMAL(20, 0)) / 3600000000, 2)
            END) AS DECIMAL(28, 2))::DOUBLE AS hours_sum
        FROM (SELECT l_returnflag, done, asked, CAST(done AS DATE) - CAST(asked AS DATE) AS n FROM (SELECT l_returnflag,
            l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER)) AS done,
            CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_shipdate AS DATE) - CAST(l_suppkey % 10 - 1 AS INTEGER) AS TIMESTAMP)
            END AS asked FROM lineitem)) GROUP BY ALL""",
    "iso_week_label": """SELECT year(d) AS reporting_year, quarter(d) AS reporting_quarter, month(d) AS reporting_month,
        monthname(d) AS reporting_month_name, strftime(d, '%Y-%m') AS reporting_year_month,
        CAST(isoyear(d) AS INTEGER) AS reporting_epi_year, week(d) AS reporting_epi_week,
        concat(CAST(isoyear(d) AS INTEGER), '-W', lpad(CAST(week(d) AS VARCHAR), 2, '0')) AS reporting_epi_week_label,
        count(*) AS n_orders FROM (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders)
        GROUP BY ALL""",
    "surrogate_key": f"""SELECT c_custkey, {key('n', 's', 'c_nationkey')} AS customer_key,
        coalesce(n, s, CAST(c_custkey AS VARCHAR)) AS record_id FROM (SELECT *,
            CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS n, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS s
            FROM customer)""",
    "lookup_cascade": _CASCADE,
    "lookup_cascade_large": _CASCADE,
    "unknown_member_default": """SELECT s_suppkey, CASE WHEN s_nationkey % 3 > 0 THEN md5(n_name) ELSE md5('UNKNOWN') END AS nation_key
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "not_yet_loaded": """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
    "case_folded_distinct": f"""SELECT lower({cl('t')}) AS segment_normalized, min({cl('t')}) AS segment
        FROM (SELECT CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN concat(' ', c_mktsegment) ELSE ' ' END AS t
              FROM customer) WHERE {cl('t')} IS NOT NULL GROUP BY 1""",
    "conformed_union": """SELECT 'CUSTOMER' AS source_system, c_custkey AS row_id, c_name AS name, c_nationkey AS nation FROM customer
        UNION ALL SELECT 'SUPPLIER', s_suppkey, s_name, s_nationkey FROM supplier""",
    "distinct_places": "SELECT c_nationkey AS place FROM customer UNION SELECT s_nationkey FROM supplier",
    "classification_rules": f"""SELECT o_orderstatus, i AS initial, f AS final,
        coalesce(upper({cl('c')}), 'NORMAL') AS screening,
        CASE WHEN f = 'UNKNOWN' OR o_orderkey % 3 = 0 THEN i ELSE f END AS reporting,
        CASE WHEN f IN ('CONFIRMED', 'DISCARDED') THEN 'CONCLUDED' ELSE 'OPEN' END AS status, count(*) AS n_orders
        FROM (SELECT *, {classify('c')} AS i, {classify('c', ", 'negative'")} AS f
              FROM (SELECT *, {w('o_orderkey', CLASS_WORDS)} AS c FROM orders)) GROUP BY ALL""",
    "result_and_outcome_rules": f"""SELECT lab_category, case_category, source_outcome, died_flag, validation,
        CASE WHEN died_flag = 1 THEN 'DECEASED' WHEN source_outcome IN ('ALIVE', 'RECOVERED', 'ON_TREATMENT', 'TRANSFERRED',
            'LOST_TO_FOLLOW_UP') THEN source_outcome ELSE 'UNKNOWN' END AS treatment_outcome, count(*) AS n_lines
        FROM (SELECT *, {outcome_of("nullif(o, '')", 'case_category')} AS source_outcome,
            CAST(dead AND fin = 'CONFIRMED' AND case_category = 'POSITIVE' AS INTEGER) AS died_flag,
            CASE WHEN NOT dead OR (fin = 'CONFIRMED' AND case_category = 'POSITIVE') THEN NULL
                 WHEN fin <> 'CONFIRMED' THEN 'DEATH_DATE_WITHOUT_CONFIRMED_CLASSIFICATION'
                 WHEN case_category = 'NEGATIVE' THEN 'DEATH_DATE_WITH_NEGATIVE_LAB_RESULT'
                 ELSE 'DEATH_DATE_WITHOUT_POSITIVE_LAB_RESULT' END AS validation
            FROM (SELECT *, {_LAB_WORDS} AS lab_category, {lab_result_of("nullif(r, '')")} AS case_category
                FROM (SELECT lower({w('l_partkey', RESULT_WORDS)}) AS r, {w('l_suppkey', OUTCOME_WORDS)} AS o,
                    l_linenumber < 4 AS dead, {w('l_orderkey', ['CONFIRMED', 'SUSPECTED', 'CONFIRMED'])} AS fin FROM lineitem)))
        GROUP BY ALL""",
    "category_measures": """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS finished,
        count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'P') AS partial,
        count(*) FILTER (o_orderstatus <> 'F') AS pending, count(*) FILTER (o_totalprice > 200000) AS large
        FROM orders GROUP BY ALL""",
    "weekly_rollup": f"SELECT * FROM {EPI_WEEKLY}",
    "running_total": f"""SELECT a.*, (SELECT CAST(sum(b.total) AS BIGINT) FROM {EPI_WEEKLY} b WHERE b.o_orderpriority = a.o_orderpriority
        AND b.epi_year = a.epi_year AND b.epi_week <= a.epi_week) AS cumulative FROM {EPI_WEEKLY} a""",
    "moving_average": f"""SELECT *, round(avg(total) OVER (PARTITION BY o_orderpriority ORDER BY epi_year, epi_week
        ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 2) AS mean_of_4 FROM {EPI_WEEKLY}""",
    "week_change": f"""SELECT *, total - previous AS change, {pct('(total - previous)', 'previous')} AS change_percent
        FROM (SELECT *, lag(total) OVER (PARTITION BY o_orderpriority ORDER BY epi_year, epi_week) AS previous FROM {EPI_WEEKLY})""",
    "rates": f"""SELECT *, {pct('finished', 'total')} AS finished_rate, {pct('finished', 'rest')} AS finished_to_rest
        FROM (SELECT *, total - finished AS rest FROM {EPI_WEEKLY})""",
    "domain_union_summary": f"""SELECT day, orders, events, errors, lines, {pct('errors', 'events')} AS error_rate
        FROM (SELECT day, CAST(sum(o) AS BIGINT) AS orders, CAST(sum(e) AS BIGINT) AS events, CAST(sum(x) AS BIGINT) AS errors,
            CAST(sum(l) AS BIGINT) AS lines FROM (
            SELECT strftime(o_orderdate, '%m-%d') AS day, 1 AS o, 0 AS e, 0 AS x, 0 AS l FROM orders
            UNION ALL SELECT strftime(ts, '%m-%d'), 0, 1, CAST(event_type = 'error' AS INTEGER), 0 FROM events
            UNION ALL SELECT strftime(l_shipdate, '%m-%d'), 0, 0, 0, 1 FROM lineitem) GROUP BY day)""",
}


def all_oracles() -> dict[str, str]:
    models = {name: model_query(name) for _, name, _ in SPARK_MODELS if name in MODELS}
    return {**OPERATORS, **models}
