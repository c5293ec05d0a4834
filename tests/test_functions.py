"""Column functions, with a case for every odd rule they keep."""

from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from vigil.functions import keys, measures, numeric as num, rules, temporal as tm, text as tx


def apply(spark, fn, *values, kind="string"):
    """fn(column) over the values, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.coalesce(1).orderBy("i").select(fn(F.col("v"))).collect()]


def test_blanks(spark):
    assert apply(spark, tx.blank_to_null, " a ", "  ", "", None, "\t") == ["a", None, None, None, "\t"]
    assert apply(spark, tx.empty_to_null, " ", "", None) == [" ", None, None]
    assert apply(spark, tx.folded, " Ab ", " ") == ["ab", None]


def test_sex(spark):
    got = apply(spark, tx.normalise_sex, "m", " MALE", "F ", "female", " ", None, "foo-bar bAZ", "x_1y")
    assert got == ["Male", "Male", "Female", "Female", None, None, "Foo-Bar Baz", "X_1y"]


def test_yes_no(spark):
    values = ("Yes", " y", "TRUE", "1", "no", "N", "False", "0", "maybe", "", None)
    assert apply(spark, tx.yes_no, *values) == [True] * 4 + [False] * 4 + [None] * 3
    assert apply(spark, tx.yes_flag, *values) == [1] * 4 + [0] * 7


def test_safe_date(spark):
    good = apply(spark, tm.safe_date, "2024-02-29", " 29/02/2024 ", "0001-01-01", "31/12/9999")
    assert good == [date(2024, 2, 29), date(2024, 2, 29), date(1, 1, 1), date(9999, 12, 31)]
    bad = ("2026-02-30", "0000-01-01", "01/01/0000", "2024-1-1", "20240101", "2024-02-29 ", "29/02/2023",
           "2024-02-29\n", "2024-02-29T00:00:00", "junk", "", None)
    assert apply(spark, tm.safe_date, *bad) == [None] * 5 + [date(2024, 2, 29)] + [None] * 6


def test_safe_timestamp(spark):
    at = datetime(2024, 5, 6, 7, 8, 9)
    good = ("2024-05-06 07:08:09", "2024-05-06T07:08:09", " 2024-05-06T07:08:09.5 ", "2024-05-06", "06/05/2024",
            "2024-05-06 07:08:09.1234567")
    want = [at, at, at.replace(microsecond=500000), datetime(2024, 5, 6), datetime(2024, 5, 6),
            at.replace(microsecond=123456)]
    assert apply(spark, tm.safe_timestamp, *good) == want
    # An offset fits no form here, unlike in `instant`.
    bad = ("2024-05-06T07:08:09+00", "2024-05-06T07:08:09Z", "2024-05-06 25:00:00", "2024-02-30 00:00:00", "0000-01-01", "x")
    assert apply(spark, tm.safe_timestamp, *bad) == [None] * 6
    assert apply(spark, lambda c: tm.safe_timestamp(c, day_first=False), "06/05/2024") == [None]


def test_instant_and_local_day(spark):
    text = "2026-07-14T23:09:38.031000+00"
    assert apply(spark, tm.instant, text) == [datetime(2026, 7, 14, 23, 9, 38, 31000)]
    assert apply(spark, lambda c: tm.local_date(tm.instant(c)), text) == [date(2026, 7, 15)]
    got = apply(spark, tm.instant, "2024-01-01T03:00:00+03:00", "2024-01-01T03:00:00+0300", "2024-01-01 00:00:00Z", "no", " ", "0000-01-01T00:00:00Z")
    assert got == [datetime(2024, 1, 1)] * 3 + [None] * 3


def test_numbers(spark):
    assert apply(spark, num.latitude, "-1.28", "91", "abc", "", "90", " 45 ", "4.", "+3", "1e1") == [
        -1.28, None, None, None, 90.0, 45.0, None, None, None]
    assert apply(spark, num.longitude, "180", "-180.0", "180.1") == [180.0, -180.0, None]
    assert apply(spark, num.safe_decimal, "1.50", "-3", "x", None) == [Decimal("1.5"), Decimal("-3"), None, None]


def days(spark, step=97):
    start, n = date(1890, 1, 1), 130 * 365
    return spark.range(0, n, step).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))


def test_full_years_match_an_independent_age(spark):
    picked = [date(2000, 2, 29), date(2001, 2, 28), date(2001, 3, 1), date(2004, 2, 29), date(1999, 12, 31)]
    grid = [r.d for r in days(spark, 1501).collect()] + picked
    pairs = spark.createDataFrame([(a, b) for a in grid for b in grid], "a date, b date")
    got = {(r.a, r.b): r.y for r in pairs.select("a", "b", tm.full_years(F.col("a"), F.col("b")).alias("y")).collect()}
    con = duckdb.connect()
    con.execute("create table p(a date, b date)")
    con.executemany("insert into p values (?, ?)", [list(k) for k in got])
    want = con.execute("select a, b, date_part('year', age(a, b)) from p").fetchall()
    assert [(a, b, y) for a, b, y in want if got[a, b] != y] == []


def test_a_birth_within_a_year_after_the_event_counts_as_age_zero(spark):
    row = spark.range(1).select(
        tm.full_years(F.lit(date(2024, 1, 1)), F.lit(date(2024, 6, 1))).alias("y"),
        tm.case_age(F.lit(date(2024, 1, 1)), F.lit(date(2024, 6, 1))).alias("c"),
        tm.case_age_group(F.lit(date(2024, 1, 1)), F.lit(date(2024, 6, 1))).alias("g"),
    ).first()
    assert (row.y, row.c, row.g) == (0, None, "INVALID")
    assert apply(spark, tm.person_age_group, 0, kind="int") == ["<1"]


def test_age_groups(spark):
    ages = (None, -1, 0, 1, 4, 5, 9, 10, 24, 25, 34, 54, 64, 65, 120)
    assert apply(spark, tm.person_age_group, *ages, kind="int") == [
        "UNKNOWN", "UNKNOWN", "<1", "1-4", "1-4", "5-9", "5-9", "10-14", "20-24", "25-34", "25-34", "45-54",
        "55-64", "65+", "65+"]
    event = F.lit(date(2024, 6, 1))
    births = (date(2024, 6, 1), date(2019, 6, 2), date(2019, 6, 1), date(1959, 6, 2), date(1959, 6, 1), None)
    assert apply(spark, lambda c: tm.case_age_group(event, c), *births, kind="date") == [
        "0-4", "0-4", "5-14", "55-64", "65+", "UNKNOWN"]


def test_epi_weeks_run_sunday_to_saturday(spark):
    found = days(spark, 1).select(
        "d", tm.epi_week_start(F.col("d")).alias("s"),
    ).select("d", "s", F.date_add("s", 6).alias("e")).select(
        "d", "s", "e", tm.epi_week_number(F.col("e")).alias("w"), tm.epi_year(F.col("e")).alias("y")
    ).collect()
    for r in found:
        assert r.s <= r.d <= r.e and r.s.isoweekday() == 7
        assert (r.y, r.w) == r.e.isocalendar()[:2]
    by_day = {r.d: (r.y, r.w) for r in found}
    # 1 January 2015 is a Thursday: the week of 28 December 2014 is 2015-W01 here.
    assert by_day[date(2014, 12, 28)] == (2015, 1)


def test_iso_and_epi_weeks_differ_on_sundays(spark):
    sunday = F.lit(date(2024, 3, 3))
    iso = tm.calendar_parts(sunday)["reporting_epi_week_label"]
    end = F.date_add(tm.epi_week_start(sunday), 6)
    epi = tm.week_label(tm.epi_year(end), tm.epi_week_number(end))
    assert tuple(spark.range(1).select(iso, epi).first()) == ("2024-W09", "2024-W10")


def test_iso_parts_of_no_date(spark):
    parts = tm.calendar_parts(F.lit(None).cast("date"))
    row = spark.range(1).select(*(c.alias(n) for n, c in parts.items())).first().asDict()
    assert row.pop("reporting_epi_week_label") == "-W"
    assert set(row.values()) == {None}


def test_turnaround(spark):
    taken = F.lit(date(2024, 1, 10))
    times = tuple(datetime(2024, 1, d, 12, 20) for d in (9, 10, 11, 13, 17, 18)) + (None,)
    assert apply(spark, lambda c: tm.turnaround_band(taken, c), *times, kind="timestamp") == [
        "INVALID", "SAME DAY", "1 DAY", "2-3 DAYS", "4-7 DAYS", "OVER 7 DAYS", "UNKNOWN"]
    assert apply(spark, lambda c: tm.turnaround_days(taken, c), *times, kind="timestamp") == [
        None, 0, 1, 3, 7, 8, None]
    assert apply(spark, lambda c: tm.turnaround_hours(taken, c), *times[:2], kind="timestamp") == [
        None, Decimal("12.33")]


def test_padded_names(spark):
    assert apply(spark, lambda c: tm.padded_name(c, "MMMM"), date(2024, 5, 1), date(2024, 9, 1), kind="date") == [
        "May      ", "September"]


def test_keys(spark):
    row = spark.sql("select 'a' a, cast(null as string) n, 7 i").select(
        keys.surrogate_key(F.col("a"), F.col("n")).alias("an"),
        keys.surrogate_key(F.col("n"), F.col("a")).alias("na"),
        keys.surrogate_key(F.col("a"), F.col("i")).alias("ai"),
        keys.unknown_key().alias("u"),
        keys.record_id(F.col("i"), F.col("n"), F.lit(" ")).alias("r"),
        keys.record_id(F.col("i"), F.lit(" "), F.lit(" x ")).alias("x"),
    ).first()
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert row.an == md5("a-_dbt_utils_surrogate_key_null_") != row.na
    assert (row.ai, row.u, row.r, row.x) == (md5("a-7"), md5("UNKNOWN"), "7", "x")


def test_classification(spark):
    words = ("Suspected", " probable", "CONFIRMED", "no case", "Not a Case", "discarded", "negative", "x y", " ", None)
    start = ["SUSPECTED", "PROBABLE", "CONFIRMED", "DISCARDED", "DISCARDED", "DISCARDED"]
    assert apply(spark, rules.initial_classification, *words) == start + ["NEGATIVE", "X Y", "UNKNOWN", "UNKNOWN"]
    assert apply(spark, rules.final_classification, *words) == start + ["DISCARDED", "X Y", "UNKNOWN", "UNKNOWN"]
    # An unlisted class reads as open although no open count includes it.
    assert apply(spark, rules.investigation_status, "X Y", "CONFIRMED", "DISCARDED", None) == [
        "OPEN", "CONCLUDED", "CONCLUDED", "OPEN"]


def test_lab_words_differ_between_lab_and_case_records(spark):
    words = ("present", "absent", "equivocal", "not_detected", "Positive / Detected", "nonreactive", "invalid", "", "odd")
    assert apply(spark, rules.lab_result_category, *words) == [
        "POSITIVE", "NEGATIVE", "INCONCLUSIVE", "OTHER", "OTHER", "OTHER", "INCONCLUSIVE", "UNKNOWN", "OTHER"]
    assert apply(spark, rules.case_result_category, *words) == [
        "OTHER", "OTHER", "OTHER", "NEGATIVE", "POSITIVE", "NEGATIVE", "INCONCLUSIVE", "UNKNOWN", "OTHER"]


@pytest.mark.parametrize("lab", ["POSITIVE", "NEGATIVE"])
def test_outcomes(spark, lab):
    words = ("Dead", "deceased /dead", "living", "Alive and Discharged", "hospitalised", "referred", "LTFU", " ", None, "moved")
    death = "ALIVE" if lab == "NEGATIVE" else None
    assert apply(spark, lambda c: rules.source_outcome(c, F.lit(lab)), *words) == [
        death, death, "ALIVE", "RECOVERED", "ON_TREATMENT", "TRANSFERRED", "LOST_TO_FOLLOW_UP", None, None, "MOVED"]


def test_death_needs_confirmation_and_a_positive_result(spark):
    rows = [(d, c, r) for d in (date(2024, 1, 1), None) for c in ("CONFIRMED", "SUSPECTED")
            for r in ("POSITIVE", "NEGATIVE", "UNKNOWN")]
    df = spark.createDataFrame(rows, "d date, c string, r string")
    got = [tuple(x) for x in df.select(
        rules.validated_death(F.col("d"), F.col("c"), F.col("r")),
        rules.outcome_validation(F.col("d"), F.col("c"), F.col("r"))).collect()]
    no_class = (0, "DEATH_DATE_WITHOUT_CONFIRMED_CLASSIFICATION")
    assert got == [(1, None), (0, "DEATH_DATE_WITH_NEGATIVE_LAB_RESULT"), (0, "DEATH_DATE_WITHOUT_POSITIVE_LAB_RESULT"),
                   no_class, no_class, no_class] + [(0, None)] * 6


def test_measures(spark):
    df = spark.createDataFrame([(1, 2), (None, 0), (3, None)], "a int, b int")
    got = [tuple(r) for r in df.select(
        measures.count_when(F.col("a") > 0), measures.count_when(F.lit(True), F.col("b")),
        measures.rate(F.col("a"), F.col("b"))).collect()]
    assert got == [(1, 2, 50.0), (0, 0, None), (1, 1, None)]
