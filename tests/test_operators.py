from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vigil.operators import calendar as cal, conform, dedup, lookup, rollup


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key(spark):
    t = [datetime(2024, 1, d) for d in (1, 2)]
    df = spark.createDataFrame(
        [(1, "a", t[0]), (2, "a", t[1]), (3, "a", t[1]), (4, "a", None), (5, None, t[0]), (6, None, t[1]), (7, "b", None)],
        "id bigint, k string, at timestamp",
    )
    key = F.coalesce("k", F.concat(F.lit("row "), F.col("id").cast("string")))
    assert [r[0] for r in rows(dedup.latest_per_key(df, key, "at", "id"), "id")] == [3, 5, 6, 7]


def test_dedup_prunes_before_the_shuffle(spark):
    """A key with a third of the rows leaves one row per map task."""
    df = spark.range(0, 30000, 1, 4).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds("id").alias("at"),
    )
    latest = dedup.latest_per_key(df, F.col("k"), "at", "id")
    plan = plan_of(latest)
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert latest.count() == 20001
    assert latest.filter("k = 0").first().id == 29997
    plan = plan_of(dedup.first_per_key(df, "k", "id"))
    assert "Partial" in plan[plan.index("Exchange"):]


def test_wide_rows_of_stored_tables_are_not_shuffled_to_be_ranked(spark, tmp_path, monkeypatch):
    """Ranking them by what ranks them and their places keeps the same rows."""
    wide = {f"c{i}": F.concat(F.lit(f"value {i} of "), "id") for i in range(12)}
    df = spark.range(0, 30000, 1, 3).select(
        "id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") * 37 % 9000)).alias("k"),
        F.when(F.col("id") % 5 > 0, F.timestamp_seconds(F.col("id") * 7919 % 1000)).alias("at"), *(c.alias(n) for n, c in wide.items()),
    )
    df.write.option("parquet.block.size", "65536").parquet(str(tmp_path / "t"))
    df.limit(0).write.mode("append").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).filter("id % 11 > 0").withColumn("c3", F.upper("c3"))
    key = F.coalesce("k", F.lit("none"))
    whole = dedup.latest_per_key(stored, key, "at", "id")
    assert "hashpartitioning(__key" in plan_of(whole) and "row_index" not in plan_of(whole)
    monkeypatch.setattr(dedup, "APART_BYTES", 0)
    apart = dedup.latest_per_key(stored, key, "at", "id")
    plan = apart._jdf.queryExecution().executedPlan().toString()
    assert "row_index" in plan and "Partial" in plan  # one row of a key per task, as before
    moved = [line for line in plan.splitlines() if " Exchange hashpartitioning" in line]
    wide_sorts = [line for line in plan.splitlines() if " Sort [" in line and "c3" in line]
    assert moved and not wide_sorts and "WindowGroupLimit" in plan
    assert apart.columns == whole.columns and 3000 < whole.count() == apart.count()
    assert rows(apart, "id") == rows(whole, "id")
    # What is no stored table, or may hold a file's row twice, is ranked whole.
    for other in (df, stored.union(stored), stored.join(spark.range(2).toDF("n")), stored.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))):
        assert dedup._placed(other) is None
    assert rows(dedup.latest_per_key(stored.filter("id < 0"), key, "at", "id"), "id") == []


def test_representative_row(spark):
    df = spark.createDataFrame(
        [("AB", None, "x"), ("ab", None, "a"), ("Ab", "", None), ("ab", "q", None), ("AB", "Q", None), ("AB", "Q", None)],
        "a string, b string, note string",
    )
    order = [F.col(c).asc_nulls_last() for c in ("note", "a", "b")]
    assert rows(dedup.representative_row(df, ["a", "b"], order), "a") == [("AB", "Q", None), ("ab", None, "a")]


def test_unseen(spark):
    new = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, "z")], "id bigint, h string")
    stored = spark.createDataFrame([("y",), ("w",)], "h string")
    assert rows(dedup.unseen(new, "h", "id", stored), "id") == [(1, "x"), (4, "z")]
    assert rows(dedup.unseen(new, "h", "id", None), "id") == [(1, "x"), (2, "y"), (4, "z")]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(dedup.duplicate_keys(df, "k"), "k") == [("a", 2)]


def test_calendar(spark):
    assert cal.date_spine(spark, cal.SPINE_START, cal.SPINE_END).count() == 5843
    assert cal.date_spine(spark, cal.SPINE_START, cal.SPINE_END, include_end=True).count() == 5844
    day = cal.date_attributes(cal.date_spine(spark, date(2024, 2, 29), date(2024, 3, 1))).first()
    assert (day.date_key, day.quarter, day.month_name, day.month_short) == (20240229, 1, "February ", "Feb")
    assert (day.day_of_year, day.week_of_year, day.day_of_week, day.day_name) == (60, 9, 4, "Thursday ")
    assert (day.is_weekend, day.year_quarter, day.year_month) == (False, "2024-Q1", "2024-02")


def test_epi_weeks(spark):
    days = cal.date_attributes(cal.date_spine(spark, cal.SPINE_START, cal.SPINE_END))
    weeks = cal.epi_weeks(days, date(2025, 12, 30))
    assert weeks.count() == 836 + 1
    assert weeks.select("epi_year", "week_number").distinct().count() == 837
    now = weeks.filter("current_epi_week_flag").first()
    assert (now.epi_week_label, now.start_of_week, now.end_of_week) == ("2026-W01", date(2025, 12, 28), date(2026, 1, 3))
    assert (now.start_week_day_name, now.end_week_day_name, now.current_epi_year_flag) == ("Sunday", "Saturday", False)
    unset = weeks.filter("epi_week_key = 'unset'").first()
    assert (unset.start_of_week, unset.week_number, unset.load_date) == (date(1900, 1, 1), -999, date(2025, 12, 30))
    joined = lookup.enclosing_week(
        days, weeks, F.col("full_date"), {"start_of_week": "start_of_week", "end_of_week": "end_of_week"}
    )
    assert joined.count() == 5843
    assert joined.filter("not full_date between start_of_week and end_of_week").count() == 0
    assert "NestedLoop" not in plan_of(joined)


def test_date_keys_default_outside_the_calendar(spark):
    days = cal.date_attributes(cal.date_spine(spark, date(2024, 1, 1), date(2024, 1, 3)))
    df = spark.createDataFrame([(date(2024, 1, 2), date(2019, 1, 1)), (None, date(2024, 1, 1))], "a date, b date")
    keyed = lookup.date_keys(df, days, {"ka": F.col("a"), "kb": F.col("b")})
    assert rows(keyed.select("ka", "kb"), "ka") == [(-1, 20240101), (20240102, -1)]


@pytest.mark.parametrize("direct", [True, False])
def test_cascade(spark, direct):
    dim = spark.createDataFrame(
        [("k1", "A", "c1", "alpha", None), ("k2", "a", None, "beta", "text b"), ("k0", "B", "c1", "Alpha", "text a"),
         ("k9", None, None, None, "only text")],
        "key string, code string, part string, name string, note string",
    )
    df = spark.createDataFrame(
        [(1, " a ", "C1", None, None), (2, "A", "zz", "alpha", None), (3, "q", None, "ALPHA", None), (4, None, None, " ", "Text B"),
         (5, None, None, None, None), (6, "q", "c1", "q", "q"), (7, " a ", "C1", None, None)],
        "id int, code string, part string, name string, note string",
    )
    steps = [{"code": "code", "part": "part"}, {"code": "code"}, {"name": "name"}, {"note": "note"}]
    found = lookup.cascade(df, dim, "key", steps, "found", direct=direct)
    assert rows(found.select("id", "found"), "id") == [
        (1, "k1"), (2, "k1"), (3, "k0"), (4, "k2"), (5, None), (6, None), (7, "k1")]
    assert found.columns == df.columns + ["found"]


def test_cascade_size_check(spark):
    small = spark.range(10).select(F.col("id").cast("string").alias("key"))
    assert lookup.fits_broadcast(small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not lookup.fits_broadcast(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookups_keep_rows_without_broadcast_and_with_a_hot_key(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
        dim = df.select("k", F.upper("k").alias("v")).distinct().filter("k <> '4'")
        out = lookup.attributes(df, dim, F.col("k"), {"v": "v"}, "k")
        assert "SortMergeJoin" in plan_of(out)
        assert out.count() == 30000 and out.filter("v is null").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_not_in(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(lookup.not_in(a, a.filter("k = 1"), "k"), "k") == [(2, "b")]


def test_conformed_union_checks_columns_and_types(spark):
    a, b = spark.sql("select 1 x, 'a' y"), spark.sql("select 'b' y, 2 x")
    assert rows(conform.conformed_union([a, b]), "x") == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="x"):
        conform.conformed_union([a, spark.sql("select 'c' y, 2L x")])
    with pytest.raises(ValueError, match="z"):
        conform.conformed_union([a, b.withColumn("z", F.lit(1))])


def test_canonical_spelling_uses_byte_order(spark):
    df = spark.createDataFrame([("post a",), (" Post A ",), ("POST a",), (" ",), (None,), ("é",)], "p string")
    assert rows(conform.canonical_spelling(df, "p"), "p") == [("post a", "POST a"), ("é", "é")]


def test_zero_filled_union(spark):
    a, b = spark.sql("select 'd' day, 1L x"), spark.sql("select 'd' day, 2L y")
    assert rows(conform.zero_filled_union([a, b], ["x", "y"]).select("x", "y"), "x") == [(0, 2), (1, 0)]


def test_trends(spark):
    weekly = spark.createDataFrame(
        [("p", 2024, w, n) for w, n in ((50, 4), (51, 0), (52, 6))] + [("p", 2025, 1, 10), ("q", 2025, 1, 5)],
        "g string, y int, w int, n bigint",
    )
    ytd = rollup.year_to_date(weekly, ["g"], "y", "w", {"c": "n"})
    assert [r.c for r in ytd.orderBy("g", "y", "w").collect()] == [4, 4, 10, 10, 5]
    mean = rollup.moving_average(weekly, ["g"], ["y", "w"], "n", 4, "m")
    assert [r.m for r in mean.orderBy("g", "y", "w").collect()] == [4.0, 2.0, 3.33, 5.0, 5.0]
    change = rollup.change_from_previous(weekly, ["g"], ["y", "w"], "n", ("b", "c", "p"))
    assert [(r.b, r.c, r.p) for r in change.orderBy("g", "y", "w").collect()] == [
        (None, None, None), (4, -4, -100.0), (0, 6, None), (6, 4, 66.67), (None, None, None)]
