"""Landing rows through every layer, with results worked out by hand."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vigil.operators import dedup
from vigil.operators.lookup import RepeatedKey
from vigil.plans import summaries
from vigil.plans import silver
from vigil.plans.pipeline import MODELS, Settings, Warehouse
from vigil.sources.landing import LandingTable
from vigil.sources.seeds import facility_list
from vigil.sources.specs import source_for
from vigil.streaming.ingest import ingest


def case(key, **extra):
    return {
        "_id": key, "name": "N " + key, "sex": "m", "date_of_birth": "1990-02-28", "nationality": "KE",
        "identifier": "P" + key, "type": "case", "initial_classification": "suspected", "outcome": "",
        "samples_collected": "Yes", "specimen_id": "S" + key, "final_laboratory_results": "positive",
        "reporting_county": "Busia", "reporting_subcounty": "Teso", "health_facility": "HF",
        "date_of_investigation": "2024-02-28", "created_timestamp": "2024-02-29T10:00:00",
        "latitude": "-1.28", "longitude": "36.8", "vhf_disease": "D", "date_of_death": "",
        "final_classification": "confirmed", "checked_by": "U", **extra,
    }


CASES = [
    case("1"),
    case("1", outcome="Dead", date_of_death="2024-03-02", name="newer"),  # same id, later row wins
    case("2", type="Contact", date_of_investigation="", final_classification="negative"),
    case("3", outcome="died", final_laboratory_results="negative", date_of_death="01/03/2024"),
    case("4", initial_classification="", final_classification="", date_of_birth="2030-01-01", latitude="91"),
    case("5", type=" ", outcome="recovered"),
    case("6", date_of_investigation="2019-12-31", outcome="Referred", final_classification="odd"),
]
TRAVELLERS = [
    {"_id": "t1", "classification": "suspected", "screened": True, "point_of_entry": " Busia ",
     "created_timestamp": "2026-07-14T23:09:38.031000+00", "identifier": "A", "name": "x", "sex": "f",
     "date_of_birth": "01/02/1980", "nationality": "UG", "latitude": "0.5", "longitude": "34"},
    {"_id": "t2", "classification": "", "screened": False, "point_of_entry": "BUSIA",
     "created_timestamp": "2026-07-14T08:00:00+00", "identifier": "B"},
    {"_id": "t3", "classification": "Other", "screened": True, "point_of_entry": "",
     "created_timestamp": "junk", "identifier": "C"},
    {"_id": "t4", "classification": "probable", "point_of_entry": "Unknown",
     "created_timestamp": "2026-07-16T08:00:00+00"},
]
LABS = [
    {"identifier": "L1", "specimen_identifier": "S1", "order_identifier": "O1", "specimen_type": "Blood",
     "collect_date": "2026-01-03", "performer_mfl": " 101 ", "effective_date_time": "2026-01-04 06:00:00", "code": "C-1",
     "test_name": "PCR", "code_text": "pcr text", "component_code": "k", "unit": "u", "conclusion": "Detected",
     "value_code": "", "reference_range_low": "1.5", "reference_range_high": "x", "case_identifier": "1", "_id": "r1",
     "subject_identifier": "p", "testing_lab_code": "LAB1", "testing_lab_name": "Central", "dlt_load_id": "1", "dlt_id": "a"},
    {"identifier": "L2", "collect_date": "2026-01-10", "performer_mfl": "999", "effective_date_time": "2026-01-03",
     "code": "c-1", "component_code": "other", "conclusion": "", "value_code": "non reactive", "_id": "r2",
     "testing_lab_code": "", "testing_lab_name": "CENTRAL"},
    {"identifier": "L3", "collect_date": "", "effective_date_time": "03/01/2026", "test_name": "pcr", "conclusion": "odd", "_id": "r2"},
    {"identifier": "L4", "code_text": "Pcr Text", "conclusion": " "},
]
BORDER = [{"system_id": "x", "sex": "m", "point_of_entry": "Busia ", "date_of_birth": "bad", "created_at": "2026-01-01 01:02:03",
           "identifier": "i", "facility_fid": "f", "reporting_sub_county": "s"}]
FEEDS = {"adam_cases_raw": CASES, "adam_travellers_raw": TRAVELLERS, "lims_raw": LABS, "uhai_raw": BORDER}


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("house")
    tables = {}
    for table, records in FEEDS.items():
        spec = source_for(table)
        folder = root / "raw" / spec.base / spec.folder
        folder.mkdir(parents=True)
        (folder / "a.json").write_text("\n".join(map(json.dumps, records)))
        ingest(spark, spec, f"{root}/raw", f"{root}/landing", f"{root}/ckpt")
        tables[table] = LandingTable(spark, f"{root}/landing", table)
    seed = root / "facilities.csv"
    seed.write_text("Code,Facility Name,Province,County,Sub County,Ward\n101, Kanduyi ,West,Bungoma ,S,W\n,gone,,,,\n")
    landing = lambda name: facility_list(spark, str(seed)) if name == "facility_seed" else tables[name].read()
    store = Warehouse(spark, f"{root}/store", landing, Settings(as_of=date(2026, 1, 5)))
    store.build()
    return store


def by(house, model, key):
    return {r[key]: r for r in house.table(model).collect()}


def test_every_model_is_stored(house, spark):
    for layer, name, _ in MODELS:
        assert house.path(name).endswith(f"{layer}/{name}")
        spark.read.parquet(house.path(name)).count()


def test_cases(house):
    rows = by(house, "slv_adam_cases", "id_field")
    assert sorted(rows) == list("123456") and rows["1"].name == "newer" and rows["4"].latitude is None
    assert rows["3"].date_of_death == date(2024, 3, 1) and rows["5"].type is None
    facts = by(house, "fct_case_investigation", "source_record_id")
    assert sorted(facts) == list("1346")
    assert facts["1"].investigation_date_key == 20240228 and facts["1"].date_of_birth_key == -1
    assert facts["6"].investigation_date_key == -1
    report = by(house, "report_case_investigation", "source_record_id")
    one = report["1"]
    assert (one.age_at_investigation, one.reporting_age_group) == (34, "25-34")
    assert (one.reporting_epi_week_label, one.reporting_month_name) == ("2024-W09", "February ")
    assert (one.final_confirmed_count, one.initial_suspected_count, one.sample_collected_count) == (1, 1, 1)
    four = report["4"]
    assert (four.reporting_age_group, four.age_at_investigation) == ("INVALID", None)
    assert (four.reporting_case_classification, four.open_investigation_count) == ("UNKNOWN", 1)
    six = report["6"]
    assert (six.investigation_status, six.open_investigation_count) == ("OPEN", 0)
    assert six.reporting_date is None and six.reporting_epi_week is None


def test_contacts(house):
    (row,) = house.table("report_contact_registration").collect()
    assert row.registration_date == date(2024, 2, 29) and row.final_classification == "DISCARDED"
    assert (row.age_at_registration, row.reporting_age_group) == (34, "25-34")
    assert (row.reporting_epi_week_label, row.reporting_year_month) == ("2024-W09", "2024-02")
    assert row.total_contact_registration_count == row.sampled_contact_count == 1


def test_outcomes(house):
    rows = by(house, "report_treatment_outcome", "source_record_id")
    assert sorted(rows) == ["1", "3", "6"]
    assert (rows["1"].treatment_outcome, rows["1"].source_outcome) == ("DECEASED", None)
    assert rows["1"].reporting_date == date(2024, 3, 2)
    assert (rows["3"].treatment_outcome, rows["3"].outcome_validation_status) == (
        "ALIVE", "DEATH_DATE_WITH_NEGATIVE_LAB_RESULT")
    assert rows["3"].reporting_date == date(2024, 2, 29)
    assert rows["6"].treatment_outcome == "TRANSFERRED" and rows["6"].final_classification == "ODD"


def test_screenings(house):
    rows = by(house, "report_screening", "source_record_id")
    one = rows["t1"]
    assert (one.screening_date, one.reporting_point_of_entry) == (date(2026, 7, 15), "BUSIA")
    assert (one.reporting_screening_category, one.flagged_flag) == ("SUSPECTED", 1)
    assert rows["t2"].reporting_screening_category == "NORMAL"
    three = rows["t3"]
    assert (three.screening_date_key, three.reporting_point_of_entry) == (-1, "Unknown")
    assert (three.reporting_screening_category, three.unknown_screening_count) == ("OTHER", 1)
    # A place named like the default member does not double the row.
    assert house.table("fct_screening").count() == 4
    assert rows["t4"].reporting_point_of_entry == "Unknown"
    assert [r.screened for r in house.table("slv_adam_travellers").orderBy("id_field").collect()] == [True, False, True, None]
    assert {r.point_of_entry for r in house.table("dim_location").collect()} == {"Busia", "BUSIA", "Unknown"}
    status = {r.timestamp_pattern_status for r in house.table("slv_test_time").collect()}
    assert status == {"ISO_TIMESTAMP_MATCH", "NO_PATTERN_MATCH"}


def test_labs(house):
    rows = {r.source_row_id: r for r in house.table("report_lab_result").collect()}
    one, two, three, four = (rows[i] for i in sorted(rows))
    assert (one.result_category, one.requesting_facility_key, one.reporting_testing_laboratory_code) == (
        "POSITIVE", "101", "LAB1")
    assert (one.turnaround_time_days, one.turnaround_time_hours, one.turnaround_time_band) == (1, Decimal("30.00"), "1 DAY")
    assert (one.reporting_collection_epi_week_label, one.reporting_result_epi_week_label) == ("2026-W01", "2026-W02")
    assert one.reporting_current_epi_week_flag is True and one.reference_range_low == Decimal("1.5")
    assert (two.turnaround_time_band, two.turnaround_time_days, two.result_category) == ("INVALID", None, "NEGATIVE")
    assert two.testing_laboratory_key is not None and two.requesting_facility_key is None
    # Found by name, then by description; the last has nothing else.
    assert three.lab_test_key is not None and three.turnaround_time_band == "UNKNOWN"
    assert four.lab_test_key == one.lab_test_key and four.result_category == "UNKNOWN"
    # Rows are kept apart by identifier but keyed by id: the fact key repeats, and we report it.
    assert two.lab_result_key == three.lab_result_key


def test_dimensions(house):
    (facility,) = house.table("dim_facilitylist").collect()
    assert (facility.mfl_code, facility.facility_name, facility.county) == ("101", "Kanduyi", "Bungoma")
    places = house.table("dim_point_of_entry").collect()
    assert sorted((p.point_of_entry, p.source_system) for p in places) == [
        ("BUSIA", "ADAM"), ("Unknown", "ADAM"), ("Unknown", "SYSTEM")]
    border = house.table("slv_uhai_cases").first()
    assert border.date_of_birth is None and border.created_at == datetime(2026, 1, 1, 1, 2, 3) and border.sex == "M"


def test_summaries(house):
    trend = house.table("report_case_trend").filter("record_type = 'case'").orderBy("start_of_week").collect()
    # All four dated cases, also the one of 2019, before the calendar starts.
    assert sum(r.total_cases for r in trend) == 4 and sum(r.deaths for r in trend) == 1
    assert trend[0].start_of_week == date(2019, 12, 29) and trend[0].total_cases == 1
    summary = house.table("report_screening_summary")
    assert summary.filter("source_system = 'ADAM'").agg(F.sum("total_screened")).first()[0] == 2
    border = house.table("slv_uhai_cases").count()
    assert summary.filter("source_system = 'UHAI'").agg(F.sum("total_screening_records")).first()[0] == border > 0
    whole = house.table("report_case_distribution").agg(F.sum("total_cases"), F.sum("deaths")).first()
    assert tuple(whole) == (5, 1)
    labs = house.table("report_laboratory_summary").agg(F.sum("total_tests")).first()
    assert labs[0] == 4
    geo = house.table("report_geographic_summary").agg(
        F.sum("total_cases"), F.sum("total_screening_records"), F.sum("laboratory_tests")).first()
    assert tuple(geo) == (4, 4 + border, 4)


def test_screenings_of_the_second_system(spark):
    columns = "screening, suspected, confirmed, tested, result, facility_id, point_of_entry, reporting_date"
    rows = [
        ("done", "yes", "Yes", "y", "POS", "101", " Busia ", date(2024, 2, 29)), ("done", "yes", "no", "yes", "neg", "101", "Busia", date(2024, 2, 29)),
        ("No", "", "", "", None, "7", " ", date(2024, 2, 29)), (None, None, None, None, None, None, None, None),
    ]
    kinds = ", ".join(f"{c} {'date' if c.endswith('date') else 'string'}" for c in columns.split(", "))
    border = spark.createDataFrame(rows, kinds).withColumns(
        {c: F.lit("x") for c in ("reporting_county", "reporting_subcounty", "ward")})
    facilities = spark.createDataFrame([("101", "Kanduyi")], "facility_key string, facility_name string")
    found = summaries.border_screenings(border, facilities).orderBy(F.desc("confirmed"), F.desc("suspected"), F.desc("point_of_entry"), "mfl_code")
    names = ["classification", "screened", "suspected", "confirmed", "tested", "test_result", "facility_name", "point_of_entry", "start_of_week"]
    week = date(2024, 2, 25)
    assert sorted((tuple(r) for r in found.select(names).collect()), key=str) == sorted([
        ("CONFIRMED", 1, 1, 1, 1, "POS", "Kanduyi", "Busia", week), ("SUSPECTED", 1, 1, 0, 1, "neg", "Kanduyi", "Busia", week),
        ("NORMAL", 0, 0, 0, 0, None, None, "Unknown", week), ("NORMAL", 0, 0, 0, 0, None, None, "Unknown", None)], key=str)


def test_rebuild_gives_the_same_rows(house):
    before = {n: house.table(n).count() for _, n, _ in MODELS}
    house.build(["slv_lims_results", "dim_labtest", "fct_lab_result", "report_lab_result"])
    assert {n: house.table(n).count() for n in before} == before


def test_a_plan_writes_nothing_and_a_full_store_is_used_as_it_is(house, spark, tmp_path):
    empty = Warehouse(spark, str(tmp_path / "none"), house.landing, house.settings)
    assert empty.plan("report_case_trend").count() == house.table("report_case_trend").count()
    assert empty.table("fct_screening").count() == 4 and not (tmp_path / "none").exists()
    stored = {n: house.path(n) for _, n, _ in MODELS}
    again = Warehouse(spark, house.root, house.landing, house.settings)
    assert again.table("fct_screening").count() == 4 and again.prepared("report_case_trend").count()
    assert {n: again.path(n) for n in stored} == stored


def test_a_build_that_fails_leaves_the_old_table(house, spark):
    old = house.path("slv_lims_results")
    rows = house.table("slv_lims_results").count()
    broken = lambda name: house.landing(name).withColumn("id", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        Warehouse(spark, house.root, broken, house.settings).build(["slv_lims_results"])
    assert house.path("slv_lims_results") == old and house.table("slv_lims_results").count() == rows
    for _ in range(3):
        house.build(["slv_lims_results"])
    assert house.path("slv_lims_results") != old and house.table("slv_lims_results").count() == rows
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(old)


def test_facts_and_reports_add_no_shuffle_of_the_fact(house):
    """Dimensions are small here, so every lookup is a broadcast and rows stay in place."""
    for name in ("fct_case_investigation", "fct_screening", "report_screening", "report_lab_result"):
        plan = house.plan(name)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_scan_reads_only_the_needed_columns(house):
    plan = house.table("report_lab_result").groupBy("result_category").agg(F.sum("total_test_count"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<result_category:string,total_test_count:int>" in text


def test_landing_columns_no_file_has_brought_read_as_null(spark):
    raw = spark.sql(
        "select 1L id, now() _ingested_at, 's' _source, 'b' _batch_id, 'f' _source_file, false _processed, 'k' id_field, 'case' type"
    )
    row = silver.cases(raw).first()
    assert (row.id_field, row.type, row.outcome, row.latitude, row.sex) == ("k", "case", None, None, None)


def test_a_dimension_with_a_repeated_key_fails_the_build_by_name(house, spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w"), house.landing, house.settings)
    store.build(["fct_lab_result"])
    kept = store.path("fct_lab_result")
    dates = store.table("dim_date")
    twice = tmp_path / "twice"
    dates.union(dates).write.parquet(str(twice))
    read = store._refreshed
    store._refreshed = lambda name: spark.read.parquet(str(twice)) if name == "dim_date" else read(name)
    with pytest.raises(RepeatedKey, match="fct_lab_result, lookup by full_date: 4 rows became"):
        store.build(["fct_lab_result"])
    assert store.path("fct_lab_result") == kept and store.table("fct_lab_result").count() == 4
    plan = store.plan("fct_lab_result")._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" not in plan


def test_laboratory_summary_shuffles_only_what_tells_groups_apart(spark):
    """Of weeks and months their first days move; the other columns are made after the sums."""
    days = ["2020-12-26", "2020-12-27", "2020-12-31", "2021-01-01", "2021-01-02", "2021-01-03", "2024-02-29", "2024-03-01", None]
    text = ("source_system", "specimen_type", "test_code", "test_name", "test_code_text", "component_code", "result_unit", "result_category")
    counts = ("total_test_count", "positive_test_count", "negative_test_count", "inconclusive_test_count", "unknown_result_count", "other_result_count")
    n = len(days)
    labs = spark.createDataFrame([(d, i % 3) for i, d in enumerate(days * 3)], "d string, k int").select(
        F.when(F.col("k") == 0, F.to_date("d")).alias("reporting_result_date"), F.to_date("d").alias("reporting_collection_date"),
        F.when(F.col("k") < 2, F.col("k").cast("string")).alias("requesting_facility_key"), F.lit("m").alias("reporting_requesting_facility_mfl"),
        *(F.lit("x").alias(c) for c in text), *(F.lit(1).alias(c) for c in counts),
    )
    places = spark.createDataFrame([("0", "C", "S", "F"), ("1", "C", "S", "F")], "facility_key string, county string, subcounty string, facility_name string")
    found = summaries.laboratory_summary(labs, places)
    day = F.coalesce("reporting_result_date", "reporting_collection_date")
    dated = summaries._with_epi_week(labs.withColumn("day", day), "day")
    placed = dated.join(places, F.col("requesting_facility_key") == F.col("facility_key"), "left")
    by = [*summaries.WEEK, F.year("day"), F.month("day"), F.date_format("day", "MMMM"), "county", "subcounty", "facility_name"]
    plain = [tuple(r) for r in placed.groupBy(*by).agg(F.count("*")).collect()]
    columns = [*summaries.WEEK, "result_year", "result_month_number", "result_month_name", "county", "subcounty", "facility_name", "total_tests"]
    assert sorted(map(str, plain)) == sorted(str(tuple(r)) for r in found.select(columns).collect())
    assert found.columns[:13] == [*columns[:9], "county", "subcounty", "mfl_code", "facility_name"] and sum(r[-1] for r in plain) == 3 * n
    plan = found._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("county" in line for line in moved) and not any("epi_week" in line or "end_of_week" in line for line in moved)


@pytest.mark.parametrize(
    "build, columns, keys",
    [(silver.lab_results, silver.LAB_COLUMNS, ("identifier", "specimen_identifier", "order_identifier", "id_field")),
     (silver.cases, silver.CASE_COLUMNS, ("id_field",)), (silver.travellers, silver.TRAVELLER_COLUMNS, ("id_field", "identifier"))],
)
def test_latest_records_of_stored_landing_tables_are_found_without_moving_them(spark, tmp_path, monkeypatch, build, columns, keys):
    """Wide landing rows go to their entity in one scan, and are the rows that ranking them whole gives."""
    n = F.col("id")
    given = {c: F.when(n % (i + 2) > 0, F.concat(F.lit(f" {c} "), (n * 31 % 700).cast("string"))) for i, c in enumerate(keys)}
    texts = {c: F.concat(F.lit(f"{c} "), (n % 97).cast("string")) for c in columns if c not in ("id", "_ingested_at", "_processed")}
    raw = spark.range(0, 6000, 1, 3).withColumns(
        {**texts, **given, "_ingested_at": F.when(n % 9 > 0, F.timestamp_seconds(n * 7919 % 500)), "_processed": n % 2 == 0})
    raw.write.option("parquet.block.size", "65536").parquet(str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    whole = build(landed)
    monkeypatch.setattr(dedup, "APART_BYTES", 0)
    apart = build(landed)
    found = sorted(str(tuple(r)) for r in apart.collect())
    assert apart.schema == whole.schema and 700 <= len(found) < 6000
    assert found == sorted(str(tuple(r)) for r in whole.collect())
    plan = apart._jdf.queryExecution().executedPlan().toString()
    ranked = plan[plan.index("WindowGroupLimit"):]
    assert "Exchange hashpartitioning(__key" in ranked and "_source_file" not in ranked[:ranked.index("FileScan")]
