"""Queries over tables of other file layouts and sizes than the benchmark's."""

import os
import uuid
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import table_queries
from table_queries import all_queries
from vigil.functions import temporal as tm
from vigil.plans import pipeline
from vigil.session import FREED, METHOD_LIMIT, STORED, shared_dir, small_methods
from vigil.sources import records

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Set SQL settings for the length of a test."""
    before = {}

    def put(name, value):
        before[name] = spark.conf.get(name)
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value)


def orders(n):
    return pa.table(
        {
            "o_orderkey": pa.array(range(n), pa.int64()),
            "o_custkey": pa.array([k % 7 for k in range(n)], pa.int64()),
            "o_orderstatus": ["F"] * n,
            "o_totalprice": [1.0] * n,
            "o_orderdate": pa.array([datetime(2024, 1, 1)] * n, pa.timestamp("us")),
            "o_orderpriority": ["1-URGENT"] * n,
        }
    )


def test_an_array_document_begins_once_where_the_first_partition_is_empty(spark, tmp_path, conf):
    """One row group, read by many tasks: only the task with its middle has rows."""
    pq.write_table(orders(3000), tmp_path / "orders.parquet")
    conf("spark.sql.files.maxPartitionBytes", "4000")
    conf("spark.sql.files.openCostInBytes", "1")
    table = spark.read.parquet(str(tmp_path / "orders.parquet"))
    assert 0 not in {r[0] for r in table.select(F.spark_partition_id()).distinct().collect()}
    found = all_queries()["ingest_array_document"](spark, str(tmp_path))
    assert sorted(r.order for r in found.collect()) == sorted(map(str, range(3000)))


def test_lines_left_unparsed_are_no_json(spark):
    """Lines of a document are told from records without an exception each, and only they are."""
    pieces = ["{", ' ,{ ', '"a" : 1,', ' "a": {', '"a":"b"', "},", "}", "} ],", "[ {", '"a" :', ":", ",", '"x" : [ "', "1,", '"a{']
    others = ['{"a":1}', "[1]", "]", "],", '1] , {', '"a"', "1", '{"a":1},{"b":2}', '"a]{', '"a\\" : 1"', " ", '["a":', "nul", "[]"]
    df = spark.createDataFrame([(x,) for x in pieces + others], "value string")
    parsed = F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))).isNotNull()
    got = {r.value: (r.piece, r.parses) for r in df.select("value", records._piece(F.col("value")).alias("piece"), parsed.alias("parses")).collect()}
    assert not [v for v, (piece, parses) in got.items() if piece and parses]
    assert not [v for v in pieces if v not in ('"x" : [ "', '"a{') and not got[v][0]]


def test_record_hashes_are_made_once(spark, tmp_path):
    """Neither side of the comparison parses the records again."""
    spark.sql("SELECT id AS event_id, id % 3 AS user_id, if(id % 4 = 0, 'view', 'click') AS event_type, 1.5D AS value FROM range(40)").write.parquet(str(tmp_path / "events.parquet"))
    found = all_queries()["record_hash_dedup"](spark, str(tmp_path))
    assert "parse_json" not in found._jdf.queryExecution().optimizedPlan().toString()
    # The repeat with other key order is left out, the other spelling of the number is not.
    assert sorted(r.id for r in found.collect()) == sorted(k + form * 10**12 for k in range(40) if k % 4 for form in (0, 2))


def test_a_landing_table_is_rendered_once(spark, monkeypatch):
    """Asking a feed for its partitions would run the shuffles below it before the write does."""
    if not os.path.isdir(SMALL):
        pytest.skip("benchmark tables not present")
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "rdd", property(lambda df: pytest.fail("the feed is run to count its partitions")))
    limits = []
    feed = table_queries.spark_feed

    def seen(*args):
        limits.append(spark.conf.get("spark.sql.shuffle.partitions"))
        return feed(*args)

    monkeypatch.setattr(table_queries, "spark_feed", seen)
    before = spark.conf.get(METHOD_LIMIT, None)
    root = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    rows = table_queries._landing(spark, SMALL, root, "lims_raw")
    assert rows.count() == feed(spark, SMALL, "lims_raw").count()
    assert len(limits) == 1 and spark.conf.get(METHOD_LIMIT, None) == before


def row_groups(folder):
    """Row groups of the fullest file below a folder."""
    return max(pq.ParquetFile(f).num_row_groups for f in Path(folder).rglob("*.parquet"))


def test_stored_tables_have_row_groups_that_splits_can_part(spark, monkeypatch, tmp_path):
    """One row group is read by one task, however small the file splits are."""
    if not os.path.isdir(SMALL):
        pytest.skip("benchmark tables not present")
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) >= int(STORED["parquet.block.size"])
    small = {"parquet.block.size": "65536"}
    monkeypatch.setattr(table_queries, "STORED", small)
    monkeypatch.setattr(pipeline, "STORED", small)
    texts = {c: F.sha2(F.concat(F.lit(c), F.col("id")), 256) for c in ("Facility Name", "Province", "County", "Sub County", "Ward")}
    seed = spark.range(0, 40000, 1, 1).select(F.col("id").alias("Code"), *(c.alias(name) for name, c in texts.items()))
    monkeypatch.setattr(table_queries, "spark_feed", lambda *args: seed)
    assert table_queries._landing(spark, SMALL, str(tmp_path / "landing"), "facility_seed").count() == 40000
    assert row_groups(tmp_path / "landing") > 1
    store = pipeline.Warehouse(spark, str(tmp_path / "store"), lambda name: seed)
    assert store._filled("dim_facilitylist").count() == 40000
    assert row_groups(tmp_path / "store") > 1


def test_a_store_keeps_no_shuffle_files(spark, tmp_path):
    """Else a chain of models holds the shuffles of all of them on disk."""
    cleaned, kind = [], {"Facility Name": "n", "Province": "p", "County": "c", "Sub County": "s", "Ward": "w"}
    seed = spark.range(20).select(F.col("id").alias("Code"), *(F.lit(v).alias(k) for k, v in kind.items()))

    def landing(name):
        cleaned.append(spark.conf.get(FREED))
        return seed

    store = pipeline.Warehouse(spark, str(tmp_path), landing)
    before = spark.conf.get(FREED)
    store._filled("dim_facilitylist")
    store.build(["dim_facilitylist"])
    assert cleaned and cleaned[0] == cleaned[-1] == "true" and spark.conf.get(FREED) == before == "false"
    (file, *_) = Path(store.path("dim_facilitylist")).glob("*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_wide_columns_are_not_one_method(spark):
    """HotSpot does not compile methods over 8000 bytes."""
    before = spark.conf.get(METHOD_LIMIT)
    with small_methods(spark):
        assert int(spark.conf.get(METHOD_LIMIT)) <= 8000
    assert spark.conf.get(METHOD_LIMIT) == before


def test_dates_are_cast_and_equal_the_pattern(spark):
    """A cast is several times faster than a pattern, and takes the same days."""
    years, months, days = ("0000", "0001", "1582", "1900", "2000", "2023", "2024", "9999"), range(14), range(33)
    iso = [(f"{y}-{m:02d}-{d:02d}",) for y in years for m in months for d in days]
    dmy = [(f" {d:02d}/{m:02d}/{y}",) for y in years for m in months for d in days]
    df = spark.createDataFrame([*iso, *dmy, ("1/2/2024",), (None,)], "c string")
    text = F.trim("c")
    pattern = F.when(text.rlike(tm.ISO_DATE), F.try_to_date(text, "yyyy-MM-dd")).when(
        text.rlike(tm.DMY_DATE), F.try_to_date(text, "dd/MM/yyyy")
    )
    found = df.select(tm.safe_date(F.col("c")).alias("d"), tm.safe_timestamp(F.col("c")).alias("t"), pattern.alias("p"))
    assert found.filter("NOT (d <=> p AND t <=> CAST(p AS TIMESTAMP))").isEmpty()
    assert "gettimestamp" not in found.select("d", "t")._jdf.queryExecution().optimizedPlan().toString()
