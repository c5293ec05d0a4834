"""Documents cut into records wherever Spark's blocks and batches fall."""

import gzip
import json
import random

import pytest

from vigil.sources import files as fs, records as rec
from vigil.sources.records import MalformedJson, open_records

TRICKY = [
    {"a": 1, "b": [1, 2, {"c": "},{"}]}, {"s": 'quote " and \\ and \\" {', "t": "[{]}"}, {}, {"x": None, "é": "中😀, {"},
    {"deep": {"deep": {"deep": [[[{"y": "\\\\"}]]]}}}, {"n": 1.0}, {"comma": ",,,", "open": "{{{"},
]


def read(spark, path):
    with open_records(spark, fs.list_files(spark, str(path))) as records:
        rows = records.selectExpr("to_json(record) as r", "seq", "block_start", "file_path").collect()
    rows.sort(key=lambda r: (r.file_path, r.block_start, r.seq))
    return rows


@pytest.fixture(params=[None, "40b"])
def block(spark, request):
    """Blocks of a few bytes cut records, strings and escapes anywhere."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch"]
    before = [spark.conf.get(n) for n in names]
    if request.param:
        for name, value in zip(names, (request.param, "1", "3")):
            spark.conf.set(name, value)
    yield request.param
    for name, value in zip(names, before):
        spark.conf.set(name, value)


@pytest.mark.parametrize("indent", [None, 1])
def test_records_of_an_array_in_order(spark, tmp_path, monkeypatch, block, indent):
    monkeypatch.setattr(rec, "LINE_BYTES", 100)  # else an array of one line is a line
    rng = random.Random(1)
    records = [rng.choice(TRICKY) | {"i": i} for i in range(60)]
    (tmp_path / "a.json").write_text(" \n" + json.dumps(records, indent=indent, ensure_ascii=False) + "\n\n")
    rows = read(spark, tmp_path)
    assert [json.loads(r.r) for r in rows] == records
    assert [r.seq for r in rows] == list(range(60)) and {r.block_start for r in rows} == {0}


def test_files_of_every_form_beside_each_other(spark, tmp_path, block):
    long = [{"i": i, "t": TRICKY[i % 7]} for i in range(30)]
    (tmp_path / "1.json").write_text(json.dumps(long, indent=2))
    (tmp_path / "2.json").write_text("\r\n".join(map(json.dumps, TRICKY)) + "\r\n\r\n")
    (tmp_path / "3.json").write_text(json.dumps({"one": long, "k,": "{"}, indent=4))
    (tmp_path / "4.json").write_text("[\n]")
    (tmp_path / "5.json").write_text(" \n\n \n")
    (tmp_path / "6.json.gz").write_bytes(gzip.compress(json.dumps(long, indent=1).encode()))
    (tmp_path / "7.json").write_bytes(gzip.compress(json.dumps(long, indent=1).encode()) + gzip.compress(b"\n"))
    (tmp_path / "8.json").write_text("[{}]")
    (tmp_path / "9.gz").write_text(json.dumps(TRICKY))
    got = {}
    for r in read(spark, tmp_path):
        got.setdefault(r.file_path[-10:].split("/")[-1], []).append(json.loads(r.r))
    assert got == {"1.json": long, "2.json": TRICKY, "3.json": [{"one": long, "k,": "{"}], "6.json.gz": long, "7.json": long, "8.json": [{}], "9.gz": TRICKY}


BROKEN = [
    '[\n{"a": 1},\n{"b": 2}', '[\n{"a": 1}\n{"b": 2}]', '[\n{"a": 1},,\n{"b": 2}]', '[\n{"a": 1},\n]', '{"a":\n1}\n{"b":\n2}', '[\n{}]\n]', '[\n{}]\nx', 'x\n[{}]',
    '[\n{"a": "unended}]', '{"a":\n{"b": 1}', '[\n{"a": 1}}', '[\n,{"a": 1}]', '[\n{"a": 01}]', '[\n{"a": 1}]\n[\n{"b": 1}]',
]


def test_broken_documents_are_named(spark, tmp_path, block):
    (tmp_path / "good.json").write_text(json.dumps(TRICKY, indent=1))
    for i, text in enumerate(BROKEN):
        (tmp_path / f"bad{i:02}.json").write_text(text)
    with pytest.raises(MalformedJson) as problem:
        read(spark, tmp_path)
    assert sorted(p.split("/")[-1] for p in problem.value.paths) == [f"bad{i:02}.json" for i in range(len(BROKEN))]


def test_a_large_array_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """No line, piece or task holds the array, whose one line is left unread by line."""
    monkeypatch.setattr(rec, "LINE_BYTES", 1 << 20)
    text = json.dumps([{"i": i, "text": f"{i} {{" * 20} for i in range(40_000)])
    (tmp_path / "a.json").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        with open_records(spark, fs.list_files(spark, str(tmp_path))) as records:
            assert records.selectExpr("count(*)", "sum(variant_get(record, '$.i', 'bigint'))", "max(seq)").first() == (40_000, 40_000 * 39_999 // 2, 39_999)
            assert records.select("seq").rdd.getNumPartitions() > len(text) / (1 << 20)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
