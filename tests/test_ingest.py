import gzip
import json
import os
import time

import pytest

from vigil.sources import files as fs
from vigil.sources.flatten import discover, flatten, record_hash
from vigil.sources.landing import LandingTable
from vigil.sources.naming import distinct_names
from vigil.sources.numbering import numbered
from vigil.sources.preview import preview_schema
from vigil.sources.records import MalformedJson, open_records
from vigil.sources.specs import SOURCES, SourceSpec, source_for
from vigil.streaming.ingest import ingest
from pyspark.sql import functions as F

def variants(spark, *records):
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    return df.select("id", F.parse_json("text").alias("record"))


def flat(spark, *records, **kw):
    rows = flatten(variants(spark, *records), "record", "id", ["id"], **kw).orderBy("id").collect()
    return [{k: v for k, v in r.asDict().items() if k != "id"} for r in rows]


def put(path, data, at, packed=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    raw = data.encode()
    path.write_bytes(gzip.compress(raw) if packed else raw)
    os.utime(path, (at, at))


def test_paths_and_positions(spark):
    visit = {"Gate": {"lane": {"no": 7}}, "readings": [{"ok": True, "c": 36.6}, {"ok": False}], "memo": None}
    (row,) = flat(spark, visit)
    assert row == {
        "gate__lane__no": "7", "readings__0__c": "36.6", "readings__0__ok": True,
        "readings__1__ok": False, "memo": None, "_rescued_data": None,
    }


def test_depth_cap_keeps_the_rest_as_json_text(spark):
    deep = {"a": {"b": {"c": {"d": {"e": {"f": {"g": "too_deep"}}}}}}}
    (row,) = flat(spark, deep, max_depth=3)
    assert json.loads(row["a__b__c__d"]) == {"e": {"f": {"g": "too_deep"}}}
    nine = {"x": 1}
    for key in "hgfedcba":
        nine = {key: nine}
    (row,) = flat(spark, nine)
    assert json.loads(row["a__b__c__d__e__f__g"]) == {"h": {"x": 1}}


def test_empty_containers_are_null(spark):
    (row,) = flat(spark, {"o": {}, "l": [], "n": {"o": {}}})
    assert row == {"o": None, "l": None, "n__o": None, "_rescued_data": None}


def test_leaves_become_text_but_booleans_stay(spark):
    (row,) = flat(spark, {"n": 512, "f": 1.5, "d": "2008-06-15", "t": True, "big": 12345678901234567890})
    assert (row["n"], row["f"], row["d"], row["t"]) == ("512", "1.5", "2008-06-15", True)
    assert row["big"] == "12345678901234567890"


def test_shape_may_differ_between_records(spark):
    rows = flat(spark, {"a": "x"}, {"a": {"b": "y"}}, {"a": []}, {"a": [True]}, {"a": None})
    assert [r["a"] for r in rows] == ["x", None, None, None, None]
    assert [r["a__b"] for r in rows] == [None, "y", None, None, None]
    assert [r["a__0"] for r in rows] == [None, None, None, True, None]


def test_odd_keys(spark):
    record = {"a.b": 1, "it's": 2, 'say "x"': 3, "bo'th\"": 4, "": 5, "sp ace": {"[0]": 6}}
    (row,) = flat(spark, record)
    assert sorted(v for v in row.values() if v) == ["1", "2", "3", "4", "5", "6"]


def test_no_leaf_is_lost_when_names_collide(spark):
    rows = flat(spark, {"A.b": "1", "a_b": "2"}, {"x__y": "3"}, {"x": {"y": "4"}},
                {"x__y": "5", "x": {"y": "6"}})
    assert {rows[0]["a_b"], next(v for k, v in rows[0].items() if k.startswith("a_b_"))} == {"1", "2"}
    assert [r["x__y"] for r in rows[1:3]] == ["3", "4"]
    values = {rows[3]["x__y"], *json.loads(rows[3]["_rescued_data"]).values()}
    assert values == {"5", "6"}


def test_first_seen_type_wins(spark):
    rows = flat(spark, {"f": True, "g": "x", "n": None}, {"f": "no", "g": True, "n": True},
                {"f": "perhaps", "g": None, "n": False})
    assert [r["f"] for r in rows] == [True, False, None]
    assert json.loads(rows[2]["_rescued_data"]) == {"f": "perhaps"}
    assert [r["g"] for r in rows] == ["x", "true", None]
    assert [r["n"] for r in rows] == [None, "true", "false"]  # null first counts as text


def test_column_names():
    plain = distinct_names(["gate__lane__no", "Zone-Code", "_id", "_source"], {})
    assert list(plain.values()) == ["gate__lane__no", "zone_code", "id_field", "source"]
    odd = ["", "_-_", "7up", "é", "q" * 64, "q" * 65, "id", "ID_FIELD"]
    names = distinct_names([*plain, *odd], {})
    assert len(set(names.values())) == len(names)
    assert all(len(n) <= 63 and n[0].isalpha() for n in names.values())
    # A path keeps its name whatever comes later.
    assert {p: distinct_names(["new", *odd], names)[p] for p in names} == names


def test_names_that_look_alike_stay_apart():
    names = distinct_names(["Zone Code", "zone_code", "zone.code"], {})
    assert names["Zone Code"] == "zone_code" and len(set(names.values())) == 3
    assert all(n.startswith("zone_code") for n in names.values())


def test_hash_sees_values_not_the_order_of_keys(spark):
    records = [{"lane": 4, "car": {"plate": "K"}}, {"car": {"plate": "K"}, "lane": 4}, {"lane": 4, "car": {"plate": "L"}}]
    one, swapped, other = (
        r.h for r in variants(spark, *records).select("id", record_hash(F.col("record")).alias("h")).orderBy("id").collect()
    )
    assert one == swapped and other != one


def test_numbers_written_with_and_without_a_point_are_different_records(spark, tmp_path, roots):
    folder = tmp_path / "raw" / "lims_raw" / "records"
    lines = [
        '{"v":1.0,"s":"1.0"}', '{"v":1,"s":"1.0"}', '{"s":"1.0", "v": 1.00}',
        '{"v":-1.0,"s":"a\\"2.0"}', '{"v":-1,"s":"a\\"2.0"}',
        '[{"v":[2.0,10.05]},{"v":[2,10.05]},{"v":1.0e1}]',
    ]
    put(folder / "a.json", "\n".join(lines), time.time() - 100)
    (load,) = ingest(spark, source_for("lims_raw"), **roots)
    assert (load.rows_inserted, load.rows_deduped) == (7, 1)
    rows = LandingTable(spark, roots["landing_root"], "lims_raw").read().orderBy("id").collect()
    assert [r.s for r in rows[:4]] == ["1.0", "1.0", 'a"2.0', 'a"2.0']
    assert [r.v for r in rows[:4]] == ["1", "1", "-1", "-1"]


def test_every_file_form_gives_the_same_records(spark, tmp_path):
    recs = [{"k": i, "s": f"v{i}"} for i in range(5)]
    lines = "\n".join(json.dumps(r) for r in recs) + "\n\n"
    pretty_array = json.dumps(recs, indent=2)
    forms = {
        "ndjson.json": (lines, False),
        "array.json": (json.dumps(recs), False),
        "pretty.json": (pretty_array, False),
        "packed.json.gz": (lines, True),
        "packed_doc.json.gz": (pretty_array, True),
        "hidden.json": (lines, True),
        "hidden doc [1].bin": (pretty_array, True),
        "not_packed.json.gz": (lines, False),
        "rows.json": ("[\n" + ",\n".join(json.dumps(r) for r in recs) + "\n]", False),
    }
    for name, (text, packed) in forms.items():
        put(tmp_path / "in" / name, text, 1000, packed)
    put(tmp_path / "in" / "one.json", json.dumps(recs[0], indent=1), 1000)
    listed = fs.list_files(spark, str(tmp_path / "in"))
    with open_records(spark, listed) as records:
        got = records.select(
            F.regexp_extract("file_path", "[^/]+$", 0).alias("f"), "seq",
            F.variant_get("record", "$.k", "int").alias("k"),
        ).orderBy("f", "seq").collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.f, []).append(r.k)
    assert len(by_file) == len(forms) + 1
    assert by_file.pop("one.json") == [0]
    assert all(ks == [0, 1, 2, 3, 4] for ks in by_file.values())


@pytest.mark.parametrize("name", ["hidden.json", "named.json.gz"])
def test_a_packed_file_is_parsed_by_many_tasks_in_order(spark, tmp_path, request, name):
    lines = [json.dumps({"k": i, "s": "x" * 700}) for i in range(30_000)]
    lines[50], lines[200] = "[]", json.dumps([{"k": 200}, {"k": -1}])
    put(tmp_path / "in" / name, "\n".join(lines) + "\n", 1000, packed=True)
    few = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}  # else small partitions are merged
    before = {k: spark.conf.get(k) for k in few}
    request.addfinalizer(lambda: [spark.conf.set(k, v) for k, v in before.items()])
    for k, v in few.items():
        spark.conf.set(k, v)
    with open_records(spark, fs.list_files(spark, str(tmp_path / "in"))) as records:
        got, total = numbered(spark, records, lambda n: 0)
        got = got.select("id", F.variant_get("record", "$.k", "int").alias("k"), F.spark_partition_id().alias("p")).collect()
    assert [x.k for x in sorted(got, key=lambda x: x.id)] == [*range(50), *range(51, 201), -1, *range(201, 30_000)]
    assert sorted(x.id for x in got) == list(range(1, total + 1))
    assert len({x.p for x in got}) > 1


def test_a_bad_line_is_an_error_not_a_loss(spark, tmp_path):
    put(tmp_path / "in" / "bad.json", '{"a":1}\n{"a":\n{"a":3}\n', 1000)
    with pytest.raises(MalformedJson):
        with open_records(spark, fs.list_files(spark, str(tmp_path / "in"))) as records:
            records.count()


def test_a_record_that_is_no_object_is_an_error(spark):
    with pytest.raises(ValueError, match="not a JSON object"):
        discover(variants(spark, {"a": 1}, 7), "record", "id")


def test_listing_and_folder_discovery(spark, tmp_path):
    base = tmp_path / "krcs_evd_screening_raw"
    assert fs.data_folder(spark, str(base)) is None
    put(base / "_dlt_loads" / "x.json", "{}", 5)
    put(base / "init", "", 5)
    assert fs.data_folder(spark, str(base)) is None
    put(base / "visits" / "b.json", "{}", 10)
    put(base / "visits" / "a.json", "{}", 20)
    assert fs.data_folder(spark, str(base)) == f"{base}/visits"
    assert [f.path[-6:] for f in fs.list_files(spark, f"{base}/visits")] == ["b.json", "a.json"]
    put(base / "other" / "a.json", "{}", 20)
    assert fs.data_folder(spark, str(base)) is None


def test_registry():
    assert len(SOURCES) == 11 and len({s.table for s in SOURCES}) == 11
    assert source_for("cbs_screenings_raw").folder == "screenings"
    assert source_for("lims_raw") == SourceSpec("lims", "records")


@pytest.fixture
def roots(tmp_path):
    return {
        "raw_root": str(tmp_path / "raw"),
        "landing_root": str(tmp_path / "landing"),
        "checkpoint_root": str(tmp_path / "ckpt"),
    }


def test_ingest_dedups_evolves_and_repeats_safely(spark, tmp_path, roots):
    folder = tmp_path / "raw" / "lims_raw" / "records"
    now = time.time() - 1000
    put(folder / "b.json", json.dumps([{"_id": "1", "ok": True}, {"ok": True, "_id": "1"}]), now)
    put(folder / "a.json", '{"_id":"2","ok":false}\n{"_id":"1","ok":true}\n', now + 10)
    spec = source_for("lims_raw")
    (load,) = ingest(spark, spec, **roots)
    assert (load.files_processed, load.rows_inserted, load.rows_deduped) == (2, 2, 2)
    assert load.columns_added == ["id_field", "ok"]
    table = LandingTable(spark, roots["landing_root"], "lims_raw")
    first = table.read().orderBy("id").collect()
    assert [(r.id, r.id_field, r.ok) for r in first] == [(1, "1", True), (3, "2", False)]
    assert first[0]._source == "lims" and first[0]._processed is False
    assert first[0]._source_file == "lims_raw/records/b.json"
    assert len(first[0]._batch_id) == 36 and first[0]._batch_id != first[1]._batch_id

    assert ingest(spark, spec, **roots) == []
    put(folder / "c.json", '{"_id":"3","ok":"perhaps","extra":{"n":7}}\n{"_id":"2","ok":false}\n', now + 20)
    (load,) = ingest(spark, spec, **roots)
    assert (load.rows_inserted, load.rows_deduped) == (1, 1)
    assert load.columns_added == ["extra__n"]
    rows = table.read().orderBy("id").collect()
    assert [r.extra__n for r in rows] == [None, None, "7"]
    assert rows[2].id > rows[1].id and rows[2].ok is None
    assert json.loads(rows[2]._rescued_data) == {"ok": "perhaps"}
    archive = tmp_path / "raw" / "_processed_lims_raw"
    assert {p.name for p in archive.rglob("*.json")} >= {"a.json", "b.json"}
    assert spark.read.parquet(table.loads).count() == 2


def test_same_files_under_a_lost_checkpoint_add_nothing(spark, tmp_path, roots):
    folder = tmp_path / "raw" / "echis_raw" / "signals"
    put(folder / "a.json", '{"s":1}\n{"s":2}\n', time.time() - 100)
    spec = source_for("echis_raw")
    ingest(spark, spec, archive=False, **roots)
    (again,) = ingest(
        spark, spec, archive=False, **{**roots, "checkpoint_root": str(tmp_path / "ckpt2")}
    )
    assert (again.rows_inserted, again.rows_deduped) == (0, 2)


def test_batches_keep_file_order_in_ids(spark, tmp_path, roots):
    folder = tmp_path / "raw" / "mdharura_raw" / "signals"
    for i in range(6):
        put(folder / f"{9 - i}.json", "\n".join(json.dumps({"n": i * 10 + j}) for j in range(3)),
            time.time() - 1000 + i)
    loads = ingest(spark, source_for("mdharura_raw"), max_files=2, **roots)
    assert [x.rows_inserted for x in loads] == [6, 6, 6]
    rows = LandingTable(spark, roots["landing_root"], "mdharura_raw").read().orderBy("id").collect()
    assert [r.n for r in rows] == [str(i * 10 + j) for i in range(6) for j in range(3)]
    assert [r.id for r in rows] == list(range(1, 19))


def test_claimed_ids_are_not_given_twice(spark, roots):
    table = LandingTable(spark, roots["landing_root"], "lims_raw")
    assert [table.reserve_ids(n) for n in (5, 0, 2, 1)] == [0, 5, 5, 7]


def test_missing_or_unclear_folder_is_skipped(spark, roots):
    assert ingest(spark, source_for("krcs_evd_screening_raw"), **roots) is None
    assert ingest(spark, source_for("cbs_raw"), **roots) is None


def test_preview_writes_nothing(spark, tmp_path):
    folder = tmp_path / "p"
    put(folder / "old.json", '{"a":true,"b":{"c":1}}', 100)
    put(folder / "new.json", '{"z":1}', 200)
    rows = preview_schema(spark, str(folder), sample=1).collect()
    assert [(r.column, r.type, r.is_new) for r in rows] == [("a", "boolean", True), ("b__c", "string", True)]
    assert sorted(os.listdir(folder)) == ["new.json", "old.json"]
    assert preview_schema(spark, str(tmp_path / "none")).count() == 0


def test_old_resent_and_oddly_named_files_are_loaded_before_they_are_archived(spark, tmp_path, roots):
    folder = tmp_path / "raw" / "lims_raw" / "records"
    archive = tmp_path / "raw" / "_processed_lims_raw" / "records"
    spec, now = source_for("lims_raw"), time.time() - 1000
    put(folder / "a.json", '{"n":1}', now)
    ingest(spark, spec, **roots)
    assert not list(folder.glob("*.json")) and [p.name for p in archive.iterdir()] == ["a.json"]
    put(folder / "a.json", '{"n":2}', now + 50)
    put(folder / "late.json", '{"n":3}', now - 40 * 86400)
    put(folder / "_under.json", '{"n":4}', now + 60)
    put(folder / ".dot.json", '[\n{"n":5}]', now + 70)
    (load,) = ingest(spark, spec, **roots)
    assert (load.batch, load.rows_inserted, load.rows_deduped) == (1, 4, 0)
    rows = LandingTable(spark, roots["landing_root"], "lims_raw").read().orderBy("id").collect()
    assert [r.n for r in rows] == ["1", "3", "2", "4", "5"]
    assert rows[3]._source_file == "lims_raw/records/_under.json"
    assert not list(folder.glob("*.json")) and len(list(archive.glob("*.json*"))) == 5
    assert any(p.read_text() == '{"n":2}' for p in archive.glob("a.json*"))


def test_a_load_that_breaks_before_the_ledger_is_repeated_without_effect(
    spark, tmp_path, roots, monkeypatch
):
    folder = tmp_path / "raw" / "lims_raw" / "records"
    put(folder / "a.json", '{"n":1}\n{"n":2}', time.time() - 100)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr("vigil.streaming.ingest.Ledger.add", broken)
        with pytest.raises(OSError):
            ingest(spark, source_for("lims_raw"), **roots)
    assert (folder / "a.json").exists()
    (load,) = ingest(spark, source_for("lims_raw"), **roots)
    table = LandingTable(spark, roots["landing_root"], "lims_raw")
    assert (load.rows_inserted, load.rows_deduped) == (0, 2) and table.read().count() == 2
    assert not (folder / "a.json").exists()


def test_a_bad_file_keeps_no_other_back_and_is_reported(spark, tmp_path, roots):
    folder, now = tmp_path / "raw" / "lims_raw" / "records", time.time() - 100
    put(folder / "good.json", '{"n":1}', now)
    put(folder / "bad.json", '{"n":', now)
    (load,) = ingest(spark, source_for("lims_raw"), **roots)
    assert (load.files_processed, load.rows_inserted) == (1, 1)
    assert [p.rpartition("/")[2] for p in load.files_rejected] == ["bad.json"]
    assert [p.name for p in folder.glob("*.json")] == ["bad.json"]
    assert ingest(spark, source_for("lims_raw"), **roots) == []
    put(folder / "bad.json", '{"n":2}', now + 10)
    (load,) = ingest(spark, source_for("lims_raw"), **roots)
    assert load.rows_inserted == 1 and not list(folder.glob("*.json"))
