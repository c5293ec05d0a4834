"""The index of stored hashes over many loads, and after loads that broke anywhere."""

import hashlib
import json
import time

import pytest

from vigil.sources import hash_index
from vigil.sources.hash_index import HashIndex, Run
from vigil.sources.landing import LandingTable
from vigil.sources.specs import source_for
from vigil.streaming.ingest import ingest


def hashes(spark, numbers):
    rows = [(hashlib.md5(str(n).encode()).hexdigest(), n) for n in numbers]
    return spark.createDataFrame(rows, "_raw_hash string, id bigint")


def held(index, spark, numbers):
    asked = hashes(spark, numbers)
    found = index.holding(asked)
    return set() if found is None else {r.id for r in asked.join(found, "_raw_hash", "left_semi").collect()}


def test_runs_are_merged_in_levels_and_lose_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hash_index, "FANOUT", 2)
    index = HashIndex(spark, str(tmp_path / "h"))
    assert index.holding(hashes(spark, [1])) is None
    for load in range(7):
        index.commit(index.add(hashes(spark, range(load * 20, load * 20 + 20))))
    assert index.runs() == [Run(0, 7), Run(1, 6), Run(2, 4)]
    assert sorted(p.name for p in (tmp_path / "h").iterdir()) == [r.name for r in index.runs()]
    assert held(index, spark, range(100, 200)) == set(range(100, 140))
    assert held(index, spark, [3, 133, 500]) == {3, 133}


def test_a_load_opens_only_folders_and_row_groups_it_can_hit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hash_index, "FANOUT", 2)
    index = HashIndex(spark, str(tmp_path / "h"))
    for numbers in (range(500), range(500, 1000)):
        index.commit(index.add(hashes(spark, numbers)))
    (run,) = index.runs()
    folders = len(list((tmp_path / "h" / run.name / "hashes").glob("prefix=*")))
    assert run.level == 1 and folders > 200
    for numbers in (range(5), range(40)):
        found = index.holding(hashes(spark, numbers))
        plan = found._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters") : plan.index("PartitionFilters") + 60]
        assert "prefix" in filters and ("In(_raw_hash" in plan) == (len(numbers) <= 10)
        # Of the folders only those of the hashes are read.
        assert 0 < found.count() < 1000 / 4 and held(index, spark, numbers) == set(numbers)


@pytest.fixture
def roots(tmp_path):
    return {"raw_root": str(tmp_path / "raw"), "landing_root": str(tmp_path / "landing"), "checkpoint_root": str(tmp_path / "ckpt")}


def put(tmp_path, name, numbers):
    folder = tmp_path / "raw" / "lims_raw" / "records"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"n": n}) for n in numbers))
    time.sleep(0.01)


def stored(spark, roots):
    return sorted(int(r.n) for r in LandingTable(spark, roots["landing_root"], "lims_raw").read().collect())


@pytest.mark.parametrize("broken", ["commit", "write", "create", "evolve"])
def test_a_load_that_breaks_is_repeated_and_loses_no_record(spark, tmp_path, roots, monkeypatch, broken):
    monkeypatch.setattr(hash_index, "FANOUT", 2)
    spec = source_for("lims_raw")
    put(tmp_path, "a.json", range(5))
    ingest(spark, spec, **roots)
    put(tmp_path, "b.json", range(3, 9))
    target = {
        "commit": "vigil.sources.hash_index.HashIndex.commit", "write": "vigil.sources.landing.LandingTable.append",
        "create": "vigil.sources.hash_index.create_file", "evolve": "vigil.sources.hash_index.HashIndex.add",
    }[broken]

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(target, fail)
        with pytest.raises(OSError):
            ingest(spark, spec, **roots)
    loads = ingest(spark, spec, **roots)
    assert stored(spark, roots) == list(range(9))
    # Rows that were stored before it broke are repeats now.
    assert [x.rows_inserted for x in loads] == [0 if broken in ("commit", "create") else 4]
    put(tmp_path, "c.json", range(12))
    (load,) = ingest(spark, spec, **roots)
    assert (load.rows_inserted, load.rows_deduped) == (3, 9) and stored(spark, roots) == list(range(12))


def test_a_lost_index_is_made_again(spark, tmp_path, roots):
    spec = source_for("lims_raw")
    put(tmp_path, "a.json", range(5))
    ingest(spark, spec, **roots)
    table = LandingTable(spark, roots["landing_root"], "lims_raw")
    (tmp_path / "landing" / "lims_raw" / "hashes").rename(tmp_path / "lost")
    put(tmp_path, "b.json", range(7))
    (load,) = ingest(spark, spec, **roots)
    assert load.rows_inserted == 2 and len(table.hashes.runs()) == 2
