"""SimHash groups against all pairs compared one by one."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vigil.llm import simhash
from vigil.llm.queries import QUERIES
from vigil.llm.stores import Store

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def plain_pairs(prints):
    prints = np.unique(np.array(prints, np.uint64))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    return {(int(prints[i]), int(prints[j])) for i, j in zip(*np.nonzero(np.triu(near, 1)))}


def plain_components(rows):
    """Smallest id reachable for each row (id, fingerprint)."""
    parent = {f: f for _, f in rows}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in plain_pairs(list(parent)):
        parent[root(a)] = root(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [(i, f, least.get(root(f))) for i, f in rows]


def test_fingerprints_of_texts_cut_in_blocks(monkeypatch):
    texts = ["", " \n", "One", "one TWO", "a b c", "A\tB\nc d", "é É x y z", "x" * 300, " ".join(f"w{i % 37}" for i in range(500))]
    want = [plain_fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t.encode()) for t in texts] == want
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 7)
    monkeypatch.setattr(simhash, "BLOCK_HASHES", 3)
    assert [simhash.fingerprint(t.encode()) for t in texts] == want
    assert simhash.fingerprint(b"one two three") == xxhash.xxh64(b"one two three", seed=42).intdigest()


def clustered(seed, n):
    """Random fingerprints, crowds around some of them, and pairs at 2 and 3 bits."""
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 1 << 64, n, dtype=np.uint64)] + [0, (1 << 64) - 1, 1, 3, 7]
    for centre in out[:4]:
        for _ in range(n):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            out.append(centre ^ sum(1 << int(f) for f in flips))
    # Thirds touch at bits 43 and 22: flips on either side, and in two thirds at once.
    for bits in ([0, 63], [42, 43], [21, 22], [0, 43], [21, 43, 63], [5]):
        out.append(out[9] ^ sum(1 << b for b in bits))
    return out


@pytest.mark.parametrize("unit, levels, frontier", [(20_000, 4, 1 << 18), (30, 7, 7), (2, 11, 50)])
def test_links_are_all_close_pairs_and_each_once(spark, monkeypatch, unit, levels, frontier):
    for name, value in (("UNIT", unit), ("LEVELS", levels), ("FRONTIER", frontier)):
        monkeypatch.setattr(simhash, name, value)
    prints = sorted(set(clustered(unit, 150)))
    table = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp bigint")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(table, Store(spark, "t")).collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_pairs(prints)


def test_groups_of_documents(spark):
    base = [f"u{i}" for i in range(300)]
    near = base[:150] + ["changed"] + base[151:]
    texts = [None, "", " \t", "one two", "one two", " ".join(base), "  ".join(base).upper(), " ".join(near), " ".join(base[:40]), "x " * 30000]
    rows = [(i if i != 5 else None, t, "x", "x", 0, "x") for i, t in enumerate(texts)] + [(7, texts[3], "x", "x", 0, "x"), (9, texts[9], "x", "x", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, component_id string, turn int, `a.b` string")
    got = sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash.near_copies(docs).collect()), key=str)
    want = sorted(plain_components([(r[0], plain_fingerprint(r[1])) for r in rows]), key=str)
    assert got == want
    assert {c for i, _, c in got if i in (0, 1, 2)} == {0}
    assert simhash.near_copies(docs.filter("false")).count() == 0
    named = simhash.near_copies(docs.select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text"))
    assert {r.component_id for r in named.collect() if r.doc_id in ("d0", "d1", "d2")} == {"d0"}


def test_registered_query_equals_all_pairs(spark):
    got = sorted(tuple(r) for r in QUERIES["op11_simhash"](spark, FOLDER).select("doc_id", "fingerprint", "component_id").collect())
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert got == sorted((i, f"{f:016x}", c) for i, f, c in plain_components(rows))
