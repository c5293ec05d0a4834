"""Phrase counts, automata and collocations against counting in plain Python."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import automata, phrases
from vigil.llm.queries import QUERIES
from vigil.llm.stores import Store

FOLDER = "/root/testdata/sf0.001"


def plain_counts(rows):
    """Counts of (lang, words...) for texts with their langs; (lang,) counts all words."""
    counts = Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]", piece) if w]
            for i in range(len(words)):
                counts[(lang or "und",)] += 1
                for n in range(1, min(4, len(words) - i) + 1):
                    counts[(lang or "und", *words[i : i + n])] += 1
    return counts


def plain_collocations(rows, least, top=2000):
    f = plain_counts(rows)
    found = {}
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    for p, a in candidates.items():
        cuts = [(2_000_000 * a // (f[p[: k + 1]] + f[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        found[p] = (score, a, f[p[: k + 1]], f[(p[0], *p[k + 1 :])])
    for p, a in candidates.items():
        for n in range(2, len(p) - 1):
            for i in range(1, len(p) - n + 1):
                inner = (p[0], *p[i : i + n])
                if inner in found and 100 * a >= 80 * f[inner]:
                    del found[inner]
    out = []
    for lang in {p[0] for p in found}:
        ranked = sorted(((-s, -a, " ".join(p[1:]).encode(), l, r) for p, (s, a, l, r) in found.items() if p[0] == lang))
        out += [(lang, i + 1, w.decode(), -a, l, r, f[(lang,)], -s) for i, (s, a, w, l, r) in enumerate(ranked[:top])]
    return sorted(out)


def texts(seed, n, words=9, length=60):
    rng = np.random.default_rng(seed)
    marks = [" ", " ", "  ", "\t", ", ", ". ", "\n", " ! "]
    out = []
    for i in range(n):
        own = rng.integers(0, words, rng.integers(0, length))
        out.append((["en", "de", None][i % 3], "".join(f"{'Wé'[w % 2]}{w}" + marks[rng.integers(len(marks))] for w in own)))
    return out


def spelled(levels, words):
    return {p: int(w) for paths, level in phrases._spelled(levels, words) for p, w in zip(paths, level.weight)}


def as_bytes(counts):
    return {tuple(w.encode() for w in p): n for p, n in counts.items()}


def shards(rows):
    shard = phrases.Shard()
    for lang, text in rows:
        yield from shard.add((lang or "und").encode(), text.encode())
    yield from shard.rest()


@pytest.mark.parametrize("size, block", [(2_000_000, 1 << 20), (100, 16), (7, 1)])
def test_shards_cut_anywhere_count_all_phrases_once(monkeypatch, size, block):
    monkeypatch.setattr(phrases, "SHARD_WORDS", size)
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    rows = texts(1, 60)
    total = Counter()
    for levels, words in shards(rows):
        total.update(spelled(levels, words))
    assert total == as_bytes(plain_counts(rows))


def test_automata_share_states_and_keep_counts():
    rows = texts(2, 200)
    ((levels, words),) = shards(rows)
    want = as_bytes(plain_counts(rows))
    built = automata.Transducer.unpack(automata.build(levels, words).pack())
    assert spelled(built.levels(), built.words) == want
    n_phrases = sum(len(x.label) for x in levels)
    states = {(tuple(built.label[a:b]), tuple(built.weight[a:b]), tuple(built.target[a:b])) for a, b in zip(built.first, built.first[1:])}
    assert len(states) == len(built.first) - 1 < n_phrases / 4  # no two states are alike
    kept = automata.pruned(levels, 30)
    assert {p: n for p, n in spelled(kept, words).items() if n >= 30} == {p: n for p, n in want.items() if n >= 30}


def test_equal_signatures_of_different_states_are_seen(monkeypatch):
    ((levels, words),) = shards(texts(3, 20))
    honest = automata.mix
    calls = []

    def weak(h):
        calls.append(1)
        return h & np.uint64(7) if len(calls) < 4 else honest(h)

    monkeypatch.setattr(automata, "mix", weak)
    built = automata.build(levels, words)
    assert spelled(built.levels(), built.words) == spelled(levels, words)


def test_pieces_by_key_add_up_to_the_whole():
    rows = texts(4, 120)
    want = as_bytes(plain_counts(rows))
    keys = sorted({k for i, k in enumerate(sorted(want)) if i % 17 == 5} | {(b"de", b"zz"), (b"a",), (b"zz",), (b"en", b"w0", b"\xff")})
    pieces = [[] for _ in range(len(keys) + 1)]
    for half in (rows[:50], rows[50:]):
        for levels, words in shards(half):
            low = [0] * len(levels)
            for i, key in enumerate([*keys, None]):
                high = [len(x.label) for x in levels] if key is None else automata.cut_places(levels, words, key)
                if high != low:
                    pieces[i].append(automata.build(automata.part(levels, low, high), words))
                low = high
    total = Counter()
    for i, own in enumerate(pieces):
        if own:
            found = {p: n for p, n in spelled(*automata.union(own)).items() if n}
            assert all((i == 0 or keys[i - 1] <= p) and (i == len(keys) or p < keys[i]) for p in found)
            total.update(found)
    assert total == want


def test_composition_looks_phrases_up():
    ((levels, words),) = shards(texts(5, 80))
    counts = automata.build(levels, words)
    want = spelled(levels, words)
    asked = [*list(want)[5::7], (b"en", b"nothing"), (b"xx", b"w0")]
    table = phrases.pa.table({"lang": [p[0].decode() for p in asked], "phrase": [b" ".join(p[1:]).decode() for p in asked]})
    found = phrases._composed(table, phrases.pa.table({"data": [counts.pack()]})).to_pylist()
    got = {(r["lang"].encode(), *r["phrase"].encode().split(b" ")): r["f"] for r in found}
    assert got == {p: want.get(p, 0) for p in asked if len(p) > 1}


@pytest.mark.parametrize("range_bytes", [8 << 20, 300])
def test_collocations(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(phrases, "RANGE_BYTES", range_bytes)
    rows = texts(6, 150) + [("en", "very common words here, " * 400), ("und", "w0 w0"), ("en", ""), (None, None), ("fr", "Only once")]
    docs = spark.createDataFrame(
        [(i if i != 4 else 3, x, y, 0, 0) for i, (x, y) in enumerate(rows)], "doc_id bigint, lang string, text string, f int, phrase int"
    ).repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(docs, top=20, least=12).collect())
    assert got == plain_collocations(rows, 12, 20)
    assert len(phrases.range_keys(docs)) == 0 if range_bytes > 1 << 20 else len(phrases.range_keys(docs)) > 20


def test_no_texts(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "en", " ., ")], "doc_id bigint, lang string, text string")
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(docs.filter("false")).count() == 0


def test_counts_over_all_ranges_of_the_given_documents(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANGE_BYTES", 20_000)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found, _, keys = phrases.phrase_counts(docs, Store(spark, "t"))
    want = plain_counts([(r.lang, r.text) for r in docs.collect()])
    assert len(keys) > 10
    got = {(r.lang, *(r.phrase.split(" ") if r.size else ())): r.f for r in found.collect()}
    assert got == {p: n for p, n in want.items() if n >= 30 or len(p) == 1}


def test_registered_query_equals_plain_counting(spark):
    got = sorted(tuple(r) for r in QUERIES["op13_collocations"](spark, FOLDER).collect())
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert got == plain_collocations(rows, 30) and got
