"""Each operator against a brute-force version, and on nulls, empty texts, ties, repeats,
empty tables and clashing columns."""

import base64
import gc
import hashlib
import os
import re
import subprocess
import sys
import weakref
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vigil.llm import decontaminate, license_scan, minhash, nbest, pii, quality, suffix_dedup, token_counts, toxicity, url_rules

DOCS = "doc_id bigint, text string, score string, n_words string, kept string, rule string, key string"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark, texts):
    """Texts with ids, a null id and columns that clash with what operators name theirs."""
    rows = [(i if i != 3 else None, t, "x", "x", "x", "x", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n, words=200):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, words, n))


ODD = [None, "", " \n\t ", "one", "one", "é ü 中 😀 …", "x" * 5000, prose(1, 20000)]


def test_every_operator_takes_odd_and_empty_tables(spark):
    model = toxicity.Model(np.empty(0, np.int64), np.empty(0), -20.0)
    items = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (3, "one")], "item_id bigint, text string")
    operators = [
        lambda d: toxicity.toxicity(d, model),
        suffix_dedup.repeated,
        lambda d: decontaminate.contamination(d, items),
        license_scan.license_scan,
        lambda d: token_counts.token_counts(d, BPE),
        quality.quality,
        lambda d: url_rules.judge(d, url_rules.rule_table(spark, [("net", "/", "block")]), "doc_id", "text"),
        lambda d: nbest.n_best_encoding(d, PIECES),
        minhash.near_duplicates,
        pii.found_spans,
        pii.mask,
    ]
    for rows in (ODD, []):
        docs = table(spark, rows)
        for operator in operators:
            assert operator(docs).count() == len(rows)


def test_noisy_or_learns_sentences_from_documents(spark):
    clean = [f"{prose(i, 30)}. {prose(i + 500, 30)}." for i in range(60)]
    toxic = [f"{prose(i, 30)}. you are a blorg{i % 3} now. {prose(i + 900, 30)}." for i in range(60, 100)]
    docs = table(spark, clean + toxic)
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(100) if i % 4], "doc_id bigint, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, toxicity.fit(docs, labels)).collect() if r.doc_id is not None}
    assert all(r.predicted == (i >= 60) and 0 <= r.score <= 1 for i, r in found.items())
    text = toxic[0]
    assert [text[s.start : s.end].strip() for s in found[60].sentences] == ["you are a blorg0 now"]
    nothing = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert toxicity.toxicity(docs, nothing).filter("predicted = 1").count() == 0


def test_long_clean_texts_stay_clean(spark, monkeypatch, tmp_path):
    """Labels that no sentence explains must not add up over a long text's sentences, and long
    labelled documents are in the fit."""
    clean = ["\n".join(f"{prose(i * 50 + k, 12, 3000)}." for k in range(1 + i % 40)) for i in range(300)]
    toxic = [f"{prose(9000 + i, 12, 3000)}. you are a blorg{i % 3} now. {prose(9500 + i, 12, 3000)}." for i in range(60)]
    odd = ["\n".join(f"{prose(7000 + i * 50 + k, 12, 3000)}." for k in range(20)) for i in range(15)]  # toxic for no reason
    def long(size):
        return ("\n".join(clean) * (1 + size // 300_000))[:size]

    marked = long(5_000_000) + "\nyou are a blorg1 now.\n" + long(9000)
    texts = clean + toxic + odd + [long(100_000), long(500_000), long(2_000_000), long(5_000_000), marked]
    n, m = len(clean), len(clean) + len(toxic) + len(odd)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(n <= i < m)) for i in range(m + 1)], "doc_id bigint, toxic int")
    sample = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic")
    assert sample.filter(F.octet_length("text") == 100_000).count() == 1
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.toxicity(docs.filter(F.col("doc_id") >= m), model).collect()}
    assert [found[i].predicted for i in range(m, m + 5)] == [0, 0, 0, 0, 1]
    assert [marked[s.start : s.end].strip() for s in found[m + 4].sentences] == ["you are a blorg1 now"]
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert {*range(n), *range(m, m + 4)} <= kept and m + 4 not in kept
    # One job a step gives what the driver's own arrays give.
    monkeypatch.setattr(toxicity, "STEPS", 3)
    here = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "DRIVER_HITS", 0)
    there = toxicity.fit(docs, labels)
    assert np.allclose(here.weights, there.weights) and np.isclose(here.bias, there.bias)


def cut_by_hand(texts):
    n = suffix_dedup.LENGTH
    seen = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 6000])
def test_repeated_passages(spark, monkeypatch, shard_bytes):
    """The small shard splits hot anchors, so strings are merged across shards as well."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
    base = [prose(s, 500).encode() for s in range(3)]
    texts = [base[0], base[0], base[1][:900] + base[2][100:700] + b"zz", base[2], b"ab" * 700, b"x" * 399, b"", b"Le " * 400]
    texts += [base[1][: i * 20] + b"#%d" % i + base[1][i * 20 + 3 :] for i in range(40)]
    rows = suffix_dedup.repeated(table(spark, [t.decode() for t in texts])).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == cut_by_hand(texts)


def test_split_anchors_are_merged_in_as_many_ranges_as_they_need(spark, monkeypatch):
    seen, shard = [], suffix_dedup._shard
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 6000)
    monkeypatch.setattr(suffix_dedup, "RANGE_STARTS", 400)
    monkeypatch.setattr(suffix_dedup, "_shard", lambda ranges: seen.append(ranges) or shard(ranges))
    passage = prose(1, 100).encode()[:430]
    texts = [prose(100 + i, 150).encode() + passage + prose(300 + i, 150).encode() for i in range(60)]
    rows = suffix_dedup.repeated(table(spark, [t.decode() for t in texts])).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == cut_by_hand(texts)
    assert seen[0] > 64


def test_contamination_and_proximity(spark, monkeypatch):
    passage = "the quick brown fox jumps over the lazy dog and runs far away home"
    texts = [prose(5, 50) + " " + passage.upper() + " tail", passage.replace("lazy", "sleepy"), "tiny Item here", prose(6, 80)]
    items = spark.createDataFrame([(7, passage), (12, "tiny item"), (12, "tiny item")], "item_id bigint, text string")
    docs = table(spark, texts)
    for block in (1 << 20, 4):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
        rows = decontaminate.contamination(docs, items).orderBy("n_words").collect()
        assert [(r.n_words, r.n_hit, r.items, r.contaminated) for r in rows] == [
            (3, 2, ["12"], True), (14, 0, [], False), (65, 14, ["7"], True), (80, 0, [], False)
        ]
    store = decontaminate.Store(spark, "test")
    index = decontaminate.build_index(table(spark, ["alpha x y beta", "alpha beta", "alpha a b c d beta"]), store)
    near = decontaminate.search(index, spark.createDataFrame([(1, "alpha beta")], "item_id int, text string"), store, window=None, slack=2)
    assert sorted((r.n_words, r.n_hit) for r in near.collect()) == [(2, 2), (4, 4), (6, 0)]


def test_license_places_and_changed_notices(spark):
    gpl = "This program is free software: you can redistribute it and/or modify it under any terms of the GNU General Public License as published by the Free Software Foundation"
    texts = ["a Under the MIT License. under the mit license", "Apache License, Version 2.0", "CC BY-NC 4.0", gpl, "under the MIT", "under the mit \u212aicense"]
    rows = license_scan.license_scan(table(spark, texts)).collect()
    found = sorted((r.places, r.base_labels, r.labels) for r in rows)
    assert found == [
        ([], [], []), ([], [], []), ([], [], ["gpl"]), ([0], ["apache-2"], ["apache-2"]),
        ([0], ["cc-by-nc"], ["cc-by-nc"]), ([1, 5], ["mit"], ["mit"]),
    ]


def test_token_counts_are_the_librarys(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(BPE)
    texts = [*ODD, "it's  'll <|endoftext|> a<|endoftext|>  \n\n x\u00a0y\u2003z", "12 345\t\t6", "z" * 3000]
    rows = token_counts.token_counts(table(spark, texts), BPE).collect()
    assert [r.n_tokens for r in rows] == [len(own.encode(t or "", add_special_tokens=False)) for t in texts]
    assert [r.over_limit for r in rows] == [r.n_tokens > 1024 for r in rows]


def test_quality_counts_and_bands(spark):
    noise = "".join(chr(33 + x) for x in np.random.default_rng(1).integers(0, 90, 4000))
    texts = [prose(3, 300, 5000), "same line here\nsame line here\n \nother #$", noise + " a" * 3, prose(4, 60, 400) * 40]
    rows = quality.quality(table(spark, texts)).collect()
    rows.sort(key=lambda r: 3 if r.doc_id is None else r.doc_id)
    for text, r in zip(texts, rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if x.strip()]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)
        )
    assert [r.kept for r in rows] == [True, False, False, False]
    assert not rows[2].in_band


def test_the_rest_of_a_text_is_judged_too(spark):
    rng = np.random.default_rng(4)
    words = ["".join(chr(97 + x) for x in rng.integers(0, 26, 3 + i % 7)) for i in range(900)]
    text = " ".join(words[x] for x in (900 * rng.random(6000) ** 2).astype(int)).encode()
    noise = base64.b64encode(rng.bytes(9000))
    # A rest weighs by its bytes: 300 of 4396 are no quarter.
    texts = [text[:8191], text[:4096] + noise[:4095], text[:6000] + b"again and " * 209, text[:4096] + noise[:300]]
    docs = spark.createDataFrame([(i, x.decode()) for i, x in enumerate(texts)], "doc_id bigint, text string")
    rows = sorted(quality.quality(docs).collect())
    assert [(r.n_chunks, r.n_bad_chunks, r.in_band) for r in rows] == [(2, 0, True), (2, 1, False), (2, 1, False), (2, 1, True)]


def test_bands_come_from_the_corpus(spark):
    """Quartiles by hand; a text at a limit is kept, one beyond it is not; copies count once."""
    rows = [(i, 1500, 0.5005 + i / 1000) for i in range(100)] + [(7, 1500, 0.5075)] * 900
    rows += [(1000 + i, 3000, 0.4) for i in range(99)]  # too few for limits of their own
    least, greatest = quality.band_limits(spark.createDataFrame(rows, "text_key bigint, n_bytes bigint, ratio double"))
    band, few = quality.BANDS_FROM.index(1024), quality.BANDS_FROM.index(2048)
    # The middle half goes from bin 524 to bin 574, three times 50 reach on from there.
    assert (least[band], greatest[band]) == (0.374, 0.725)
    assert (least[few], greatest[few]) == (quality.LEAST[few], quality.GREATEST[few])
    alike = [(i, 1500, 0.5005) for i in range(200)]
    least, greatest = quality.band_limits(spark.createDataFrame(alike, "text_key bigint, n_bytes bigint, ratio double"))
    assert np.isclose(least[band], 0.455) and np.isclose(greatest[band], 0.546)
    nothing = spark.createDataFrame([], "text_key bigint, n_bytes bigint, ratio double")
    assert quality.band_limits(nothing) == (quality.LEAST, quality.GREATEST)


def test_near_copies_do_not_set_the_bands(spark):
    """Three hundred near copies of a text that compresses well, beside 120 others of its length."""
    texts = [prose(i, 330, 1500) for i in range(120)]
    words = prose(600, 420, 90).split()
    copies = [" ".join([*words[:200], f"v{i}", *words[201:]]) for i in range(300)]
    rows = quality.quality(table(spark, texts + copies)).collect()
    assert all(r.kept for r in rows if r.doc_id is not None and r.doc_id < 120)


def test_bands_reject_documents_of_a_corpus(spark):
    """A text of few different words passes the base rules and every fixed limit; among 200
    of many words it stands out."""
    texts = [prose(i, 330, 1500) for i in range(200)]
    marked = prose(500, 400, 60)
    alone = quality.quality(table(spark, [marked])).collect()
    assert [(r.base_failed, r.kept) for r in alone if r.doc_id == 0] == [(False, True)]
    rows = [r for r in quality.quality(table(spark, [*texts, marked])).collect() if r.doc_id is not None]
    assert sorted(r.doc_id for r in rows if not r.kept and not r.base_failed) == [200]
    assert all(r.kept == (r.least_ratio <= r.ratio <= r.greatest_ratio) for r in rows if r.n_chunks == 0 and not r.base_failed)


def test_nested_url_rules(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("a.example.net", "/", "allow")]
    urls = ["http://EXAMPLE.net/en/1", "https://m.example.net/en/xy?q", "http://a.example.net/de/", "http://example.net", "badexample.net/en/",
            "x://notnet/", None, "http://net/", "http://b.a.example.net/#f", "http://example.net/en/1"]
    docs = table(spark, urls)

    def by_hand(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[2:] if fits else (None, "allow")))

    rows = url_rules.judge(docs, url_rules.rule_table(spark, rules), "doc_id", "text").collect()
    assert Counter((r.host, r.path, r.rule, r.verdict) for r in rows) == Counter(map(by_hand, urls))
    assert url_rules.judge(docs, url_rules.rule_table(spark, []).limit(0), "doc_id", "text").filter("rule is not null").count() == 0


def every_segmentation(model, part):
    if not part:
        return [(0.0, ())]
    out = []
    for j in range(1, len(part) + 1):
        piece = model.id_of.get(part[:j])
        if piece is not None:
            out += [(model.score[piece] + s, (piece, *ids)) for s, ids in every_segmentation(model, part[j:])]
    if part[0] not in model.id_of:
        raw = tuple(model.byte_ids[b] for b in part[0].encode())
        out += [(model.unknown + s, raw + ids) for s, ids in every_segmentation(model, part[1:])]
    return out


def test_a_worker_keeps_the_tables_of_one_operator():
    kept = weakref.ref(nbest.model(PIECES))
    assert nbest.model(PIECES) is kept()
    tables = minhash.permutations()
    gc.collect()
    assert kept() is None and minhash.permutations() is tables


RELEASE_TEST = """
import re
from pathlib import Path
from vigil.llm.resident import resident
def held():
    return int(re.search(r"Rss:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) >> 10
before = held()
kept = resident("one", "tables", lambda: [bytes(1000) for _ in range(200_000)])
assert held() > before + 150
top = bytes(1000)  # above the freed blocks, so that they are no end of the heap
del kept
resident("two", "tables", list)
assert held() < before + 50, (before, held())
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="reads Linux's figures")
def test_a_worker_gives_back_what_another_operator_held():
    subprocess.run([sys.executable, "-c", RELEASE_TEST], env=dict(os.environ, PYTHONPATH=os.pathsep.join(sys.path)), check=True, timeout=60)


@pytest.mark.parametrize("text", ["hello world", "  a  b", "éeaueau leß", "中😀ａ\n\tx", "aaaaaaaa", ""])
def test_n_best_segmentations(text):
    model = nbest.model(PIECES)
    (parts,) = model.prepare([text])
    ids, scores, _ = model.encode(parts, 4)
    assert scores == sorted((s for s, _ in every_segmentation(model, nbest.normalised(text))), reverse=True)[:4]
    assert model.decode(np.frombuffer(ids, np.int32).tolist()) == text
    for part in parts:
        found = model.n_best(part, 6)
        assert [s for s, _ in found] == sorted((s for s, _ in every_segmentation(model, part)), reverse=True)[:6]
        assert len({i for _, i in found}) == len(found)


def test_every_rank_of_whole_texts_has_its_ids(spark):
    model = nbest.model(PIECES)
    texts = ["hello world", "  a  b", "aab ba", "中😀ａ\n\tx", "", None]
    rows = nbest.n_best_encoding(table(spark, texts), PIECES)
    for text, r in zip(texts, rows.collect()):
        every = every_segmentation(model, nbest.normalised(text or ""))
        assert len(r.n_best_ids) == len(r.scores) == min(4, len(every)) and r.n_best_ids[0] == r.ids
        assert len({tuple(ids) for ids in r.n_best_ids}) == len(r.n_best_ids)
        for ids, score in zip(r.n_best_ids, r.scores):
            assert any(tuple(ids) == i and abs(score - s) < 1e-9 for s, i in every)
    back = nbest.decoding(rows.select("doc_id", F.explode("n_best_ids").alias("ids")), PIECES)
    assert {r.text for r in back.collect()} == {t or "" for t in texts}


@pytest.mark.parametrize("text", ["hello world aaaaaaaaaaaab", "éeaueau leß中😀ａ\n\tx==", "QmFzZTY0IGlzIG5vIHByb3Nl"])
def test_long_parts_in_blocks_give_the_same(monkeypatch, text):
    model = nbest.model(PIECES)
    every = []
    for long in (1024, 6, 1):
        monkeypatch.setattr(nbest, "LONG_PART", long)
        model.forget()
        (parts,) = model.prepare([text])
        assert "".join(parts) == nbest.normalised(text)
        raw, scores, changes = model.encode(parts, 4)
        ranks = model.segmentations(parts, changes)
        assert len(set(ranks)) == 4 and all(model.decode(np.frombuffer(w, np.int32).tolist()) == text for w in ranks)
        every.append(scores)
    model.forget()
    assert np.allclose(every[0], every[1]) and np.allclose(every[0], every[2])
    for n in (1, 2, 6):
        assert np.allclose([s for s, _ in model.n_best(text[:9], n)], [s for s, _ in model.n_best_long(text[:9], n)])


@pytest.mark.parametrize("slab", [1 << 16, 50])
def test_parts_solved_side_by_side_are_as_one_by_one(monkeypatch, slab):
    """Each character is looked up only as long as some piece goes on, not with every length of pieces."""
    monkeypatch.setattr(nbest, "SLAB_CHARS", slab)
    model = nbest.Model(PIECES)
    rng, looked_up = np.random.default_rng(4), []
    step = model.step
    monkeypatch.setattr(model, "step", lambda nodes, codes: looked_up.append(len(nodes)) or step(nodes, codes))
    words = ["".join(rng.choice(list("abcdef0123456789é中😀"), n)) for n in rng.integers(1, 30, 200)]
    (parts,) = model.prepare([" ".join(words)])
    assert sum(looked_up) < 5 * sum(map(len, parts))
    for k, part in zip(parts.numbers.tolist(), parts):
        (best, ids), *second = model.n_best(part, 2)
        assert model.best[k] == pytest.approx(best, abs=1e-9) and model.whole[k]
        assert model.behind[k] == (pytest.approx(best - second[0][0], abs=1e-9) if second else np.inf)
        assert model.decode(model.close(k, part, 1)[0][1]) == part.replace(nbest.SPACE, " ").removeprefix(" ")


LONG_PART_TEST = """
import base64, resource, sys
import numpy as np
resource.setrlimit(resource.RLIMIT_AS, (3 << 30, 3 << 30))
from vigil.llm import nbest
model = nbest.model(sys.argv[1])
for text in (base64.b64encode(np.random.default_rng(1).bytes(750_000)).decode(), "a" * 100_000):
    (parts,) = model.prepare([text])
    raw, scores, changes = model.encode(parts, 4)
    ranks = model.segmentations(parts, changes)
    assert len(set(ranks)) == 4 and scores == sorted(scores, reverse=True)
    assert all(model.decode(np.frombuffer(w, np.int32).tolist()) == text for w in ranks)
"""


def test_a_megabyte_without_spaces_fits_in_memory():
    env = dict(os.environ, OPENBLAS_NUM_THREADS="1", PYTHONPATH=os.pathsep.join(sys.path))
    subprocess.run([sys.executable, "-c", LONG_PART_TEST, PIECES], env=env, check=True, timeout=300)


@pytest.mark.parametrize("block", [100_000, 300])
def test_near_duplicates_are_all_that_brute_force_finds(spark, monkeypatch, block):
    """With small blocks, buckets take several turns of several blocks each."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    rng = np.random.default_rng(2)
    base = [prose(s, 120, 9000).split() for s in range(4)]
    texts = ["a b", "A  b", "", "null id", "a b c"]
    for k in range(60):
        words = list(base[k % 4])
        for at in rng.integers(0, len(words), k % 7):
            words[at] = f"q{k}"
        texts.append(" ".join(words))
    docs = table(spark, texts)
    rows = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    sets = {i: set(s.tolist()) for i, s in enumerate(minhash.shingle_sets([t.encode() for t in texts])) if i != 3}
    part = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    part[i] = part[j] = min(part[i], part[j])
    assert {i: rows[i].component_id for i in sets} == part
    assert all(rows[i].n_shingles == len(sets[i]) and rows[i].kept == (part[i] == i) for i in sets)
    assert rows[None].component_id is None and rows[None].kept


def test_one_row_of_each_group_stays(spark):
    a, b, c, d = (prose(s, 60, 9000) for s in range(4))
    rows = [(2, b), (5, a), (5, b + " x"), (7, c), (7, c), (None, c), (9, c + " y"), (None, d), (None, d), (8, ""), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(2, b), (5, a), (7, c), (None, d), (8, ""), (8, "")])
    # Two classes with one smallest id: each is verified by its own text.
    docs = spark.createDataFrame([(1, a), (1, b), (3, a + " x"), (4, b + " y")], "doc_id bigint, text string")
    found = minhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in found) == Counter([(1, 1, True)] * 2 + [(3, 1, False), (4, 1, False)])


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text):
    out = []
    for rank, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in twice) % 10 == 0, "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def test_personal_data(spark):
    texts = ["a@b.c_d@e.f x", "+1 (2) 3456789 012 +12345678901 a.b@c..d", "1.2.3.4.5.6.7.8 256.1.1.1 00255.1.1.1", "é 4111-1111 1111 1111 x",
             None, "mail x@y.zz" + ".a" * 5000, "9" * 3000 + " a@" * 500]
    rows = pii.found_spans(table(spark, texts)).select(pii.as_text(F.col("base")).alias("b")).collect()
    assert Counter(r.b for r in rows) == Counter(base_by_hand(t or "") for t in texts)
    masked = pii.mask(table(spark, texts[:5]))
    assert masked.columns == table(spark, []).columns
    assert sorted(str(r.text) for r in masked.collect()) == sorted(
        ["<email><email> x", "<phone> <phone> a.b@c..d", "<ip>.<ip> 256.1.1.1 <ip>", "é <card> x", "None"]
    )


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    texts = [f"please contact office at user{i}@mail.org today" for i in range(12)] + ["contact office at X99-1234-AB today", "number of 123456"]
    rows = pii.found_spans(table(spark, texts)).filter("size(base) = 0").select(pii.as_text(F.col("spans")).alias("s")).collect()
    assert sorted(r.s for r in rows) == ["", "email:18:29"]


def test_found_identifiers_bring_new_contexts(spark):
    """seed -> pattern -> identifier -> new pattern -> new identifier, which is a handle."""
    texts = [f"please contact office at user{i}@mail.org today" for i in range(80)]
    texts += [f"contact office at team_{'abcdefghijklmno'[i]} today" for i in range(15)]
    texts += [f"always ask for team_{'abcdefghijklmno'[i]} first" for i in range(15)]
    texts += ["always ask for @someone first", "never look for @nobody first", "read section 5 first"]
    rows = pii.found_spans(table(spark, texts)).filter("size(base) = 0").select(pii.as_text(F.col("spans")).alias("s")).collect()
    assert Counter(r.s for r in rows) == {"email:18:24": 15, "email:15:21": 15, "email:15:23": 1, "": 2}


def test_forms_of_candidates():
    form = re.compile(pii.FORMS["token"].replace("\\p{L}", "[a-zA-Z]"))
    text = "jane.doe x_y @me a1 12 end. well-known plain ... -- (see e.g."
    assert [m[0] for m in form.finditer(text)] == ["jane.doe", "x_y", "@me", "a1", "12", "well-known", "e.g."]


def test_secrets_are_seeds_of_their_own(spark):
    digest, mixed = "04dbebab91ab85687d33eeaaf9ac699e1188f962", "aB3dE5gH7jK9mN1pQ2sT4vW6yZ8bC0dF"
    texts = [
        f'run token = "{digest}"### now', f"see ({mixed}), or", "api_key=abc12345; done", "password: hunter42x",
        "my-long-article-name-about-2020-and-1999", "the monkey: abc12345", "token = abc", "a" * 40, "1" * 40, None,
        f"mail me at a@b.cd, key: {digest}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.b, r.s) for r in pii.found_spans(docs).select(
        "doc_id", pii.as_text(F.col("base")).alias("b"), pii.as_text(F.col("spans")).alias("s")).collect()}
    assert [found[i] for i in range(10)] == [
        ("", "secret:13:53"), ("", "secret:5:37"), ("", "secret:8:16"), ("", "secret:10:19"), *[("", "")] * 6,
    ]
    assert found[10] == ("email:11:17", "email:11:17,secret:24:64")
    assert pii.mask(docs).filter("doc_id = 0").first().text == 'run token = "<secret>"### now'


def test_a_pattern_is_learnt_on_the_given_table(spark):
    """Without their form, secrets are found by the contexts of those that keep it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    broken = F.regexp_replace("text", 'token = "([0-7][0-9a-f]{39})"', "token = $1.-.-.").alias("text")
    plain = docs.select("doc_id", broken)
    hidden = plain.filter(F.col("text").contains(".-.-.")).count()
    kinds = pii.found_spans(plain).select("doc_id", F.explode(F.array_except("spans", "base")).alias("s"))
    assert hidden > 0 and kinds.filter("s.kind = 'secret'").select("doc_id").distinct().count() >= hidden


def test_columns_named_like_the_operators_own_stay(spark, tmp_path):
    names = ["_row", "_key", "_text_key", "_spans", "a.b", "_Row_"]
    rows = [(i, t, "en", *[f"{n}{i}" for n in names]) for i, t in enumerate([prose(1, 30), prose(1, 30), "mail a@b.cd now", None])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", *names])
    spark.createDataFrame([(1, prose(9, 12))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for stage, left in ((corpus_pipeline.drop_near_duplicates, [0, 2, 3]), (corpus_pipeline.drop_contaminated, [0, 1, 2, 3]),
                        (corpus_pipeline.mask_personal_data, [0, 1, 2, 3])):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns[: len(docs.columns)] == docs.columns
        assert sorted((r.doc_id, *r[3:9]) for r in out.collect()) == [(i, *[f"{n}{i}" for n in names]) for i in left]


def test_texts_are_not_shuffled_to_drop_contaminated_ones(spark, tmp_path):
    """The list of what to drop is joined by its own size, not that of the index it comes from."""
    phrase = " ".join(f"b{i}" for i in range(12))
    spark.createDataFrame([("i1", phrase)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    words = [F.sha2(F.concat("id", F.lit(f"-{j}")), 256) for j in range(40)]
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", *words, F.when(F.col("id") == 7, phrase)).alias("text")
    )
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "20000")
    try:
        clean = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
        assert "SortMergeJoin" not in clean._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in clean.collect()) == [i for i in range(400) if i != 7]
    finally:
        spark.conf.set(limit, before)
