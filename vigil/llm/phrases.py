"""Phrases whose words stand together more often than their parts' counts let expect.

Tasks count the phrases of their shard of the corpus in sorted order and build an automaton of
counts from them (`automata`), cut at keys that split all phrases into ranges of about equal
text. Each range's shard automata are united with their weights summed. Phrases that are
frequent in all come out of the ranges' automata, and the counts of the two parts of each are
looked up by composing the parts, as an automaton of their own, with that of their range.

The language is the first word of every path, so the weight of the path of a language alone is
the number of its words. A phrase is counted in one range only, that of its own key.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vigil.llm.automata import Level, Transducer, build, cut_places, part, pruned, summed, union
from vigil.llm.bytetext import bounded_batches, text_bytes
from vigil.llm.stores import Store

LONGEST = 4  # words of a phrase
LEAST = 30
COVERED = 80  # percent of a phrase's count at which a longer one that holds it replaces it
SCALE = 2_000_000
TOP = 2000
UNKNOWN = b"und"
SHARD_WORDS = 2_000_000
BLOCK_BYTES = 1 << 20  # a text is cut into words about so much at a time
RANGE_BYTES = 8 << 20  # of text for each range of phrases
SAMPLE_BYTES, SAMPLE_KEYS, KEY_BYTES = 4 << 20, 100_000, 64  # for the keys between ranges

_END = b"\xff"  # between pieces; no byte of UTF-8
_plain = bytearray(range(256))
_plain[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
_plain[0x09] = 0x20
for _c in b".,;:!?\n\x0b\x0c\r":
    _plain[_c] = _END[0]
_PLAIN = bytes(_plain)
Key = tuple[bytes, ...]


# --- counting a shard -----------------------------------------------------------------


def _blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text and _END between its pieces, some at a time."""
    text = text.translate(_PLAIN)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + BLOCK_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].replace(_END, b" \xff ").split()
        at = end


class _Numbers(dict):
    """A number for each word, in order of appearance; 0 for _END."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Shard:
    """Words of texts one after another, until there are enough to count."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.words, self.langs, self.size = _Numbers({_END: 0}), [], [], 0

    def add(self, lang: bytes, text: bytes) -> Iterator[tuple[list[Level], pa.Array]]:
        for words in _blocks(text):
            self._append(lang, words)
            while self.size >= SHARD_WORDS + LONGEST:
                yield self._counted(SHARD_WORDS)
        self._append(lang, [_END])

    def rest(self) -> Iterator[tuple[list[Level], pa.Array]]:
        if self.size:
            yield self._counted(self.size)

    def _append(self, lang: bytes, words: list[bytes]) -> None:
        self.words.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.langs.append((self.numbers[lang], len(words)))
        self.size += len(words)

    def _counted(self, n: int) -> tuple[list[Level], pa.Array]:
        """Phrases that begin at the first n places; the places after them stay."""
        word = np.concatenate(self.words)
        lang = np.repeat([x for x, _ in self.langs], [k for _, k in self.langs])
        names = list(self.numbers)
        order = pc.array_sort_indices(pa.array(names, pa.binary())).to_numpy()
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        levels = count_phrases(rank[word], rank[lang], word != 0, n, len(names))
        sorted_names = pa.array(names, pa.binary()).take(pa.array(order))
        # What comes after place n begins phrases of the next shard.
        later, of_lang = [names[i] for i in word[n:]], [names[i] for i in lang[n:]]
        self._clear()
        edges = [i for i in range(len(later)) if not i or of_lang[i] != of_lang[i - 1]] + [len(later)]
        for a, b in zip(edges, edges[1:]):
            self._append(of_lang[a], later[a:b])
        return levels, sorted_names


def count_phrases(word: np.ndarray, lang: np.ndarray, real: np.ndarray, n: int, width: int) -> list[Level]:
    """Sorted phrases of 0 to LONGEST words of each language, counted at the first n places.
    No phrase goes over a place that is not real."""
    levels: list[Level] = []
    node, ok = lang, real[:n].copy()
    key = lang[:n][ok]
    while True:
        kinds, count, place = summed(key, np.ones(len(key), np.int64))
        if levels:
            levels[-1].start = np.searchsorted(kinds, np.arange(len(levels[-1].label) + 1) * width)
        levels.append(Level(kinds % width, count, np.zeros(len(kinds) + 1, np.int64)))
        size = len(levels)  # words of the phrases that come next
        node = np.zeros(n, np.int64)
        node[ok] = place
        if size > LONGEST:
            break
        following = np.zeros(n, bool)
        last = real[size - 1 : size - 1 + n]
        following[: len(last)] = last
        ok &= following
        at = np.flatnonzero(ok)
        if not len(at):
            break
        key = node[at] * width + word[at + size - 1]
    return levels


# --- tasks ----------------------------------------------------------------------------


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
    for batch in batches:
        langs = batch.column("lang").cast(pa.binary()).to_pylist()
        yield from zip((UNKNOWN if x is None else x for x in langs), text_bytes(batch.column("text")))


def _sharded(keys: list[Key]):
    """Automata of the task's shards, one for each range that they have phrases of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()

        def pieces(counted) -> Iterator[pa.RecordBatch]:
            for levels, words in counted:
                low = [0] * len(levels)
                for i, key in enumerate([*keys, None]):
                    high = [len(x.label) for x in levels] if key is None else cut_places(levels, words, key)
                    if high != low:
                        data = build(part(levels, low, high), words).pack()
                        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([data], pa.binary())], ["range", "data"])
                    low = high

        for lang, text in _texts(batches):
            yield from pieces(shard.add(lang, text))
        yield from pieces(shard.rest())

    return run


def _united(least: int):
    def run(group: pa.Table) -> pa.Table:
        levels, words = union([Transducer.unpack(x.as_py()) for x in group.column("data")])
        data = build(pruned(levels, least), words).pack()
        return pa.table({"range": group.column("range").slice(0, 1), "data": pa.array([data], pa.binary())})

    return run


def _spelled(levels: list[Level], words: pa.Array) -> Iterator[tuple[list[Key], Level]]:
    """Phrases of each level as words."""
    paths: list[Key] = [()]
    for depth, level in enumerate(levels):
        above = paths if depth else paths * len(level.label)
        if depth:
            above = [p for p, n in zip(paths, np.diff(levels[depth - 1].start)) for _ in range(n)]
        paths = [(*p, w) for p, w in zip(above, words.take(pa.array(level.label)).to_pylist())]
        yield paths, level


def _rows(lang: list[bytes], phrase: list[bytes], size: list[int], f: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.binary()).cast(pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(size, pa.int32()), pa.array(f, pa.int64())],
        ["lang", "phrase", "size", "f"],
    )


def _frequent(least: int):
    """Phrases of a range with their counts; size 0 is all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                counts = Transducer.unpack(data.as_py())
                for depth, (paths, level) in enumerate(_spelled(counts.levels(), counts.words)):
                    own = np.flatnonzero(level.weight >= (least if depth else 1))
                    for i in range(0, len(own), 1 << 16):
                        at = own[i : i + (1 << 16)].tolist()
                        yield _rows([paths[j][0] for j in at], [b" ".join(paths[j][1:]) for j in at], [depth] * len(at), level.weight[at].tolist())

    return run


def _routed(keys: list[Key]):
    """The range that counts each phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            place = [bisect_right(keys, (lang.encode(), *phrase.encode().split(b" "))) for lang, phrase in both]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("phrase"), pa.array(place, pa.int32())], ["lang", "phrase", "range"])

    return run


def _composed(asked: pa.Table, counts: pa.Table) -> pa.Table:
    """Counts of the phrases asked of a range, from its automaton."""
    pairs = zip(asked.column("lang").to_pylist(), asked.column("phrase").to_pylist())
    paths = sorted({(lang.encode(), *phrase.encode().split(b" ")) for lang, phrase in pairs})
    found = [Transducer.unpack(x.as_py()) for x in counts.column("data")]
    if not paths or not found:
        return pa.Table.from_batches([_rows([], [], [], [])]).select(["lang", "phrase", "f"])
    words = pa.array(sorted({w for p in paths for w in p}), pa.binary())
    number = {w: i for i, w in enumerate(words.to_pylist())}
    levels: list[Level] = []
    above = {(): 0}
    for depth in range(max(map(len, paths))):
        here = sorted({p[: depth + 1] for p in paths if len(p) > depth})
        if levels:
            sizes = np.bincount([above[p[:-1]] for p in here], minlength=len(above))
            levels[-1].start = np.r_[0, np.cumsum(sizes)]
        wanted = set(p for p in paths if len(p) == depth + 1)
        levels.append(Level(np.array([number[p[-1]] for p in here]), np.array([int(p in wanted) for p in here]), np.zeros(len(here) + 1, np.int64)))
        above = {p: i for i, p in enumerate(here)}
    request = build(levels, words)
    out: list[pa.RecordBatch] = []
    for (spelled, level), weights in zip(_spelled(request.levels(), request.words), found[0].compose(request)):
        at = np.flatnonzero(level.weight).tolist()
        out.append(_rows([spelled[j][0] for j in at], [b" ".join(spelled[j][1:]) for j in at], [0] * len(at), weights[at].tolist()))
    return pa.Table.from_batches(out).select(["lang", "phrase", "f"])


# --- in Spark -------------------------------------------------------------------------


def range_keys(docs: DataFrame) -> list[Key]:
    """Keys that cut all phrases into ranges of about RANGE_BYTES of text, from a bounded sample
    of the rows. They decide how even the ranges are, not what is counted."""
    (total,) = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()
    n = math.ceil((total or 0) / RANGE_BYTES)
    if n < 2:
        return []
    share = min(1_000_000, math.ceil(1_000_000 * SAMPLE_BYTES / total))
    some = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in _texts(batches):
            for words in _blocks(text):
                own = [[lang, *(w[:KEY_BYTES] for w in words[i : i + LONGEST])] for i in range(0, len(words), 8) if _END not in words[i : i + LONGEST]]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.binary()))], ["key"])

    rows = some.select("lang", "text").mapInArrow(sampled, "key array<binary>").limit(SAMPLE_KEYS).collect()
    keys = sorted(tuple(bytes(w) for w in r.key) for r in rows)
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def phrase_counts(docs: DataFrame, store: Store, least: int = LEAST) -> tuple[DataFrame, DataFrame, list[Key]]:
    """Stored (lang, phrase, size, f) of phrases counted `least` times or more, with size 0 for
    all words of a lang; stored automata by range; and the keys between the ranges."""
    spark = docs.sparkSession
    bounded_batches(spark)
    keys = range_keys(docs)
    pieces = docs.select("lang", "text").mapInArrow(_sharded(keys), "range int, data binary")
    ranges = store.keep(pieces.groupBy("range").applyInArrow(_united(least), "range int, data binary"), "ranges")
    found = ranges.select("data").mapInArrow(_frequent(least), "lang string, phrase string, size int, f bigint")
    return store.keep(found, "phrases"), ranges, keys


def _exact(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the `top` phrases of each lang.

    Null texts have no words, and a null lang is `und`. Every row counts, also repeated ones
    and those without an id. Columns beside doc_id, lang and text are not read. Ties in score
    go by count, then by the phrase's bytes. No rows for an empty table.
    """
    spark: SparkSession = docs.sparkSession
    store = Store(spark, "phrases")
    phrases, ranges, keys = phrase_counts(docs.select("doc_id", "lang", "text"), store, least)
    words = F.split("phrase", " ", -1)
    candidates = phrases.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), words.alias("w"))

    def joined(first: Column, count: Column) -> Column:
        return F.array_join(F.slice("w", first, count), " ")

    cuts = store.keep(
        candidates.withColumn("k", F.explode(F.expr("sequence(1, size(w) - 1)")))
        .select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.size("w") - F.col("k")).alias("rest")),
        "cuts",
    )
    asked = cuts.select("lang", F.col("first").alias("phrase")).union(cuts.select("lang", "rest")).distinct()
    counted = store.keep(
        asked.mapInArrow(_routed(keys), "lang string, phrase string, range int").groupBy("range")
        .cogroup(ranges.groupBy("range")).applyInArrow(_composed, "lang string, phrase string, f bigint"),
        "parts",
    )
    score = F.expr(f"cast((cast(a as decimal(20,0)) * {SCALE}) div (l + r) as bigint)")
    scored = (
        cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    )
    # Phrases of two words or more inside longer ones, with the largest count of those.
    inside = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    held = (
        candidates.filter(F.size("w") > 2).select("lang", F.explode(inside).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    stays = F.col("longer").isNull() | (100 * _exact(F.col("longer")) < COVERED * _exact(F.col("a")))
    kept = store.keep(
        scored.join(held, ["lang", "phrase"], "left").filter(stays)
        .select("lang", "phrase", "a", "m.l", "m.r", "m.score", F.xxhash64("phrase").alias("salt")),
        "kept",
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # No task ranks all phrases of a language: the best of many parts, then the best of those.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = kept
    for parts in (tasks, math.ceil(math.sqrt(tasks))):
        place = F.row_number().over(Window.partitionBy("lang", F.pmod("salt", F.lit(parts))).orderBy(*order))
        best = best.withColumn("place", place).filter(F.col("place") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    total = phrases.filter("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return best.filter(F.col("rank") <= top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
