"""Quality rules: exact word, line and window counts, and compression bands.

A text's zstandard ratio tells how much of it repeats. Whole texts and their fixed chunks are
held against limits for their length, because short texts compress worse: below the lower
limit a text is repetitive, above the upper one it is noise. A text whose whole lies in its
band still fails if chunks with more than BAD_CHUNK_SHARE of its bytes do not; the last chunk
is what remains, held against the limits for its own length.

Fixed limits hold everywhere. In a band with LEAST_TEXTS different texts or more, the corpus
narrows them: a text fails too if its ratio lies further outside the middle half of the band's
ratios than FENCE times the width of that half. Ratios of all texts that pass the base rules and
lie within the fixed limits are counted in bins, so the limits take one small row for each band and bin. Texts of a band with the same least hash of
five words in a row count once there, so that a large group of copies or near copies does not
set the limits for other texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.bytetext import NOT_SPACE, Words, bounded_batches, chunks, mix, ngram_hashes, text_bytes
from vigil.llm.stores import Store

LEVEL = 3
CHUNK = 4096
BAD_CHUNK_SHARE = 0.25
# Lengths from which a band holds, and its least and greatest compressed share. Prose of any
# language keeps well inside; a band is the wider the shorter the text.
BANDS_FROM = [0, 128, 256, 512, 1024, 2048, 4096, 8192, 16384]
LEAST = [0.0, 0.30, 0.33, 0.33, 0.32, 0.30, 0.28, 0.27, 0.26]
GREATEST = [float("inf"), 0.98, 0.90, 0.80, 0.74, 0.70, 0.68, 0.66, 0.65]
LEAST_TEXTS = 100
FENCE = 3.0
LEAST_WIDTH = 0.03  # of the median; many alike texts must not make the middle half narrower
BINS = 1000  # in a ratio of 1
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

SCHEMA = """struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,
            n_repeat_words:bigint,least_window:bigint,ratio:double,chunk_ratios:array<double>>"""
_CHAR_STARTS = (np.arange(256) & 0xC0) != 0x80


def _repeated(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values of texts: which occur again in the same text, and which have an earlier equal."""
    keyed = mix(hashes + mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keyed, kind="stable")
    same = keyed[order][1:] == keyed[order][:-1]
    again, later = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    again[order[1:]] = again[order[1:]] | same
    later[order[1:]] = same
    again[order[:-1]] |= same
    return again, later


def counts(words: Words) -> dict[str, np.ndarray]:
    buf, n = words.buffer, words.buffer.n

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, buf.text_at[:-1], dtype=np.int64)

    owner = words.text_of_word()
    windows = ngram_hashes(words.hashes, 3)
    inside = owner[: len(windows)] == owner[2:]
    again = np.zeros(len(windows), bool)
    again[inside] = _repeated(windows[inside], owner[: len(windows)][inside])[0]
    covered = np.zeros(len(owner), bool)
    for j in range(3 if len(windows) else 0):
        covered[j : j + len(again)] |= again

    ends = np.flatnonzero(buf.bytes == 0x0A)
    starts, ends = ends[:-1] + 1, ends[1:]
    wordy = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[wordy], ends[wordy]
    line_owner = buf.text_of(starts)
    later = _repeated(buf.span_hashes(starts, ends), line_owner)[1]
    return {
        "n_words": words.counts,
        # A word's characters are a text's without white space, all of which is one byte long.
        "word_chars": per_text(_CHAR_STARTS[buf.bytes] & NOT_SPACE[buf.bytes]),
        "n_symbols": per_text(SYMBOLS[buf.bytes]),
        "n_dup_lines": np.bincount(line_owner[later], minlength=n),
        "n_repeat_words": np.bincount(owner[covered], minlength=n),
    }


def least_windows(words: Words) -> pa.Array:
    """For each text the least hash of five words in a row; null for fewer words."""
    owner, windows = words.text_of_word(), ngram_hashes(words.hashes, 5)
    inside = owner[: len(windows)] == owner[4:]
    owner, windows = owner[: len(windows)][inside], windows[inside]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(owner)])
    out, none = np.zeros(words.buffer.n, np.int64), np.ones(words.buffer.n, bool)
    if len(first):
        out[owner[first]] = np.minimum.reduceat(windows, first).view(np.int64)
        none[owner[first]] = False
    return pa.array(out, mask=none)


def ratios(text: bytes, press: zstandard.ZstdCompressor) -> tuple[float, list[float]]:
    """Compressed share of the whole text, and of each chunk if there are several."""
    if not text:
        return 1.0, []
    parts = [text[at : at + CHUNK] for at in range(0, len(text), CHUNK)] if len(text) > CHUNK else []
    whole, *rest = (len(press.compress(x)) / len(x) for x in (text, *parts))
    return whole, rest


def measured(column: pa.Array) -> pa.Array:
    texts, parts = text_bytes(column), []
    press = zstandard.ZstdCompressor(level=LEVEL)
    for a, b in chunks(texts):
        words = Words(texts[a:b], NOT_SPACE)
        found = counts(words)
        whole, rest = zip(*(ratios(t, press) for t in texts[a:b]))
        parts.append(
            pa.StructArray.from_arrays(
                [pa.array(v, pa.int64()) for v in found.values()]
                + [least_windows(words), pa.array(whole, pa.float64()), pa.array(rest, pa.list_(pa.float64()))],
                [*found, "least_window", "ratio", "chunk_ratios"],
            )
        )
    return pa.concat_arrays(parts)


def by_length(size: Column, values: list) -> Column:
    """The value of the band that a length lies in."""
    found = F.lit(values[0])
    for low, value in zip(BANDS_FROM[1:], values[1:]):
        found = F.when(size >= low, F.lit(value)).otherwise(found)
    return found


def band_limits(measures: DataFrame) -> tuple[list[float], list[float]]:
    """Least and greatest ratio of each band, from (text_key, n_bytes, ratio) of texts; those
    outside the fixed limits do not count, those of one key and band once, by their least ratio.

    Quartiles are those of the bins, exact and the same however rows are dealt. At most one row
    for each band reaches the driver.
    """
    fixed = (by_length(F.col("n_bytes"), x) for x in (LEAST, GREATEST))
    bins = (
        measures.filter(F.col("ratio").between(*fixed)).select(
            "text_key", by_length(F.col("n_bytes"), list(range(len(BANDS_FROM)))).alias("band"),
            F.floor(F.col("ratio") * BINS).alias("bin"),
        )
        .groupBy("text_key", "band").agg(F.min("bin").alias("bin"))
        .groupBy("band", "bin").agg(F.count("*").alias("n"))
    )
    of_band = Window.partitionBy("band")
    placed = bins.withColumn("upto", F.sum("n").over(of_band.orderBy("bin"))).withColumn("all", F.sum("n").over(of_band))
    quartiles = placed.filter(F.col("all") >= LEAST_TEXTS).groupBy("band").agg(
        *[F.min(F.when(4 * F.col("upto") >= q * F.col("all"), F.col("bin"))).alias(f"q{q}") for q in (1, 2, 3)]
    )
    least, greatest = list(LEAST), list(GREATEST)
    for r in quartiles.filter("band > 0").collect():
        reach = FENCE * max(r.q3 - r.q1, LEAST_WIDTH * r.q2)
        least[r.band] = max(least[r.band], (r.q1 - reach) / BINS)
        greatest[r.band] = min(greatest[r.band], (r.q3 + 1 + reach) / BINS)
    return least, greatest


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base_failed, kept, and the compression figures with their limits, for each row.

    Null texts have no words, as have empty ones; both fail the base rules. Repeated rows are
    judged one by one and count once for the limits; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    measures = Store(spark, "quality").keep(
        docs.select(
            F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("own_key"),
            F.octet_length(text).cast("bigint").alias("n_bytes"), F.arrow_udf(measured, SCHEMA)(F.col(text_col)).alias("m"),
        ).select("doc_id", "own_key", "n_bytes", "m.*")
        .select("*", F.coalesce("least_window", "own_key").alias("text_key")),
        "measures",
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    limits = band_limits(measures.filter(~failed))
    size, n = F.col("n_bytes"), F.col("n_chunks")
    last = size - CHUNK * (n - 1)

    def outside(ratio: Column, length: Column) -> Column:
        least, greatest = (by_length(length, x) for x in limits)
        return ~ratio.between(least, greatest)

    full = F.slice("chunk_ratios", F.lit(1), F.greatest(n - 1, F.lit(0)).cast("int"))
    bad_full = F.size(F.filter(full, lambda x: outside(x, F.lit(CHUNK)))).cast("bigint")
    bad_last = F.coalesce(outside(F.try_element_at("chunk_ratios", F.lit(-1)), last), F.lit(False)).cast("bigint")
    return (
        measures.withColumn("n_chunks", F.size("chunk_ratios").cast("bigint"))
        .withColumns({"bad_full": bad_full, "bad_last": bad_last})
        .withColumn("n_bad_chunks", F.col("bad_full") + F.col("bad_last"))
        .withColumn("bad_bytes", CHUNK * F.col("bad_full") + F.col("bad_last") * last)
        .withColumn("in_band", ~outside(F.col("ratio"), size) & (F.col("bad_bytes") <= BAD_CHUNK_SHARE * size))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & F.col("in_band"))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept", "ratio", "n_chunks", "n_bad_chunks", "in_band",
            *[by_length(size, x).alias(name) for x, name in zip(limits, ("least_ratio", "greatest_ratio"))],
        )
    )
