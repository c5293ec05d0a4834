"""Words, lines and their hashes of many texts at once, as numpy arrays over UTF-8 bytes.

Texts are laid side by side in one byte buffer with a newline before, between and after
them, so a word never spans two texts. Hashes are 64-bit polynomials over random byte
values: equal words always agree, and two different ones agree by chance once in 2**64.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are handled in chunks of about this size; a longer text is one chunk
ARROW_BATCH_BYTES = 8 << 20
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])

# Bytes of words. UTF-8 bytes of characters beyond ASCII are word bytes in both classes.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True  # of text with A-Z lower-cased
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

_rng = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 8 + 5
_STEP = int(_rng.integers(1 << 40, 1 << 62)) * 8 + 3
_MIX = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits; one to one."""
    h = h ^ (h >> np.uint64(33))
    h *= _MIX[0]
    h ^= h >> np.uint64(33)
    h *= _MIX[1]
    h ^= h >> np.uint64(33)
    return h


def bounded_batches(spark) -> None:
    """Let Spark cut what it hands to Python by bytes too, so that long texts fit.

    Workers import this package from where the driver has it, unless the session ships it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes together; every text is in one."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text)
    if texts:
        yield first, len(texts)


class Buffer:
    """Texts side by side. text_at[i] is where text i begins; text_at[n] is past the end."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        self.bytes = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, self.n)
        self.text_at = np.ones(self.n + 1, np.int64)
        self.text_at[1:] += np.cumsum(lengths + 1)

    def spans(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes in the table."""
        inside = table[self.bytes].view(np.int8)
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        return edges[0::2], edges[1::2]

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.text_at, at, "right") - 1

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span; spans are in order and do not overlap."""
        out = np.empty(len(starts), np.uint64)
        first = 0
        while first < len(starts):
            # A block of whole spans, so that memory does not grow with a text.
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK_BYTES)))
            low = int(starts[first])
            part = _BYTE[self.bytes[low : int(ends[last - 1])]]
            part *= powers(_BASE, len(part))
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part, out=total[1:])
            s, e = starts[first:last] - low, ends[first:last] - low
            back = powers(pow(_BASE, -1, 1 << 64), len(part) + 1)
            h = (total[e] - total[s]) * back[s]
            out[first:last] = mix(h + (e - s).astype(np.uint64))
            first = last
        return out


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n words in a row (len - n + 1 of them)."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    for j, p in enumerate(powers(_STEP, n + 1)[1:]):
        out += hashes[j : j + count] * p
    return mix(out)


class Words:
    """Words of texts: their spans, hashes and where each text's words begin."""

    def __init__(self, texts: list[bytes], table: np.ndarray, hashed: bool = True):
        self.buffer = Buffer(texts)
        self.starts, self.ends = self.buffer.spans(table)
        self.first = np.searchsorted(self.starts, self.buffer.text_at)  # n + 1 entries
        self.counts = np.diff(self.first)
        if hashed:
            self.hashes = self.buffer.span_hashes(self.starts, self.ends)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.buffer.n), self.counts)
