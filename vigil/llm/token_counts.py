"""Token counts by a two-tier look-up of pre-token lengths, without shuffling pre-tokens.

A byte-level BPE never merges across pre-tokens, so a text's token count is the sum over its
pre-tokens. Frequent pre-tokens have their lengths in a compact table that every worker
gets; the rest are encoded once per worker and remembered in a bounded cache.

The table comes from all texts: each task reports only the pre-tokens that make up at least
one in REPORT_ONE_IN of its own, which bounds its report whatever it reads, and the reports
are summed. The table changes the speed, never a count.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.llm.bytetext import bounded_batches

# Fixed value: the pre-token pattern of the vocabulary's library, with its notion of space.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
REPORT_ONE_IN = 4000
TABLE_ENTRIES = 1 << 16
TALLY_ENTRIES = 1 << 19  # distinct pre-tokens a task tallies before it lets go of the rare ones
CACHE_ENTRIES = 1 << 19
CACHED_CHARS = 64  # longer pre-tokens are encoded each time

_pattern = regex.compile(PATTERN)
_encoders: dict[str, Encoder] = {}


class Encoder:
    """The vocabulary's own library, and the cache of one worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Special strings inside texts are single tokens, as is the library's default.
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.cache: dict[str, int] = {}

    def lengths(self, pre_tokens: list[str]) -> list[int]:
        encoded = self.tokenizer.encode_batch_fast(pre_tokens, add_special_tokens=False)
        return [len(e) for e in encoded]

    def pieces(self, text: str) -> tuple[int, list[str]]:
        """How many special strings a text holds, and the text between them."""
        if self.special is None or not self.special.search(text):
            return 0, [text]
        parts = self.special.split(text)
        return len(parts) - 1, parts

    def count(self, text: str, table: dict[str, int]) -> int:
        total, parts = self.pieces(text)
        for part in parts:
            tokens = _pattern.findall(part)
            found = list(map(table.get, tokens))
            if None in found:
                missed = [t for t, n in zip(tokens, found) if n is None]
                total += sum(n for n in found if n is not None) + self.missed(missed)
            else:
                total += sum(found)
        return total

    def missed(self, tokens: list[str]) -> int:
        cache = self.cache
        new = [t for t in dict.fromkeys(tokens) if t not in cache]
        fresh = dict(zip(new, self.lengths(new))) if new else {}
        total = sum(cache[t] if t in cache else fresh[t] for t in tokens)
        if len(cache) + len(fresh) > CACHE_ENTRIES:
            cache.clear()
        cache.update((t, n) for t, n in fresh.items() if len(t) <= CACHED_CHARS)
        return total


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _report(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[str] = Counter()
        total = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in encoder(path).pieces(text or "")[1]:
                    tokens = _pattern.findall(part)
                    total += len(tokens)
                    tally.update(tokens)
                if len(tally) > TALLY_ENTRIES:
                    tally = Counter({t: n for t, n in tally.items() if n * TALLY_ENTRIES > total})
        rows = [(t, n) for t, n in tally.items() if n * REPORT_ONE_IN >= total and len(t) <= CACHED_CHARS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())],
            ["pre_token", "n"],
        )

    return run


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text") -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens of all texts, at most TABLE_ENTRIES."""
    bounded_batches(docs.sparkSession)
    reports = docs.select(F.col(text_col).alias("text")).mapInArrow(_report(path), "pre_token string, n bigint")
    rows = reports.groupBy("pre_token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre_token").limit(TABLE_ENTRIES)
    tokens = [r.pre_token for r in rows.collect()]
    return dict(zip(tokens, encoder(path).lengths(tokens))) if tokens else {}


def counter(spark: SparkSession, path: str, table: dict[str, int]):
    """Column of texts to column of token counts; null and empty texts have none."""
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(table)

    @F.arrow_udf("bigint")
    def count(column: pa.Array) -> pa.Array:
        own, frequent = encoder(path), sent.value
        return pa.array([own.count(t, frequent) if t else 0 for t in column.to_pylist()], pa.int64())

    return count


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row of docs.

    Null counts as empty. Repeated rows and ids are counted row by row; other columns are
    not read. An empty table gives an empty result.
    """
    count = counter(docs.sparkSession, path, frequent_lengths(docs, path, text_col))
    text: Column = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        count(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
