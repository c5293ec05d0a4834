"""JSON files to records, one VARIANT per record, in file order.

A file holds one object, an array, or one object per line, plain or gzipped. Content
decides, not the name: if every non-blank line is JSON by itself the file is read by
line; otherwise it is one document (`documents`). Both are split across tasks.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.sources.documents import OPENS, document_records
from vigil.sources.files import SourceFile, packed_files
from vigil.sources.flatten import exact_json

_SCHEMA = "value string, file_path string, modified timestamp, block_start bigint"
LINE_BYTES = 64 << 20  # a longer line is no record by itself
UNPACK_BYTES = 4 << 20
SPREAD_BYTES = 64 << 20  # a packed file up to this size is unpacked in blocks, which are parsed by many tasks
_META = ["_metadata.file_path", "_metadata.file_modification_time as modified"]


class MalformedJson(ValueError):
    """Files that hold no valid JSON in any accepted form; `paths` names them."""

    def __init__(self, paths: list[str]):
        super().__init__(f"no valid JSON, or a document too large for Spark, in {paths}")
        self.paths = paths


def _same(path: str) -> str:
    return unquote(path).replace("file:///", "file:/")


def _unpacked(frames: Iterable[pd.DataFrame], sep: str) -> Iterator[pd.DataFrame]:
    """Text of files that are packed, or whose name says so, one row for each block of pieces that end
    at `sep`; blocks are counted from 0."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            raw = io.BytesIO(row.content)
            packed = row.content[:2] == b"\x1f\x8b"
            for number, values in enumerate(_pieces(gzip.open(raw) if packed else raw, sep.encode())):
                yield pd.DataFrame(
                    {
                        "value": [sep.join(values)],
                        "file_path": row.file_path,
                        "modified": row.modified,
                        "block_start": number,
                    }
                )


def _pieces(stream, sep: bytes) -> Iterator[list[str]]:
    """Text of a stream cut at `sep`, unpacked a little at a time."""
    held: list[bytes] = []
    while chunk := stream.read(UNPACK_BYTES):
        first, *more = chunk.split(sep)
        held.append(first)
        if more:
            yield [x.decode("utf-8", "replace") for x in (b"".join(held), *more[:-1])]
            held = [more[-1]]
    if any(held):
        yield [b"".join(held).decode("utf-8", "replace")]


def _literal(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _texts(spark: SparkSession, files: list[SourceFile], sep: str) -> DataFrame:
    """Text of the files in pieces that end at `sep`. Lines over LINE_BYTES are left out of
    files that are not packed; the column `size` tells that some are."""
    plain, whole, streamed = [], [], []
    packed = packed_files(spark, files)
    for f in files:
        named = f.path.endswith(".gz")
        spread = named != (f.path in packed) or named and f.length <= SPREAD_BYTES
        kind = whole if spread else streamed if named else plain
        kind.append(_literal(f.path))
    columns = ["value", *_META, "_metadata.file_block_start as block_start"]
    parts = []
    if plain:
        reader = spark.read.option("lineSep", sep)
        if sep == "\n":
            reader = reader.option("mapreduce.input.linerecordreader.line.maxlength", str(LINE_BYTES))
        parts.append(reader.text(plain).selectExpr(*columns, "_metadata.file_size as size"))
    if streamed:
        parts.append(spark.read.option("lineSep", sep).text(streamed).selectExpr(*columns, "0L as size"))
    if whole:
        # One task unpacks a file; its blocks are parsed by many. Sorted, they are in the same order
        # whenever they are read.
        blocks = (
            spark.read.format("binaryFile")
            .load(whole)
            .selectExpr("content", *_META)
            .mapInPandas(lambda frames: _unpacked(frames, sep), _SCHEMA)
            .repartition("file_path", "block_start").sortWithinPartitions("file_path", "block_start")
        )
        pieces = F.explode(F.split("value", f"[{sep}]")).alias("value")
        parts.append(blocks.select(pieces, "file_path", "modified", "block_start", F.lit(0).cast("bigint").alias("size")))
    return reduce(DataFrame.union, parts)


def _piece(value: Column) -> Column:
    """Lines that are seen to be a part of a document, no JSON by themselves: they begin in the
    middle of an object, or end where another value must follow. Finding that out by parsing them
    costs an exception each, and a pretty-printed document has nothing but such lines."""
    goes_on = F.right(F.rtrim(value, F.lit(" \t\r\n")), F.lit(1)).isin(*"{[,:")
    # What follows a `]` without its `[` is not read.
    return value.rlike(r'^[ \t\r\n]*+(?:[},:]|"[^"\\]*+"[ \t\r\n]*+:)') | goes_on & ~F.contains(value, F.lit("]"))


def _parsed(texts: DataFrame) -> DataFrame:
    """Wrapped in brackets, so that a second value after the first is an error."""
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    filled = F.col("value").rlike(r"\S")
    whole = filled & ~_piece(F.col("value"))
    return texts.select(
        F.when(whole, F.try_parse_json(wrapped)).alias("json"),
        F.when(whole, F.try_parse_json(exact_json(wrapped))).alias("exact"),
        filled.alias("filled"),
        "file_path", "modified", "block_start", F.octet_length("value").alias("n_bytes"), "size",
    )


@contextmanager
def open_records(spark: SparkSession, files: list[SourceFile]) -> Iterator[DataFrame]:
    """Columns: record, exact, file_path, modified, block_start, seq.

    `exact` is the record with its numbers told apart, for hashing; null if it is the same.
    `seq` rises by one from record to record inside a (file_path, block_start). Records are
    kept while the block runs: each is parsed once, and `seq` comes from one plan, so it is the
    same for every reader, also after a lost executor.
    """
    lines = _texts(spark, files, "\n")
    parsed = _parsed(lines).persist()
    kept = [parsed]
    try:
        # One row per file of this batch comes back to the driver.
        forms = parsed.groupBy("file_path").agg(
            F.count_if("filled").alias("n"), F.count("json").alias("ok"),
            # Each line ends with one byte that is not read; a mark of three may stand first.
            (F.max("size") - F.sum(F.col("n_bytes") + 1) > 3).alias("unread"),
        )
        state = {_same(r.file_path): r for r in forms.collect()}
        by_line = {p for p, r in state.items() if r.ok == r.n and not r.unread}
        # A file of one line that is too long gave no line at all.
        documents = [f for f in files if _same(f.path) not in by_line]
        records = parsed
        if apart := [r.file_path for p, r in state.items() if p not in by_line]:
            records = parsed.filter(~F.col("file_path").isin(apart))
        every = _exploded(records)
        if documents:
            cut, bad = document_records(_texts(spark, documents, OPENS).drop("size"))
            opened = _opened(cut).persist()
            kept.append(opened)
            bad = {_same(p) for p in bad} | {_same(r.file_path) for r in opened.filter("json is null or seq < 0").select("file_path").distinct().collect()}
            if bad:
                raise MalformedJson([f.path for f in documents if _same(f.path) in bad])
            every = every.union(opened.select("record", "exact", "file_path", "modified", "block_start", "seq"))
        every = every.persist()
        kept.append(every)
        yield every
    finally:
        for df in kept:
            df.unpersist()


def _opened(cut: DataFrame) -> DataFrame:
    """Records of documents, parsed; json is null where one is no valid JSON."""
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    both = cut.select(
        F.try_parse_json(wrapped).cast("array<variant>").alias("json"), F.try_parse_json(exact_json(wrapped)).cast("array<variant>").alias("exact"),
        "file_path", "modified", F.lit(0).cast("bigint").alias("block_start"), F.col("number").alias("seq"),
    )
    # Nothing between two commas is no record.
    one = F.when(F.size("json") == 1, F.col("json"))
    return both.select(one.alias("json"), F.get("json", F.lit(0)).alias("record"), F.get("exact", F.lit(0)).alias("exact"), "file_path", "modified", "block_start", "seq")


def _exploded(parsed: DataFrame) -> DataFrame:
    """A line or document may itself be an array of records."""

    def values(json: str) -> Column:
        opened = F.transform(
            F.col(json).cast("array<variant>"),
            lambda e: F.coalesce(e.try_cast("array<variant>"), F.array(e)),
        )
        return F.coalesce(F.flatten(opened), F.array().cast("array<variant>"))

    # Equally long, or the second is empty and gives nulls.
    pairs = F.zip_with(
        values("json"), values("exact"), lambda r, e: F.struct(r.alias("record"), e.alias("exact"))
    )
    return parsed.select(F.inline(pairs), "file_path", "modified", "block_start").withColumn(
        "seq", F.monotonically_increasing_id()
    )
