"""Files to landing tables, in batches until the folder holds nothing new.

A ledger of path, modification time and length is the list of work done. It is written after
the rows, so what is listed and not in the ledger is loaded: a file of any age or name, and a
file sent again under its name with other content. A batch reads its files, keeps records
whose hash is new, widens the table if needed and appends; run twice, it adds nothing the
second time. Content changed within one tick of the store's clock and of equal length cannot
be told from the old.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from vigil.session import hashed_joins, sized_shuffles
from vigil.sources.files import (
    SourceFile, copy_file, data_folder, exists, list_files, move_unchanged,
)
from vigil.sources.flatten import MAX_DEPTH, discover, flat_columns, record_hash
from vigil.sources.landing import LandingTable
from vigil.sources.numbering import numbered
from vigil.sources.records import MalformedJson, open_records
from vigil.sources.specs import SourceSpec

_LEDGER = "path string, modified bigint, length bigint, problem string"
_LOAD_SCHEMA = (
    "batch bigint, loaded_at timestamp, files_processed bigint, rows_inserted bigint, "
    "rows_deduped bigint, columns_added array<string>, files_rejected array<string>"
)


@dataclass
class Load:
    batch: int
    loaded_at: datetime
    files_processed: int
    rows_inserted: int
    rows_deduped: int
    columns_added: list[str]
    files_rejected: list[str]


def _file_batch_id(table: str, batch: int) -> Column:
    """One id per file and batch, the same when the batch is run again."""
    stamp = F.unix_micros("modified").cast("string")
    digest = F.md5(F.concat_ws("|", F.lit(f"{table}|{batch}"), "file_path", stamp))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _append(
    table: LandingTable, source: str, records: DataFrame, batch: int, now: datetime, max_depth: int,
    renamed: dict[str, str],
) -> tuple[int, list[str]]:
    """Widen the table, write the new records, return their number and the added columns.

    Columns are found in all records: those of a repeat are those of its first, which has the
    smaller id or is stored. The new ones are made once, and counted as they are written.
    """
    leaves = discover(records, "record", "id", max_depth)
    names, types, added = table.evolve(leaves)
    columns, rescued = flat_columns(F.col("record"), leaves, names, types, max_depth)
    path = F.col("file_path")
    for copy, original in renamed.items():
        path = F.when(F.endswith("file_path", F.lit(copy)), original).otherwise(path)
    envelope = {
        "id": F.col("id"),
        "_ingested_at": F.lit(now),
        "_source": F.lit(source),
        "_batch_id": _file_batch_id(table.name, batch),
        "_source_file": F.regexp_replace(path, f"^.*?/(?={source}_raw/)", ""),
        "_raw_hash": F.col("_raw_hash"),
        "_processed": F.lit(False),
        "_rescued_data": rescued,
    }
    fresh, run = table.unseen(records)
    written = Observation()
    table.append(
        fresh.select(*(c.alias(n) for n, c in {**envelope, **columns}.items())).observe(written, F.count("*").alias("n")), run
    )
    return written.get["n"], added


def _readable(table: LandingTable, files: list[SourceFile]) -> Iterator[tuple[SourceFile, SourceFile]]:
    """Each file with the one to read: Spark passes over names that start with `_` or `.`, so
    such a file is read from a copy under a plain name."""
    for f in files:
        folder, _, name = f.path.rpartition("/")
        if name.startswith(("_", ".")):
            key = hashlib.md5(f"{f.path}|{f.modified}".encode()).hexdigest()
            copy = f"{table.base}/renamed/{key}/{name.lstrip('_.') or 'file'}"
            yield f, replace(f, path=copy_file(table.spark, f, copy))
        else:
            yield f, f


def load_files(
    table: LandingTable, source: str, files: list[SourceFile], batch: int = 0,
    max_depth: int = MAX_DEPTH,
) -> Load:
    """Append the new records of the files and report what happened.

    A file that is no JSON is named in the report and keeps no other file back.
    """
    spark, now = table.spark, datetime.now(timezone.utc)
    wanted, rejected = list(_readable(table, files)), []
    inserted, total, added = 0, 0, []
    while wanted:
        try:
            with sized_shuffles(spark, sum(f.length for f in files)), hashed_joins(spark):
                inserted, total, added = _load(
                    table, source, wanted, batch, now, max_depth
                )
            break
        except MalformedJson as problem:
            bad = set(problem.paths)
            rejected += [f.path for f, read in wanted if read.path in bad]
            wanted = [(f, read) for f, read in wanted if read.path not in bad]
    load = Load(batch, now, len(wanted), inserted, total - inserted, added, sorted(rejected))
    spark.createDataFrame([tuple(asdict(load).values())], _LOAD_SCHEMA).coalesce(
        1
    ).write.mode("overwrite").parquet(f"{table.loads}/load={batch}")
    return load


def _load(
    table: LandingTable, source: str, files: list[tuple[SourceFile, SourceFile]], batch: int,
    now: datetime, max_depth: int,
) -> tuple[int, int, list[str]]:
    """Number of new records, of all records, and the added columns."""
    renamed = {
        read.path[read.path.index("/renamed/") :]: f.path for f, read in files if f.path != read.path
    }
    with open_records(table.spark, [read for _, read in files]) as records:
        placed, total = numbered(table.spark, records, table.reserve_ids)
        told_apart = record_hash(F.col("record"), F.col("exact"))
        hashed = placed.withColumn("_raw_hash", told_apart).drop("exact")
        inserted, added = _append(table, source, hashed, batch, now, max_depth, renamed) if total else (0, [])
    return inserted, total, added


def source_folder(spark: SparkSession, spec: SourceSpec, raw_root: str) -> str | None:
    base = f"{raw_root.rstrip('/')}/{spec.base}"
    if spec.folder is None:
        return data_folder(spark, base)
    folder = f"{base}/{spec.folder}"
    return folder if exists(spark, folder) else None


class Ledger:
    """Which files have been dealt with, and what was wrong with those that were rejected."""

    def __init__(self, spark: SparkSession, root: str, table: LandingTable):
        self.spark, self.path, self.table = spark, f"{root.rstrip('/')}/{table.name}/files", table

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{_LEDGER}, batch bigint")
        return self.spark.read.schema(f"{_LEDGER}, batch bigint").parquet(self.path)

    def next_batch(self) -> int:
        """After the last one here; after the last one reported if the ledger is lost."""
        if exists(self.spark, self.path):
            return self.rows().agg(F.max("batch")).first()[0] + 1
        if exists(self.spark, self.table.loads):
            return self.spark.read.parquet(self.table.loads).agg(F.max("batch")).first()[0] + 1
        return 0

    def split(self, files: list[SourceFile]) -> tuple[list[SourceFile], list[SourceFile]]:
        """Files to load, and files that were loaded and lie there still; oldest first."""
        if not files:
            return [], []
        key = ["path", "modified", "length"]
        listed = self.spark.createDataFrame([(f.path, f.modified, f.length) for f in files], key)
        known = self.rows().groupBy(key).agg(F.max("problem").alias("problem"), F.lit(True).alias("done"))
        state = listed.join(known, key, "left").orderBy("modified", "path").collect()
        new = [SourceFile(r.path, r.modified, r.length) for r in state if not r.done]
        old = [SourceFile(r.path, r.modified, r.length) for r in state if r.done and not r.problem]
        return new, old

    def add(self, files: list[SourceFile], rejected: list[str], batch: int) -> None:
        bad = set(rejected)
        rows = [(f.path, f.modified, f.length, "no valid JSON" if f.path in bad else None) for f in files]
        self.spark.createDataFrame(rows, _LEDGER).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/batch={batch}"
        )


def batches(files: list[SourceFile], max_files: int, max_bytes: int) -> Iterator[list[SourceFile]]:
    """Runs of files in order, within both bounds; a larger file is a batch by itself."""
    batch, size = [], 0
    for f in files:
        if batch and (len(batch) == max_files or size + f.length > max_bytes):
            yield batch
            batch, size = [], 0
        batch.append(f)
        size += f.length
    if batch:
        yield batch


def ingest(
    spark: SparkSession,
    spec: SourceSpec,
    raw_root: str,
    landing_root: str,
    checkpoint_root: str,
    max_files: int = 1000,
    max_bytes: int = 1 << 40,
    archive: bool = True,
) -> list[Load] | None:
    """Load everything that has arrived, oldest files first; None if there is no folder.

    With `archive`, loaded files move to `_processed_<base>/<folder>` once they are in the
    ledger, unless they have changed since they were listed: then the next run loads them
    again. Rejected files stay where they are and are tried again when they change.
    """
    folder = source_folder(spark, spec, raw_root)
    if folder is None:
        return None
    table = LandingTable(spark, landing_root, spec.table)
    ledger = Ledger(spark, checkpoint_root, table)

    def put_away(files: list[SourceFile]) -> None:
        if archive:
            inside = f"/{spec.base}/"
            to = f"{raw_root.rstrip('/')}/_processed_{spec.base}"
            move_unchanged(spark, [(f, f"{to}/{f.path.rpartition(inside)[2]}") for f in files])

    new, left_over = ledger.split(list_files(spark, folder))
    put_away(left_over)
    loads, number = [], ledger.next_batch()
    for number, batch in enumerate(batches(new, max_files, max_bytes), number):
        filled, rejected = [f for f in batch if f.length], []
        if filled:
            loads.append(load_files(table, spec.source, filled, number))
            rejected = loads[-1].files_rejected
        ledger.add(batch, rejected, number)
        put_away([f for f in batch if f.path not in set(rejected)])
    return loads
