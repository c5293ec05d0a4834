"""Which record hashes a landing table holds, in files that a load need not all open.

Each load adds a run of the hashes it is about to store, sorted. A run counts once it is
committed, after the rows are stored; one left uncommitted by a load that broke is settled by
whether the table holds its hashes. When FANOUT runs of one level have come together they are
merged into one of the next level, so their number grows with the logarithm of the loads.
From level 1 on a run has a folder for each beginning of a hash and a Bloom filter in each
file: a load opens the folders its hashes can be in, and a load of a few records only the row
groups that can hold one of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.sources.files import create_file, exists, remove_folder, subfolders

HASH = "_raw_hash"
FANOUT = 8  # runs of a level that are merged into one
PREFIX = 2  # characters of a hash that name its folder
FEW = 10  # hashes that are looked up one by one

_RUN = f"{HASH} string, id bigint"


@dataclass(frozen=True, order=True)
class Run:
    """A run of level 0 holds one load; one of a higher level all runs of lower levels up to its number."""

    level: int
    number: int

    @property
    def name(self) -> str:
        return f"run-{self.level}-{self.number:08d}"

    @staticmethod
    def named(name: str) -> Run:
        _, level, number = name.split("-")
        return Run(int(level), int(number))


def _prefix() -> Column:
    # A letter first, so that no folder's name reads as a number.
    return F.concat(F.lit("h"), F.substring(HASH, 1, PREFIX))


class HashIndex:
    """One writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _path(self, run: Run) -> str:
        return f"{self.root}/{run.name}"

    def _committed(self, run: Run) -> str:
        return f"{self._path(run)}/committed"

    def _all(self) -> list[Run]:
        return sorted(Run.named(n) for n in subfolders(self.spark, self.root) if n.startswith("run-"))

    def runs(self) -> list[Run]:
        """Committed runs that no run of a higher level holds."""
        done = [r for r in self._all() if exists(self.spark, self._committed(r))]
        return [r for r in done if not any(o.level > r.level and o.number >= r.number for o in done)]

    def _read(self, runs: list[Run]) -> DataFrame:
        """Runs of level 0, or of higher levels, with the folder of each hash. They are few."""
        parts = [
            self.spark.read.schema(f"{_RUN}, prefix string" if r.level else _RUN).parquet(f"{self._path(r)}/hashes")
            for r in runs
        ]
        return reduce(DataFrame.union, parts)

    def holding(self, hashes: DataFrame) -> DataFrame | None:
        """Hashes of the index among which all of these are that it holds; None if it is empty.

        `hashes` is stored: their beginnings, at most 16 ** PREFIX of them, come to the driver.
        """
        runs = self.runs()
        recent, old = [r for r in runs if not r.level], [r for r in runs if r.level]
        parts = []
        if recent:
            parts.append(self._read(recent).select(HASH))
        if old:
            few = [r[0] for r in hashes.select(HASH).distinct().limit(FEW + 1).collect()]
            wanted = self._read(old)
            if len(few) <= FEW:
                wanted = wanted.filter(F.col("prefix").isin([f"h{h[:PREFIX]}" for h in few]) & F.col(HASH).isin(few))
            else:
                own = [r[0] for r in hashes.select(_prefix()).distinct().collect()]
                wanted = wanted.filter(F.col("prefix").isin(own)) if len(own) < 16**PREFIX else wanted
            parts.append(wanted.select(HASH))
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].union(parts[1])

    def add(self, hashes: DataFrame) -> Run:
        """Write a run of level 0, which does not count yet."""
        run = Run(0, max((r.number for r in self._all()), default=0) + 1)
        hashes.select(HASH, "id").sortWithinPartitions(HASH).write.parquet(f"{self._path(run)}/hashes")
        return run

    def read(self, run: Run) -> DataFrame:
        return self._read([run])

    def commit(self, run: Run) -> None:
        create_file(self.spark, self._committed(run))
        self._merge()

    def settle(self, stored: DataFrame | None) -> None:
        """Commit runs whose rows were stored before their load broke, and drop the others."""
        for run in self._all():
            if not exists(self.spark, self._committed(run)):
                kept = (
                    not run.level and stored is not None and exists(self.spark, f"{self._path(run)}/hashes/_SUCCESS")
                    and not stored.join(self._read([run]), [HASH, "id"], "left_semi").isEmpty()
                )
                if kept:
                    create_file(self.spark, self._committed(run))
                else:
                    remove_folder(self.spark, self._path(run))
        self._merge()

    def _merge(self) -> None:
        level = 0
        while True:
            live = self.runs()
            own = [r for r in live if r.level == level]
            if len(own) >= FANOUT:
                merged = Run(level + 1, max(r.number for r in own))
                (
                    self._read(own).select(HASH, "id").withColumn("prefix", _prefix())
                    .repartition("prefix").sortWithinPartitions("prefix", HASH)
                    .write.option(f"parquet.bloom.filter.enabled#{HASH}", "true").partitionBy("prefix")
                    .mode("overwrite").parquet(f"{self._path(merged)}/hashes")
                )
                create_file(self.spark, self._committed(merged))
                for run in own:
                    remove_folder(self.spark, self._path(run))
            elif not any(r.level > level for r in live):
                return
            level += 1
