"""Row ids for landed records."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

_SHIFT = pa.schema([("file_path", pa.string()), ("block_start", pa.int64()), ("shift", pa.int64())])


def numbered(
    spark: SparkSession, records: DataFrame, reserve: Callable[[int], int]
) -> tuple[DataFrame, int]:
    """Give records rising ids in file order, without sorting or moving them.

    Only the record count per file block is gathered; a block's first id is the sum of the
    counts before it. `reserve(n)` gives the last id in use before n new ones. Returns the
    records and their number.
    """
    block = ["file_path", "block_start"]
    counts = (
        records.groupBy("modified", *block)
        .agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
        .collect()
    )
    base = reserve(sum(r.n for r in counts))
    offsets, total = [], 0
    for r in sorted(counts, key=lambda r: (r.modified, r.file_path, r.block_start)):
        shift_by = base + 1 + total - r.first_seq
        offsets.append(
            {"file_path": r.file_path, "block_start": r.block_start, "shift": shift_by}
        )
        total += r.n
    # A local relation has a known size: Spark broadcasts it, or not, by that.
    shift = spark.createDataFrame(pa.Table.from_pylist(offsets, _SHIFT))
    placed = records.join(shift, block, "left")
    return placed.withColumn("id", F.col("seq") + F.col("shift")).drop("shift", "seq"), total
