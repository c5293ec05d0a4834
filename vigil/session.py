"""Session settings the library relies on."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 128 << 20
UNPACKED = 3  # rows in a shuffle against compressed files

SPLIT_BYTES = 32 << 20
# A row group is read by one task, whatever the splits: files of larger ones would not be split.
# Ids and hashes, most of what a model stores, take a quarter less in zstd than in Spark's own choice.
STORED = {"parquet.block.size": str(SPLIT_BYTES), "compression": "zstd"}
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
HASHED_SIDE = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

REQUIRED_CONF = {
    # Dates, days and weeks are computed in UTC; local days use an explicit zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: right-sized partitions, measured broadcasts, skewed joins split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not compile a method over 8000 bytes; see `small_methods`.
    METHOD_LIMIT: "65535",
    # A task that ranks wide rows sorts them first: as Parquet they are some 15 times smaller.
    "spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES),
    # So are keys before a landing row is rendered from them.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SPLIT_BYTES // 2),
}
# Settings that count only when the application starts. The plans compile to many classes, which
# must stay cached and be compiled to machine code.
START_CONF = {
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "vigil", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the number of shuffle partitions to what the input needs, never lower it.

    Adaptive execution merges partitions that turn out small but makes no more of them, so
    at scale the number to start from decides whether a partition fits in memory.
    """
    needed = math.ceil(input_bytes * UNPACKED / PARTITION_BYTES)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if needed > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return max(needed, current)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """`size_shuffles` for the length of a block; the session's number is put back after it."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        yield size_shuffles(spark, input_bytes)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """For the length of a block, let no generated method be too large for HotSpot to compile.

    It pays where rows get many computed columns, which come as one method otherwise and are
    interpreted; not where they pass many joins, as each then copies the row.
    """
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """For the length of a block, let shuffled joins whose partitions are small on one side hash that
    side, so that the wide rows of the other need no sort."""
    before = spark.conf.get(HASHED_SIDE)
    spark.conf.set(HASHED_SIDE, str(SPLIT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(HASHED_SIDE, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """For the length of a block, let a query's shuffle files go when it ends.

    Otherwise they stay until the driver's JVM happens to collect what refers to them, and a chain
    of stored models keeps the shuffles of all of them on disk.
    """
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def stored_bytes(df: DataFrame) -> int:
    """Size of the files a table is read from, as Spark's statistics have it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a session without that setting (a local test) gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="vigil-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")
