"""One row per key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vigil.session import SPLIT_BYTES, stored_bytes

_KEY, _RANK, _PLACE, _FILE, _ROW = "__key", "__rank", "__place", "__file", "__row"
APART_BYTES = SPLIT_BYTES  # smaller tables are ranked whole
APART_COLUMNS = 10  # rows of fewer are hardly wider than what ranks them
APART_ROWS = 1 << 31  # a bit for each is broadcast


def latest_per_key(df: DataFrame, key: Column, ingested_at: str, row_id: str) -> DataFrame:
    """Keep the newest row of each key: latest ingest time (null last), then highest id.

    Filtering the rank to 1 lets Spark keep one row per key inside every map task before
    the shuffle, so a key holding a third of all rows sends one row per task.

    Wide rows of a large stored table are not shuffled at all: what ranks them is ranked with
    their places in the files, and a second scan keeps the places found, from a broadcast list of
    a bit per row.
    """
    placed = _placed(df)
    if placed is None:
        return _newest(df.withColumn(_KEY, key), ingested_at, row_id).drop(_KEY)
    newest = _newest(placed.select(key.alias(_KEY), ingested_at, row_id, _PLACE), ingested_at, row_id)
    word = F.shiftright(_PLACE, 6)
    bit = (F.col(_PLACE) % 64).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = newest.groupBy(word.alias("__word")).agg(F.bit_or(one).alias("__bits"))
    within = (F.col("__word") % 64).cast("int")
    found = words.groupBy(F.shiftright("__word", 6).alias("__block")).agg(
        F.map_from_entries(F.collect_list(F.struct(within, "__bits"))).alias("__found")
    )
    numbers = F.sequence(F.lit(0), F.lit(63))
    blocks = found.select(
        "__block", F.transform(numbers, lambda i: F.coalesce(F.element_at("__found", i), F.lit(0))).alias("__words")
    )
    bits = F.get("__words", (word % 64).cast("int"))
    return (
        placed.join(F.broadcast(blocks), F.shiftright(_PLACE, 12) == F.col("__block"))
        .filter(F.getbit(bits, bit) == 1)
        .select(df.columns)
    )


def _newest(df: DataFrame, ingested_at: str, row_id: str) -> DataFrame:
    order = W.partitionBy(_KEY).orderBy(
        F.col(ingested_at).desc_nulls_last(), F.col(row_id).desc()
    )
    return df.withColumn(_RANK, F.row_number().over(order)).filter(F.col(_RANK) == 1).drop(_RANK)


def _placed(df: DataFrame) -> DataFrame | None:
    """The rows of a large and wide stored table with a number each, the same whenever they are
    read; None for others. Numbers run file after file, and the driver gets a row per file."""
    if len(df.columns) < APART_COLUMNS or not _rows_of_files(df) or stored_bytes(df) < APART_BYTES:
        return None
    try:
        rows = df.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
    except AnalysisException:  # not a format that numbers rows
        return None
    starts, total = [], 0
    for file, last in sorted(rows.groupBy(_FILE).agg(F.max(_ROW)).collect()):
        starts.append((file, total))
        total += last + 1
    if not 0 < total <= APART_ROWS:
        return None
    first = df.sparkSession.createDataFrame(starts, f"{_FILE} string, {_PLACE} bigint")
    placed = rows.join(F.broadcast(first), _FILE)
    return placed.withColumn(_PLACE, F.col(_PLACE) + F.col(_ROW)).drop(_FILE, _ROW)


def _rows_of_files(df: DataFrame) -> bool:
    """Whether each row is one of a stored table, some perhaps left out."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def representative_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One spelling per case-insensitive key; null and empty count as the same key.

    `order` must decide between any two rows. Equal rows collapse before ranking, so the
    ranking sees distinct spellings only.
    """
    folded = [F.lower(F.coalesce(F.col(k), F.lit(""))) for k in keys]
    return (
        df.distinct()
        .withColumn(_RANK, F.row_number().over(W.partitionBy(*folded).orderBy(*order)))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def first_per_key(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """Keep the row with the lowest id of each key."""
    ranked = F.row_number().over(W.partitionBy(key).orderBy(row_id))
    return df.withColumn(_RANK, ranked).filter(F.col(_RANK) == 1).drop(_RANK)


def unseen(df: DataFrame, key: str, row_id: str, stored: DataFrame | None) -> DataFrame:
    """First row of each key that the stored side does not hold.

    The stored keys are cut down to the batch's before anything is compared: a small batch
    is broadcast to their scan, and the large side is not shuffled.
    """
    once = first_per_key(df, key, row_id)
    if stored is None:
        return once
    known = stored.select(key).join(df.select(key).distinct(), key, "left_semi")
    return once.join(known, key, "left_anti").select(df.columns)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, as a data-quality report."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
