"""Landing tables: append-only Parquet whose columns only ever grow.

A small column list beside the data holds each path's column and type. Reading with the
schema made from it needs no merging of Parquet footers, however many files there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vigil.sources.files import exists
from vigil.sources.flatten import Leaf
from vigil.sources.hash_index import HashIndex, Run
from vigil.sources.naming import distinct_names

ENVELOPE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_source", T.StringType()),
        T.StructField("_batch_id", T.StringType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_raw_hash", T.StringType()),
        T.StructField("_processed", T.BooleanType()),
        T.StructField("_rescued_data", T.StringType()),
    ]
)
_COLUMNS = "path string, name string, type string"
_IDS = "last_id bigint"


class LandingTable:
    """One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name = spark, name
        self.base = f"{root.rstrip('/')}/{name}"
        self.data, self.column_list = f"{self.base}/data", f"{self.base}/columns"
        self.loads, self.ids = f"{self.base}/loads", f"{self.base}/ids"
        self.hashes = HashIndex(spark, f"{self.base}/hashes")

    def columns(self) -> list[T.Row]:
        if not exists(self.spark, self.column_list):
            return []
        rows = self.spark.read.schema(_COLUMNS).parquet(self.column_list)
        return rows.orderBy("name").collect()

    def schema(self) -> T.StructType:
        kinds = {"boolean": T.BooleanType(), "string": T.StringType()}
        fields = [T.StructField(r.name, kinds[r.type]) for r in self.columns()]
        return T.StructType(ENVELOPE.fields + fields)

    def read(self) -> DataFrame:
        if not exists(self.spark, self.data):
            return self.spark.createDataFrame([], self.schema())
        return self.spark.read.schema(self.schema()).parquet(self.data)

    def evolve(self, leaves: list[Leaf]) -> tuple[dict[str, str], dict[str, str], list[str]]:
        """Add what is new. Returns names by path, types by column, and the added columns."""
        known = self.columns()
        names = distinct_names([x.path for x in leaves], {r.path: r.name for r in known})
        types = {r.name: r.type for r in known}
        added: dict[str, str] = {}
        for leaf in leaves:
            # The first type seen for a name holds, in the table and among what is added.
            if names[leaf.path] not in types:
                added.setdefault(names[leaf.path], "boolean" if leaf.is_boolean else "string")
        if added:
            path_of = {name: path for path, name in names.items()}
            rows = [(path_of[n], n, kind) for n, kind in sorted(added.items())]
            self.spark.createDataFrame(rows, _COLUMNS).coalesce(1).write.mode("append").parquet(
                self.column_list
            )
        return names, {**types, **added}, sorted(added)

    def reserve_ids(self, n: int) -> int:
        """Claim n ids and return the last one in use before them.

        The claim is stored before any row is: a load that fails leaves a gap, never a
        repeat, and the next id is known without reading the table.
        """
        last = 0
        if exists(self.spark, self.ids):
            claims = self.spark.read.schema(_IDS).parquet(self.ids)
            last = claims.agg(F.max("last_id")).first()[0] or 0
        if n:
            claim = self.spark.createDataFrame([(last + n,)], _IDS).coalesce(1)
            claim.write.mode("append").parquet(self.ids)
        return last

    def unseen(self, records: DataFrame) -> tuple[DataFrame, Run]:
        """First record of each hash the table does not hold, and the run of their hashes to hand
        to `append`. Needs `_raw_hash` and `id`, which must be the same whenever they are read.

        Only hashes and ids are compared; a record itself moves at most once, to meet its id and
        the hash that was made for the comparison.
        """
        self._catch_up()
        once = records.groupBy("_raw_hash").agg(F.min("id").alias("id"))
        path = f"{self.base}/arriving"
        once.write.mode("overwrite").parquet(path)
        arriving = self.spark.read.schema(once.schema).parquet(path)
        held = self.hashes.holding(arriving)
        run = self.hashes.add(arriving if held is None else arriving.join(held, "_raw_hash", "left_anti"))
        return records.drop("_raw_hash").join(self.hashes.read(run), "id"), run

    def _catch_up(self) -> None:
        stored = None
        if exists(self.spark, self.data):
            stored = self.spark.read.schema("id bigint, _raw_hash string").parquet(self.data)
        self.hashes.settle(stored)
        # Rows of a table from before it had an index, or whose index was lost.
        if stored is not None and not self.hashes.runs():
            self.hashes.commit(self.hashes.add(stored))

    def append(self, rows: DataFrame, run: Run) -> None:
        """Store new rows; their hashes count from then on."""
        rows.write.mode("append").parquet(self.data)
        self.hashes.commit(run)
