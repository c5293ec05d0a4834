"""What a folder's files would add to a landing table. Writes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.sources.files import list_files
from vigil.sources.flatten import discover
from vigil.sources.landing import LandingTable
from vigil.sources.naming import distinct_names
from vigil.sources.numbering import numbered
from vigil.sources.records import open_records

_SCHEMA = "column string, type string, is_new boolean, path string"


def preview_schema(
    spark: SparkSession, folder: str, sample: int | None = 20, table: LandingTable | None = None
) -> DataFrame:
    """Inferred columns of the oldest `sample` files, or of all files for None."""
    files = [f for f in list_files(spark, folder) if f.length][:sample]
    if not files:
        return spark.createDataFrame([], _SCHEMA)
    with open_records(spark, files) as records:
        leaves = discover(numbered(spark, records, lambda n: 0)[0], "record", "id")
    known = table.columns() if table else []
    names = distinct_names([x.path for x in leaves], {r.path: r.name for r in known})
    types = {r.name: r.type for r in known}
    rows, seen = [], set()
    for leaf in leaves:
        name = names[leaf.path]
        if name not in seen:
            kind = types.get(name, "boolean" if leaf.is_boolean else "string")
            rows.append((name, kind, name not in types, leaf.path))
            seen.add(name)
    return spark.createDataFrame(rows, _SCHEMA).orderBy(F.col("column"))
