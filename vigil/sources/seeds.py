"""Reference lists kept as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the facility master list.
FACILITY_SCHEMA = (
    "Code string, `Facility Name` string, Province string, County string, "
    "`Sub County` string, Ward string"
)


def facility_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=FACILITY_SCHEMA, enforceSchema=False)
