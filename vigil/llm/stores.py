"""Intermediate tables in the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.session import shared_dir


def spare(docs: DataFrame, name: str) -> str:
    """A column name like `name` that docs does not have, in either case of letters."""
    taken = {c.lower() for c in docs.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name += "_"
    return name


def quoted(names: list[str]) -> list[str]:
    """Column names as select() takes them, with points and backticks in them."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


class Store:
    """Parquet tables of one run. A written table cuts lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, names: list[str]) -> DataFrame:
        """Tables of one schema that are kept under these names, as one."""
        return self.spark.read.parquet(*[f"{self.root}/{name}" for name in names])


def least_label(edges: DataFrame, store: Store, name: str) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), for nodes with an edge.

    Labels spread along edges and then jump to the label of the label, so the number of
    rounds grows with the logarithm of the longest chain. Nothing is gathered outside
    Spark's tables but the number of labels that changed.
    """
    both = store.keep(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), f"{name}-edges"
    )
    labels = store.keep(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("component")),
        f"{name}-0",
    )
    step = 0
    while True:
        step += 1
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        )
        low = labels.join(near, "node").select(
            "node", F.least("component", "m").alias("component"), (F.col("m") < F.col("component")).alias("moved")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = store.keep(
            low.join(jump, "component", "left")
            .select("node", F.least("component", "further").alias("component"), "moved"),
            f"{name}-{step}",
        )
        # Settled once no edge lowers a label: then both ends of every edge agree.
        if labels.filter("moved").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
