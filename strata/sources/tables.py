"""A5: table scans.

Parquet is the storage format.  A scan is a plain ``spark.read.parquet`` so that
Catalyst pushes filters and prunes columns into the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Scan ``{base_dir}/{name}.parquet`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` scans orders.parquet."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.base_dir, name)

    def register_views(self, names=TEST_TABLES) -> None:
        for n in names:
            read_table(self.spark, self.base_dir, n).createOrReplaceTempView(n)
