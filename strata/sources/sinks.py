"""File and table sinks, CSV scan, inline rows.

Every writer overwrites whole outputs (or writes a new snapshot), so a retried
task or a rerun of the job leaves the same files; nothing is written through
the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.layout import along_curve
from strata.operators.watch import Watch


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
             infer: bool = False) -> DataFrame:
    """A4: CSV with a header.  An explicit (string) schema keeps leading zeros of
    ids and postal codes and ``yyyy-MM`` text, which inference would change (T5, T6)."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV with a header, the frame's columns or ``columns`` (those it lacks are empty cells); empty input is an error.

    Quotes within a value are doubled, so that any reader takes them."""
    if df.isEmpty():
        raise ValueError(f"refusing to write an empty CSV to {path}")
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def first_seen_keys(records: DataFrame, col: str, order: Sequence[str]) -> list[str]:
    """Keys of all JSON objects of a column, in the order in which a reader from top to bottom meets them.

    ``order``: columns that give the place of a record; one row a key is collected."""
    keys = records.select(*order, F.posexplode(F.json_object_keys(col)).alias("place", "key"))
    first = keys.groupBy("key").agg(F.min(F.struct(*order, "place")).alias("first"))
    return [r["key"] for r in first.orderBy("first").collect()]


def in_order_of_keys(columns: Sequence[str], keys: Sequence[str], sep: str = "_") -> list[str]:
    """Flattened column names in the order of the keys that they come from (the longest that fits); others last."""
    def place(name: str) -> int:
        fits = [k for k in keys if name == k or name.startswith(k + sep)]
        return keys.index(max(fits, key=len)) if fits else len(keys)
    keys = list(keys)
    return sorted(columns, key=place)


def write_raw_json(df: DataFrame, path: str) -> None:
    """JSON lines, UTF-8 kept as is, null fields kept, whole-output overwrite."""
    df.write.mode("overwrite").option("encoding", "UTF-8").option("ignoreNullFields", False).json(path)


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-partition by the clustering keys and sort inside each file, so
    parquet min/max statistics let later filters on the first of those keys skip files
    (``operators/layout.py``: on any of them).

    A hash of the row is the last range key: rows that share a common clustering value spread
    over several tasks.  The number of partitions is left to AQE."""
    plain = [c for c, t in df.dtypes if not t.startswith("map") and c not in keys]
    spread = F.xxhash64(*plain) if plain else F.rand(0)
    return df.repartitionByRange(*keys, spread).sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, cluster_by: Sequence[str] | None = None,
                partition_by: Sequence[str] | None = None, watch: Watch | None = None) -> None:
    """Full overwrite with schema replacement (parquet); several clustering keys share a curve.

    ``watch`` counts among the rows as they are written."""
    out = df
    if cluster_by:
        out = clustered(df, cluster_by) if len(cluster_by) == 1 else along_curve(df, cluster_by)
    if watch:
        out = watch.over(out)
    w = out.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def create_if_absent(spark: SparkSession, table: str, ddl: str) -> None:
    """A10: typed, empty table when it does not exist yet."""
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], ddl).write.format("parquet").saveAsTable(table)


def inline_rows(spark: SparkSession, rows: Sequence[dict | tuple], schema: str) -> DataFrame:
    """Literal rows as a DataFrame (no SQL text is built from the values)."""
    return spark.createDataFrame(list(rows), schema)
