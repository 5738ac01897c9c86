"""A1/A2: landed API documents -> DataFrames.

A1 ``read_entity_document``: a JSON object with a list under a key (``entidades``), one row per list element
(schema inferred by Spark's JSON reader), then flattened (B1) so the result has the flat column names of the
bronze table.

A2 ``read_panel_items``: a JSON array of one-key objects, one row per item; the items keep their key order,
which the unpivot (B2) needs.  Both documents are split over tasks (``sources/json_lists.py``), as are
JSON-lines files (one item per line).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.flatten import flatten, json_schema, split_mixed_lists, unpivot_panel
from strata.sources.json_lists import json_elements

FILE_COL, TIME_COL = "nome_arquivo", "data_insercao"


def read_entity_document(spark: SparkSession, path: str, list_key: str = "entidades",
                         flat: bool = True, lineage: bool = False) -> DataFrame:
    """A1: ``{list_key: [ {...}, ... ]}`` files -> one (flattened) row per element.

    A damaged document or one without ``list_key`` raises, like the API client it replaces.
    ``lineage`` adds the source file name and load time (A12).
    """
    items = json_elements(spark, path, list_key)
    return parse_entities(items, flat, lineage)


def parse_entities(items: DataFrame, flat: bool = True, lineage: bool = False) -> DataFrame:
    """B1 on the elements of documents (``item, file``)."""
    schema = json_schema(items.select("item"), "FAILFAST")
    extra = [F.element_at(F.split("file", "/"), -1).alias(FILE_COL)] if lineage else []
    both = items.select(F.parse_json("item").alias("_doc"),
                        F.from_json("item", schema, {"mode": "FAILFAST"}).alias("_e"), *extra)
    rows = split_mixed_lists(both, "_doc", "_e", schema).select("_e.*", *([FILE_COL] if lineage else []))
    out = flatten(rows) if flat else rows
    return out.withColumn(TIME_COL, F.current_timestamp()) if lineage else out


def read_panel_items(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """A2: panel file(s) -> one row per item (JSON text in ``item``, file in ``nome_arquivo``).

    A file that isn't a JSON array raises; so does a damaged item when it is unpivoted."""
    if json_lines:
        return (spark.read.text(path)
                .select(F.trim("value").alias("item"),
                        F.col("_metadata.file_name").alias(FILE_COL))
                .filter(F.length("item") > 0))
    return json_elements(spark, path).select("item", F.element_at(F.split("file", "/"), -1).alias(FILE_COL))


def read_panel(spark: SparkSession, path: str, fields=None, json_lines: bool = False,
               lineage: bool = False) -> DataFrame:
    """A2 + B2: panel file(s) -> long indicator rows."""
    items = read_panel_items(spark, path, json_lines)
    out = unpivot_panel(items, "item", fields=fields, keep=[FILE_COL] if lineage else ())
    return out.withColumn(TIME_COL, F.current_timestamp()) if lineage else out
