"""Enrichment from code tables with fallbacks.

Two shapes:
* a fixed code table written in the code -> ``functions.clean.lookup`` (a literal
  map, evaluated inside the projection, no join at all);
* a code table that is itself data -> ``lookup_join``: a left join plus
  ``coalesce`` fallbacks, left to AQE, which broadcasts only what it has measured.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(df: DataFrame, ref: DataFrame, on: Column | str | list,
                fill: Mapping[str, object] | None = None) -> DataFrame:
    """Left-join ``ref`` and replace misses in ``fill`` columns by a literal or Column."""
    out = df.join(ref, on, "left")
    for c, default in (fill or {}).items():
        d = default if isinstance(default, Column) else F.lit(default)
        out = out.withColumn(c, F.coalesce(F.col(c), d))
    return out


def code_table(spark, mapping: Mapping, key: str, value: str) -> DataFrame:
    """A fixed mapping as a two-column DataFrame (size known: ``len(mapping)``)."""
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")
