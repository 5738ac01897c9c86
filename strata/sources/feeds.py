"""A3: RSS feeds landed as XML files -> one row per ``item``.

A feed is read as text records that end at ``</item``, so large ones are split over tasks, and each item is parsed
by itself (Spark's ``from_xml``): an item that cannot be parsed does not take the rest of its file with it.  It
keeps its text in ``DAMAGED`` and its fields are null: ``damage`` gives the conditions that count such items a
source while the feeds are written, and ``whole`` takes them out.  An item without end takes the next one with it and counts as
one damaged item.  Items are tagged with their source's name and category; a feed that is not there is skipped
with a warning, the others continue.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

ITEM_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("pubDate", T.StringType()),
    T.StructField("description", T.StringType()),
])


#: Column with the text of an item that could not be parsed.
DAMAGED = "damaged_item"


def read_feed(spark: SparkSession, path: str, source: str, category: str) -> DataFrame:
    """One landed feed (file or folder) -> items with source columns and ``DAMAGED``."""
    schema = T.StructType([*ITEM_SCHEMA.fields, T.StructField(DAMAGED, T.StringType())])
    records = spark.read.option("lineSep", "</item").text(path)
    item = F.regexp_extract("value", r"(?s)(<item[\s>/].*)", 1)
    read = F.from_xml(F.concat(item, F.lit("</item>")), schema,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED})
    df = records.where(item != "").select(read.alias("i")).select("i.*")
    return df.select(F.lit(source).alias("source"), F.lit(category).alias("category"),
                     "title", "link", F.col("pubDate").alias("pub_date"), "description", DAMAGED)


def read_feeds(spark: SparkSession, feeds: Sequence[tuple[str, str, str]]) -> DataFrame | None:
    """``[(path, source, category), ...]`` -> union of all feeds that are there."""
    frames = []
    for path, source, category in feeds:
        try:
            frames.append(read_feed(spark, path, source, category))
        except AnalysisException as e:  # one missing feed must not stop the others
            log.warning("skipping feed %s (%s): %s", source, path, str(e)[:200])
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def damage(sources: Sequence[str]) -> dict[str, Column]:
    """Conditions for the damaged items of each source."""
    return {s: (F.col("source") == s) & F.col(DAMAGED).isNotNull() for s in sources}


def whole(items: DataFrame) -> DataFrame:
    """Items without the damaged ones."""
    return items.where(F.col(DAMAGED).isNull()).drop(DAMAGED)
