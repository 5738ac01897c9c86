"""Connected components of a graph given by its links, in rounds of joins.

Each round links every node's larger neighbours to its smallest one (large star), then
its smaller ones to the smallest (small star).  Rounds grow with the logarithm of the
longest path; the links of a round are written and read again, and the tables of the
round before are deleted, so lineage and disk stay one round deep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint
from strata.session import release


def _stars(links: DataFrame, smallest: DataFrame) -> DataFrame:
    return links.join(smallest, "u")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``links`` (two columns of long ids); root: the smallest node.

    Nulls, loops and repeated links are ignored; an empty table gives no rows."""
    a, b = links.columns[:2]
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    links = checkpoint(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                       cache=False)
    spark = links.sparkSession
    mark = _mark(links)
    while mark[0]:
        both = links.union(links.select("v", "u"))
        low = checkpoint(both.groupBy("u").agg(F.min("v").alias("m"))
                         .select("u", F.least("u", "m").alias("m")), cache=False)
        large = checkpoint(_stars(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                           .distinct(), cache=False)
        low2 = checkpoint(large.groupBy("u").agg(F.min("v").alias("m")), cache=False)
        small = _stars(large, low2).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = checkpoint(small.union(low2).distinct(), cache=False)
        now = _mark(after)
        release(spark, links, low, large, low2)
        links, same = after, now == mark
        mark = now
        if same:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    """Count and checksums of the links: two rounds with the same ones are the same."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first())
