"""Order of the rows of a stored table in which a filter on any of its clustering keys skips files.

Sorting by ``(a, b)`` lets filters on ``a`` skip, hardly those on ``b``.  Here every key is replaced by its rank
among ``2 ** bits`` quantile ranges, the bits of the ranks are interleaved, and rows are range-partitioned and sorted by
the result (a space-filling curve): each file covers a small range of every key, which Parquet's min/max statistics
show to later scans.

The bounds of the ranges are at most ``2 ** bits - 1`` values a key.  Those of numbers, dates and times come from one
aggregate of quantile sketches over the whole table; those of other types from the counts of at most ``VALUES`` of their
distinct values, chosen by hash.  Ranks are chosen by nested comparisons, ``bits`` a row and key.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
VALUES = 10_000


def _sketched(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _value_bounds(df: DataFrame, key: str, parts: int) -> list:
    """Quantiles of a key of any ordered type, by the counts of a bounded number of its values."""
    counts = (df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("v")).count()
              .orderBy(F.xxhash64("v"), "v").limit(VALUES).orderBy("v").collect())
    total = sum(r["count"] for r in counts)
    out, goal = [], 1
    for row, upto in zip(counts, accumulate(r["count"] for r in counts)):
        if goal < parts and upto * parts >= goal * total:
            out.append(row["v"])
            goal = upto * parts // total + 1
    return out


def bounds(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Upper ends of the quantile ranges of each key, ascending and distinct."""
    parts = 1 << bits
    kinds = {f.name: f.dataType for f in df.schema}
    sketched = [k for k in keys if _sketched(kinds[k])]
    shares = [i / parts for i in range(1, parts)]
    row = df.agg(*[F.percentile_approx(F.col(k), shares, 10 * parts).alias(k) for k in sketched]).first() if sketched else {}
    return {k: sorted(set(row[k] or [])) if k in sketched else _value_bounds(df, k, parts) for k in keys}


def rank(key: Column, ends: Sequence) -> Column:
    """Number of bounds below the value; null is 0."""
    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key <= F.lit(ends[middle]), among(low, middle)).otherwise(among(middle + 1, high))
    return F.when(key.isNull(), F.lit(0)).otherwise(among(0, len(ends)))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """One number that holds the bits of all ranks in turn, the highest bits first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for place, r in enumerate(ranks):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - place))
    return out


def curve(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> Column:
    """Place of a row on the curve through the ranks of its keys."""
    ends = bounds(df, keys, bits)
    # ranks of keys with few values are stretched, so that every key has a say from the highest bit on
    stretch = {k: (1 << bits) // (len(e) + 1) for k, e in ends.items()}
    return interleaved([rank(F.col(k), ends[k]) * stretch[k] for k in keys], bits)


def along_curve(df: DataFrame, keys: Sequence[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """The rows, range-partitioned and sorted along the curve; ``files``: partitions, left to AQE if None.

    A hash of the row is the last range key, so that rows at one place may spread over tasks."""
    plain = [c for c, t in df.dtypes if not t.startswith("map") and c not in keys]
    spread = F.xxhash64(*plain) if plain else F.rand(0)
    placed = df.withColumn("_place", curve(df, keys, bits))
    dealt = placed.repartitionByRange(*([files] if files else []), "_place", spread)
    return dealt.sortWithinPartitions("_place", *keys).drop("_place")


def file_ranges(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest value of a key in each file of a scanned table, as its statistics give them."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))


def share_read(df: DataFrame, key: str, low, high) -> float:
    """Share of a scanned table's files that a filter ``low <= key <= high`` cannot skip."""
    meets = (F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low))
    return file_ranges(df, key).agg(F.avg(F.coalesce(meets, F.lit(False)).cast("int"))).first()[0] or 0.0
