"""Surrogate keys (G16), deterministic dedup (F4) and the key-uniqueness check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts, sep: str = "||") -> Column:
    """SHA-256 hex of the parts joined by ``sep``; null parts count as ``''``.

    Dates render as ``yyyy-MM-dd`` (the string cast), so the key is stable across runs.
    """
    return F.sha2(F.concat_ws(sep, *[F.coalesce(_c(p).cast("string"), F.lit(""))
                                     for p in parts]), 256)


def dedup_by_key(df: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str | Column] | None = None,
                 keep: str = "first") -> DataFrame:
    """one row per key; the survivor is the smallest (``keep='first'``) or largest
    row by ``order_by`` and then by all remaining columns, so reruns agree.

    Written as a grouped ``min``/``max`` of a struct, which combines map-side: a key
    holding a third of the rows is reduced inside each map task before the shuffle,
    instead of being sorted in one window partition.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order_exprs = [(_c(o)) for o in (order_by or [])]
    ordered = [e.alias(f"_o{i}") for i, e in enumerate(order_exprs)]
    packed = F.struct(*ordered, *[F.col(c) for c in rest])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    out = df.groupBy(*keys).agg(pick.alias("_w"))
    return out.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts (partial aggregate)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, keys: Sequence[str], sample: int = 5) -> None:
    """T2 guard: raise with a few offending keys when ``keys`` is not unique."""
    dups = duplicate_keys(df, keys).limit(sample).collect()
    if dups:
        shown = ", ".join(str(tuple(r)) for r in dups)
        raise ValueError(f"duplicate merge keys on {list(keys)}: {shown}")
