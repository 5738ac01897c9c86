"""H2/H3: keyed merge (upsert) of a source batch into a target table.

Parquet has no ``MERGE``; the merge is a full-outer join on the key with an
action column, producing the next snapshot of the table:

* ``update``  matched and (``condition`` is None, or the condition holds):
  ``update_cols`` take the source value, ``on_update`` columns are set;
* ``keep``    matched, condition false: the target row is unchanged;
* ``insert``  only in the source: every column from the source, ``on_insert`` set;
* ``retain``  only in the target: unchanged (a merge never deletes).

The value-change condition of H2 is ``t.v <> s.v OR t.v IS NULL``: a null source
value never clears an old one, and null/null still counts as an update (its
timestamp is touched).

Scale: the join shuffles both sides on the key once (a full outer join is always a
sort-merge join).  Snapshots are written to a new folder, never overwritten while being read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import assert_unique, dedup_by_key

UPDATE, KEEP, INSERT, RETAIN = "update", "keep", "insert", "retain"


def value_changed(col: str) -> Column:
    """H2 condition on ``t.<col>`` vs ``s.<col>`` (null-aware as in SQL)."""
    t, s = F.col(f"_t.{col}"), F.col(f"_s.{col}")
    return F.coalesce(t != s, F.lit(False)) | t.isNull()


def keyed_merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
                update_cols: Sequence[str] | None = None,
                condition: Column | None = None,
                on_update: Mapping[str, Column] | None = None,
                on_insert: Mapping[str, Column] | None = None,
                duplicates: str = "error", dedup_order: Sequence[str] | None = None,
                action_col: str = "_action") -> DataFrame:
    """Merge ``source`` into ``target`` by ``keys``; returns the merged rows + action.

    ``update_cols`` defaults to every non-key target column.  ``duplicates``:
    ``'error'`` raises on repeated source keys (T2), ``'last'`` keeps the largest row
    by ``dedup_order``, ``'ignore'`` skips the check (caller guarantees uniqueness).
    """
    keys = list(keys)
    cols = target.columns
    update_cols = list(update_cols) if update_cols is not None else \
        [c for c in cols if c not in keys]
    on_update = dict(on_update or {})
    on_insert = dict(on_insert or {})
    if duplicates == "error":
        assert_unique(source, keys)
    elif duplicates == "last":
        source = dedup_by_key(source, keys, order_by=dedup_order, keep="last")
    src = source.select(*[F.col(c) if c in source.columns else F.lit(None).alias(c)
                          for c in cols]).withColumn("_in_s", F.lit(True))
    tgt = target.select(*cols).withColumn("_in_t", F.lit(True))
    cond = condition if condition is not None else F.lit(True)
    j = tgt.alias("_t").join(src.alias("_s"), keys, "full_outer")
    in_t = F.coalesce(F.col("_t._in_t"), F.lit(False))
    in_s = F.coalesce(F.col("_s._in_s"), F.lit(False))
    action = (F.when(in_t & in_s & F.coalesce(cond, F.lit(False)), F.lit(UPDATE))
               .when(in_t & in_s, F.lit(KEEP))
               .when(in_t, F.lit(RETAIN))
               .otherwise(F.lit(INSERT)))
    j = j.withColumn(action_col, action)
    act = F.col(action_col)
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
            continue
        t, s = F.col(f"_t.{c}"), F.col(f"_s.{c}")
        if c in on_update or c in on_insert:
            upd = on_update.get(c, t)
            ins = on_insert.get(c, s)
            expr = F.when(act == UPDATE, upd).when(act == INSERT, ins).otherwise(t)
        elif c in update_cols:
            expr = F.when(act.isin(UPDATE, INSERT), s).otherwise(t)
        else:
            expr = F.when(act == INSERT, s).otherwise(t)
        out.append(expr.alias(c))
    return j.select(*out, act)


def merge_counts(merged: DataFrame, action_col: str = "_action") -> dict[str, int]:
    """Action counts of a merged frame (one small aggregate job)."""
    rows = merged.groupBy(action_col).count().collect()
    res = {UPDATE: 0, KEEP: 0, INSERT: 0, RETAIN: 0}
    res.update({r[0]: r[1] for r in rows})
    return res
