"""H8 edge table from parent-id columns, H1 hierarchy closure and descendant counts.

Scale notes
-----------
* Only nodes that are parents themselves can carry a path on.  The fixpoint therefore
  works on pairs (ancestor, inner node): each round joins the pairs of the round before to
  the edges between inner nodes and drops pairs already known.  Leaves, by far the
  most nodes of a tree, take part in one join at the end, which also brings the level
  of the last edge, so a missing level can't keep the loop alive.
* The loop ends on an empty round; the pairs are finite, so cycles end too (a node on
  a cycle is its own descendant).  Each round is written once to the shared
  checkpoint folder, so lineage stays one round deep.
* A parent that owns more than a hundredth of the edges is found by one partial
  aggregate; its edges are dealt into buckets and the few rows that reach them are
  repeated once a bucket (``skew``).
* Counting is a partial (map-side) aggregate per ancestor; entity attributes are
  joined after the aggregation, to ancestors only, never to the closure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.skew import hot_keys, salted_join
from strata.session import checkpoint, scratch_tables


def parent_columns(df: DataFrame, prefix: str, suffix: str = "") -> list[str]:
    """Columns of a flattened table that hold parent ids, by their name's two ends."""
    return [name for name in df.columns if name.startswith(prefix) and name.endswith(suffix)]


def _edges(rows: DataFrame) -> DataFrame:
    """One row a (child, parent) with the lowest level given for it: sums of fixed width, reduced before the
    shuffle."""
    known = rows.where("parent_id IS NOT NULL AND child_id IS NOT NULL")
    return known.groupBy("parent_id", "child_id").agg(F.min("child_level").alias("child_level"))


def edges_from_parent_columns(df: DataFrame, child: str | Column, parent_cols: Sequence[str],
                              level: str | Column | None = None, key_type: str = "bigint") -> DataFrame:
    """H8 from parent-id columns: they are unpivoted to rows; rows without a parent vanish."""
    ids = df.select((F.col(child) if isinstance(child, str) else child).cast(key_type).alias("child_id"),
                    (F.col(level) if isinstance(level, str) else F.lit(None) if level is None else level)
                    .cast("int").alias("child_level"),
                    *[F.col(c).try_cast(key_type).alias(f"parent_{i}") for i, c in enumerate(parent_cols)])
    if not parent_cols:
        return _edges(ids.withColumn("parent_id", F.lit(None).cast(key_type))).limit(0)
    wide = [f"parent_{i}" for i in range(len(parent_cols))]
    return _edges(ids.unpivot(["child_id", "child_level"], wide, "slot", "parent_id"))


def edges_from_parent_array(df: DataFrame, child: str, parents_array: str, field: str = "id",
                            level: str | None = None, key_type: str = "bigint") -> DataFrame:
    """H8 straight from the nested list, without a column a position."""
    rows = df.select(F.col(child).cast(key_type).alias("child_id"),
                     (F.col(level) if level else F.lit(None)).cast("int").alias("child_level"),
                     F.explode(F.col(parents_array)).alias("parent"))
    return _edges(rows.withColumn("parent_id", F.col("parent")[field].try_cast(key_type)))


def transitive_closure(edges: DataFrame, parent: str = "parent_id", child: str = "child_id",
                       level: str = "child_level", skew_share: float = 0.01) -> DataFrame:
    """H1: every (ancestor, descendant, descendant_level) reachable over ``edges``.

    The level travels with the descendant (it is the level on the descendant's own
    edge row, null too), as in the recursive CTE this replaces.  Triples are distinct.
    """
    e = checkpoint(edges.select(F.col(parent).alias("_p"), F.col(child).alias("_c"),
                                F.col(level).alias("_l"))
                   .filter(F.col("_p").isNotNull() & F.col("_c").isNotNull())
                   .distinct(), cache=False)
    hot = hot_keys(e, "_p", skew_share)
    parents = e.select(F.col("_p").alias("_q")).distinct()
    inner = checkpoint(e.join(parents, F.col("_c") == F.col("_q"), "left_semi")
                       .select("_p", "_c").distinct(), cache=False)
    reached = [inner.select(F.col("_p").alias("ancestor_id"), F.col("_c").alias("_via"))]
    while not reached[-1].isEmpty():
        known = reduce(DataFrame.union, reached)
        step = (salted_join(reached[-1], "_via", inner, "_p", hot, "_c")
                .select("ancestor_id", F.col("_c").alias("_via")).distinct()
                .join(known, ["ancestor_id", "_via"], "left_anti"))
        reached.append(checkpoint(step, cache=False))
    through = salted_join(reduce(DataFrame.union, reached), "_via", e, "_p", hot, "_c")
    direct = e.select(F.col("_p").alias("ancestor_id"), F.col("_c").alias("descendant_id"),
                      F.col("_l").alias("descendant_level"))
    return direct.union(through.select("ancestor_id", "_c", "_l")).distinct()


def descendant_counts(closure: DataFrame, levels: Mapping[int, str]) -> DataFrame:
    """Per ancestor, distinct descendants at each level.

    The closure triples are already distinct, so ``COUNT(DISTINCT CASE ...)`` is a
    plain conditional sum: no Expand, and the aggregate combines map-side.
    """
    aggs = [F.coalesce(F.sum(F.when(F.col("descendant_level") == lv, 1)), F.lit(0))
             .cast("bigint").alias(name) for lv, name in levels.items()]
    return closure.groupBy("ancestor_id").agg(*aggs)


def hierarchy_metrics(edges: DataFrame, levels: Mapping[int, str],
                      entities: DataFrame, entity_key: str,
                      details: DataFrame | None = None, details_key: str | None = None,
                      out_key: str = "ancestor_id") -> DataFrame:
    """H1 + D2: counts per ancestor, then entity and detail attributes (left joins).

    Ancestors with no entity row are kept with null attributes; the detail table is
    joined through the entity key, so an ancestor without an entity has no details.
    """
    with scratch_tables(edges.sparkSession) as keep:  # the closure's rounds go with the block
        counts = checkpoint(descendant_counts(transitive_closure(edges), levels), cache=False)
        keep.append(counts)
    ent = entities.withColumnRenamed(entity_key, "_ek")
    out = counts.join(ent, counts["ancestor_id"] == ent["_ek"], "left")
    if details is not None:
        det = details.withColumnRenamed(details_key or entity_key, "_dk")
        out = out.join(det, out["_ek"] == det["_dk"], "left").drop("_dk")
    out = out.drop("_ek")
    if out_key != "ancestor_id":
        out = out.withColumnRenamed("ancestor_id", out_key)
    return out
