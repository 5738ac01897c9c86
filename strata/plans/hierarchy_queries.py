"""Hierarchy questions (H1, H8, E1, D2, D6, Q1, Q17) on the driver's tables.

The order tree region -> nation -> customer -> order stands in for the
certification tree.  Entity ids are the natural keys tagged by kind,
``key * 4 + tag`` (region 0, nation 1, customer 2, order 3), so they stay
``bigint`` (cheap to shuffle) and never collide across kinds.  The wide
``entities`` frame has a ``parent_0_id`` column, like the flattened bronze
table whose ``ids_pai_{i}_id`` columns H8 discovers by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.hierarchy import (descendant_counts, edges_from_parent_columns,
                                        hierarchy_metrics, parent_columns,
                                        transitive_closure)
from strata.plans.registry import query
from strata.sources.tables import Tables

LEVELS = {1: "n_level_1", 2: "n_level_2", 3: "n_level_3"}


def _tag(col: str, tag: int):
    return F.col(col).cast("bigint") * 4 + tag


def entities(t: Tables) -> DataFrame:
    """Wide entity frame: id, name, type, level and the parent-id column."""
    r = t.region.select(_tag("r_regionkey", 0).alias("entity_id"),
                        F.col("r_name").alias("entity_name"),
                        F.lit("REGION").alias("entity_type"), F.lit(0).alias("entity_level"),
                        F.lit(None).cast("bigint").alias("parent_0_id"))
    n = t.nation.select(_tag("n_nationkey", 1), F.col("n_name"), F.lit("NATION"), F.lit(1),
                        _tag("n_regionkey", 0))
    c = t.customer.select(_tag("c_custkey", 2), F.col("c_name"), F.lit("CUSTOMER"), F.lit(2),
                          _tag("c_nationkey", 1))
    o = t.orders.select(_tag("o_orderkey", 3),
                        F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")),
                        F.lit("ORDER"), F.lit(3), _tag("o_custkey", 2))
    return r.union(n).union(c).union(o)


def geo_details(t: Tables) -> DataFrame:
    """Second dimension keyed by entity id (the address table's role)."""
    nat = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
                   .select(_tag("n_nationkey", 1).alias("entity_id"),
                           F.col("r_name").alias("geo_name")))
    cus = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                     .select(_tag("c_custkey", 2).alias("entity_id"),
                             F.col("n_name").alias("geo_name")))
    return nat.union(cus)


def tree_edges(t: Tables) -> DataFrame:
    ent = entities(t)
    return edges_from_parent_columns(ent, "entity_id", parent_columns(ent, "parent_", "_id"),
                                     level="entity_level")


def _counts(t: Tables) -> DataFrame:
    ent = entities(t).select("entity_id", "entity_name", "entity_type")
    return hierarchy_metrics(tree_edges(t), LEVELS, ent, "entity_id",
                             geo_details(t), "entity_id", out_key="entity_id")


_ORACLE_CTES = """
WITH RECURSIVE ent AS (
    SELECT CAST(r_regionkey AS BIGINT) * 4 AS entity_id, r_name AS entity_name,
           'REGION' AS entity_type, 0 AS entity_level, CAST(NULL AS BIGINT) AS parent_id FROM region
    UNION ALL SELECT CAST(n_nationkey AS BIGINT) * 4 + 1, n_name, 'NATION', 1,
           CAST(n_regionkey AS BIGINT) * 4 FROM nation
    UNION ALL SELECT CAST(c_custkey AS BIGINT) * 4 + 2, c_name, 'CUSTOMER', 2,
           CAST(c_nationkey AS BIGINT) * 4 + 1 FROM customer
    UNION ALL SELECT CAST(o_orderkey AS BIGINT) * 4 + 3, 'Order#' || CAST(o_orderkey AS VARCHAR),
           'ORDER', 3, CAST(o_custkey AS BIGINT) * 4 + 2 FROM orders
),
edges AS (
    SELECT DISTINCT parent_id, entity_id AS child_id, entity_level AS child_level
    FROM ent WHERE parent_id IS NOT NULL
),
clo(anc, des, lvl) AS (
    SELECT parent_id, child_id, child_level FROM edges
    UNION
    SELECT c.anc, e.child_id, e.child_level FROM clo c JOIN edges e ON c.des = e.parent_id
),
geo AS (
    SELECT CAST(n_nationkey AS BIGINT) * 4 + 1 AS gid, r_name AS geo_name
    FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT CAST(c_custkey AS BIGINT) * 4 + 2, n_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
),
cnt AS (
    SELECT anc,
           CAST(COUNT(DISTINCT CASE WHEN lvl = 1 THEN des END) AS BIGINT) AS n_level_1,
           CAST(COUNT(DISTINCT CASE WHEN lvl = 2 THEN des END) AS BIGINT) AS n_level_2,
           CAST(COUNT(DISTINCT CASE WHEN lvl = 3 THEN des END) AS BIGINT) AS n_level_3
    FROM clo GROUP BY anc
),
metrics AS (
    SELECT cnt.anc AS entity_id, ent.entity_name, ent.entity_type, geo.geo_name,
           n_level_1, n_level_2, n_level_3
    FROM cnt LEFT JOIN ent ON cnt.anc = ent.entity_id
             LEFT JOIN geo ON ent.entity_id = geo.gid
)
"""


@query("hierarchy_counts", _ORACLE_CTES + "SELECT * FROM metrics")
def hierarchy_counts(t: Tables) -> DataFrame:
    """Distinct descendants per ancestor and level, with attributes."""
    return _counts(t).select("entity_id", "entity_name", "entity_type", "geo_name",
                             *LEVELS.values())


@query("hierarchy_top5", _ORACLE_CTES + """
SELECT entity_id, entity_name, entity_type, geo_name, n_level_3 FROM metrics
WHERE entity_type IN ('NATION', 'CUSTOMER')
ORDER BY n_level_3 DESC, entity_id LIMIT 5""")
def hierarchy_top5(t: Tables) -> DataFrame:
    """The five nations/customers with most orders below them."""
    return (_counts(t).filter(F.col("entity_type").isin("NATION", "CUSTOMER"))
                      .orderBy(F.col("n_level_3").desc(), F.col("entity_id"))
                      .limit(5)
                      .select("entity_id", "entity_name", "entity_type", "geo_name", "n_level_3"))


@query("hierarchy_direct", _ORACLE_CTES.split("clo(anc")[0].rstrip().rstrip(",") + """
SELECT e.parent_id, p.entity_name AS parent_name, e.child_id, c.entity_name AS child_name,
       e.child_level
FROM edges e LEFT JOIN ent p ON e.parent_id = p.entity_id
             LEFT JOIN ent c ON e.child_id = c.entity_id""")
def hierarchy_direct(t: Tables) -> DataFrame:
    """Every parent/child edge with both names (dimension joined twice)."""
    ent = entities(t).select("entity_id", "entity_name")
    p = ent.toDF("parent_id", "parent_name")
    c = ent.toDF("child_id", "child_name")
    return (tree_edges(t).join(p, "parent_id", "left").join(c, "child_id", "left")
                         .select("parent_id", "parent_name", "child_id", "child_name",
                                 "child_level"))


@query("hierarchy_closure_size", _ORACLE_CTES + """
SELECT lvl AS descendant_level, CAST(COUNT(*) AS BIGINT) AS n_pairs
FROM clo GROUP BY lvl""")
def hierarchy_closure_size(t: Tables) -> DataFrame:
    """Size of the closure per descendant level (recursive union check)."""
    return (transitive_closure(tree_edges(t)).groupBy("descendant_level")
            .agg(F.count(F.lit(1)).alias("n_pairs")))


def graph_edges(t: Tables) -> DataFrame:
    """Edges with several parents a child, missing levels and a cycle: region -> nation -> supplier ->
    order, part -> order, and the nation with key 0 back to its region."""
    def edge(parent, child, level):
        return [parent.alias("parent_id"), child.alias("child_id"), level.cast("int").alias("child_level")]

    def node(col, tag):
        return F.col(col).cast("bigint") * 8 + tag
    nation = t.nation.select(*edge(node("n_regionkey", 0), node("n_nationkey", 1), F.lit(1)))
    back = t.nation.where("n_nationkey = 0").select(*edge(node("n_nationkey", 1), node("n_regionkey", 0), F.lit(None)))
    supplier = t.supplier.select(*edge(node("s_nationkey", 1), node("s_suppkey", 2),
                                       F.when(F.col("s_suppkey") % 3 > 0, 2)))
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_partkey")
    level = F.when(F.col("l_orderkey") % 5 > 0, 3)
    return (nation.union(back).union(supplier)
            .union(lines.select(*edge(node("l_suppkey", 2), node("l_orderkey", 4), level)))
            .union(lines.select(*edge(node("l_partkey", 3), node("l_orderkey", 4), level))))


@query("hierarchy_graph_counts", """
WITH RECURSIVE edges(p, c, l) AS (
    SELECT CAST(n_regionkey AS BIGINT) * 8, CAST(n_nationkey AS BIGINT) * 8 + 1, 1 FROM nation
    UNION SELECT CAST(n_nationkey AS BIGINT) * 8 + 1, CAST(n_regionkey AS BIGINT) * 8, NULL FROM nation WHERE n_nationkey = 0
    UNION SELECT CAST(s_nationkey AS BIGINT) * 8 + 1, CAST(s_suppkey AS BIGINT) * 8 + 2,
                 CASE WHEN s_suppkey % 3 > 0 THEN 2 END FROM supplier
    UNION SELECT CAST(l_suppkey AS BIGINT) * 8 + 2, CAST(l_orderkey AS BIGINT) * 8 + 4,
                 CASE WHEN l_orderkey % 5 > 0 THEN 3 END FROM lineitem
    UNION SELECT CAST(l_partkey AS BIGINT) * 8 + 3, CAST(l_orderkey AS BIGINT) * 8 + 4,
                 CASE WHEN l_orderkey % 5 > 0 THEN 3 END FROM lineitem),
clo(a, d, l) AS (
    SELECT p, c, l FROM edges
    UNION SELECT clo.a, e.c, e.l FROM clo JOIN edges e ON clo.d = e.p)
SELECT a AS ancestor_id, CAST(COUNT(*) AS BIGINT) AS n_pairs,
       CAST(COUNT(CASE WHEN l IS NULL THEN 1 END) AS BIGINT) AS n_no_level,
       CAST(COUNT(CASE WHEN l = 2 THEN 1 END) AS BIGINT) AS n_level_2,
       CAST(COUNT(CASE WHEN l = 3 THEN 1 END) AS BIGINT) AS n_level_3
FROM clo GROUP BY a""")
def hierarchy_graph_counts(t: Tables) -> DataFrame:
    """The closure of a graph with several parents, null levels and a cycle."""
    def count(test):
        return F.coalesce(F.sum(F.when(test, 1)), F.lit(0)).cast("bigint")
    level = F.col("descendant_level")
    return transitive_closure(graph_edges(t)).groupBy("ancestor_id").agg(
        F.count(F.lit(1)).alias("n_pairs"), count(level.isNull()).alias("n_no_level"),
        count(level == 2).alias("n_level_2"), count(level == 3).alias("n_level_3"))


__all__ = ["entities", "tree_edges", "geo_details", "descendant_counts"]
