"""The analytic question set (Q2-Q26 shapes) on the driver's tables.

orders = the emission series, customer = the entity master (segment = type,
nation/region = UF/region), supplier = installed supply.  Sums of money are
rounded to cents and ratios to 4 places in both the query and its oracle.

Where a question joins the order facts to the customer dimension, the facts are
first aggregated per customer (partial aggregation in every map task), so the
join and its shuffle see one row per customer instead of one per order, and a
customer owning a third of the orders is no hot join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import analytics as A
from strata.plans.registry import query
from strata.sources.tables import Tables

_MONTHLY_SQL = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       round(SUM(o_totalprice), 2) AS total, CAST(COUNT(*) AS BIGINT) AS n_orders
FROM orders GROUP BY 1, 2"""


def _monthly(t: Tables) -> DataFrame:
    return (t.orders.groupBy(F.year("o_orderdate").alias("year"),
                             A.month_of("o_orderdate").alias("month"))
                    .agg(F.round(F.sum("o_totalprice"), 2).alias("total"),
                         F.count(F.lit(1)).alias("n_orders")))


@query("monthly_sum", _MONTHLY_SQL)
def monthly_sum(t: Tables) -> DataFrame:
    """Order value and count per month, in month order."""
    return _monthly(t).orderBy("month")


@query("latest_month_total", """
SELECT round(SUM(o_totalprice), 2) AS total_latest_month FROM orders
WHERE date_trunc('month', o_orderdate) =
      (SELECT MAX(date_trunc('month', o_orderdate)) FROM orders)""")
def latest_month_total(t: Tables) -> DataFrame:
    """Total of the latest month (scalar-subquery filter)."""
    # monthly totals first: the max-month lookup then runs over one row per month
    m = t.orders.groupBy(A.month_of("o_orderdate").alias("month")).agg(
        F.sum("o_totalprice").alias("_v"))
    return A.latest_period_rows(m, "month").agg(
        F.round(F.sum("_v"), 2).alias("total_latest_month"))


@query("trailing12", """
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_totalprice FROM orders)
SELECT round(SUM(o_totalprice), 2) AS total_12m, CAST(COUNT(DISTINCT month) AS BIGINT) AS n_months
FROM m WHERE month > (SELECT MAX(month) FROM m) - INTERVAL 12 MONTH""")
def trailing12(t: Tables) -> DataFrame:
    """Total of the 12 months up to the latest month."""
    m = t.orders.groupBy(A.month_of("o_orderdate").alias("month")).agg(
        F.sum("o_totalprice").alias("_v"))
    return A.trailing_period_rows(m, "month", 12).agg(F.round(F.sum("_v"), 2).alias("total_12m"),
                                          F.count(F.lit(1)).alias("n_months"))


@query("yoy", """
WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(SUM(o_totalprice), 2) AS total
           FROM orders GROUP BY 1)
SELECT y.year, y.total, p.total AS prev_total,
       round((y.total - p.total) / NULLIF(p.total, 0) * 100, 2) AS variation_pct
FROM y LEFT JOIN y p ON p.year + 1 = y.year""")
def yoy(t: Tables) -> DataFrame:
    """Yearly total beside the previous year's, with % variation."""
    y = (t.orders.groupBy(F.year("o_orderdate").alias("year"))
                 .agg(F.round(F.sum("o_totalprice"), 2).alias("total")))
    return A.year_over_year(y, "year", "total", prev_col="prev_total")


_CUST_GEO = ("customer JOIN nation ON c_nationkey = n_nationkey "
             "JOIN region ON n_regionkey = r_regionkey")


def _cust_geo(t: Tables) -> DataFrame:
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                      .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))


@query("distinct_by_region", f"""
SELECT n_name, r_name, CAST(COUNT(DISTINCT c_custkey) AS BIGINT) AS n_entities
FROM {_CUST_GEO} WHERE c_mktsegment = 'BUILDING' GROUP BY n_name, r_name""")
def distinct_by_region(t: Tables) -> DataFrame:
    """Distinct entities of one type per UF (nation) and region."""
    return (_cust_geo(t).filter(F.col("c_mktsegment") == "BUILDING")
            .groupBy("n_name", "r_name")
            .agg(F.countDistinct("c_custkey").alias("n_entities"))
            .orderBy(F.col("n_entities").desc(), "n_name"))


@query("count_in_state", f"""
SELECT CAST(COUNT(DISTINCT c_custkey) AS BIGINT) AS n_entities
FROM {_CUST_GEO} WHERE c_mktsegment = 'BUILDING' AND n_name = 'NATION_7'""")
def count_in_state(t: Tables) -> DataFrame:
    """Global distinct count under filters."""
    return (_cust_geo(t).filter((F.col("c_mktsegment") == "BUILDING") &
                                (F.col("n_name") == "NATION_7"))
            .agg(F.countDistinct("c_custkey").alias("n_entities")))


@query("top10", f"""
SELECT n_name, CAST(COUNT(DISTINCT c_custkey) AS BIGINT) AS n_entities
FROM {_CUST_GEO} GROUP BY n_name ORDER BY n_entities DESC, n_name LIMIT 10""")
def top10(t: Tables) -> DataFrame:
    """Q13/F2: the ten UFs (nations) with most entities; ties broken by name."""
    return (_cust_geo(t).groupBy("n_name").agg(F.countDistinct("c_custkey").alias("n_entities"))
            .orderBy(F.col("n_entities").desc(), F.col("n_name")).limit(10))


@query("share", """
WITH s AS (SELECT c_mktsegment, round(SUM(o_totalprice), 2) AS total
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)
SELECT c_mktsegment, total, round(total / (SELECT SUM(total) FROM s), 4) AS share FROM s""")
def share(t: Tables) -> DataFrame:
    """Each segment's share of the total order value."""
    per_cust = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("_v"))
    s = (per_cust.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
                 .groupBy("c_mktsegment").agg(F.round(F.sum("_v"), 2).alias("total")))
    return A.share_of_total(s, "total", "share", 4)


@query("ratio", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_active,
       CAST(COUNT(*) AS BIGINT) AS n_issued,
       round(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0), 4) AS ratio
FROM orders GROUP BY 1""")
def ratio(t: Tables) -> DataFrame:
    """Active / issued per year (guarded division)."""
    y = (t.orders.groupBy(F.year("o_orderdate").alias("year"))
                 .agg(F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
                       .cast("bigint").alias("n_active"),
                      F.count(F.lit(1)).alias("n_issued")))
    return y.withColumn("ratio", A.safe_ratio("n_active", "n_issued", 4))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PRIORITY_COLS = ["p1_urgent", "p2_high", "p3_medium", "p4_not_specified", "p5_low"]


@query("crosstab", "SELECT r_name, " + ", ".join(
    f"CAST(COUNT(CASE WHEN o_orderpriority = '{v}' THEN 1 END) AS BIGINT) AS {n}"
    for v, n in zip(PRIORITIES, PRIORITY_COLS)) + f"""
FROM orders JOIN {_CUST_GEO} ON o_custkey = c_custkey GROUP BY r_name""")
def crosstab(t: Tables) -> DataFrame:
    """Region x priority cross-tab (pivot over a known value list)."""
    # counts per (customer, priority) first: the fact table is combined map-side and
    # only one row per customer and priority is shuffled into the join
    per_cust = (t.orders.groupBy("o_custkey")
                .agg(*[F.count(F.when(F.col("o_orderpriority") == v, 1)).alias(n)
                       for v, n in zip(PRIORITIES, PRIORITY_COLS)]))
    j = per_cust.join(_cust_geo(t), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("r_name").agg(*[F.sum(n).cast("bigint").alias(n) for n in PRIORITY_COLS])


@query("by_year_type", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus,
       CAST(COUNT(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2""")
def by_year_type(t: Tables) -> DataFrame:
    """Count per year of the date and type."""
    return (t.orders.groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n")))


@query("per_entity", """
SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS n_orders, round(SUM(o_totalprice), 2) AS total,
       round(MAX(o_totalprice), 2) AS max_order
FROM orders GROUP BY o_custkey""")
def per_entity(t: Tables) -> DataFrame:
    """Sums of metrics per authority (customer)."""
    return (t.orders.groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.round(F.sum("o_totalprice"), 2).alias("total"),
                 F.round(F.max("o_totalprice"), 2).alias("max_order")))


@query("metric_view", f"""
SELECT n_name, c_mktsegment, CAST(COUNT(*) AS BIGINT) AS n_orders,
       CAST(COUNT(DISTINCT c_custkey) AS BIGINT) AS n_entities,
       round(SUM(o_totalprice), 2) AS total
FROM orders JOIN {_CUST_GEO} ON o_custkey = c_custkey
WHERE r_name = 'EUROPE' AND o_orderstatus IN ('F', 'O')
GROUP BY n_name, c_mktsegment""")
def metric_view(t: Tables) -> DataFrame:
    """Dimensional aggregates under global filters (region, status)."""
    per_cust = (t.orders.filter(F.col("o_orderstatus").isin("F", "O"))
                .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n"),
                                          F.sum("o_totalprice").alias("_v")))
    j = per_cust.join(_cust_geo(t), F.col("o_custkey") == F.col("c_custkey"))
    return A.metric_view(j, ["n_name", "c_mktsegment"],
                         [F.sum("_n").cast("bigint").alias("n_orders"),
                          F.countDistinct("c_custkey").alias("n_entities"),
                          F.round(F.sum("_v"), 2).alias("total")],
                         filters={"r_name": "EUROPE", "c_mktsegment": None})


@query("supply_demand", """
WITH s AS (SELECT n_name, CAST(COUNT(DISTINCT s_suppkey) AS BIGINT) AS supply
           FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name),
d AS (SELECT n_name, round(SUM(o_totalprice), 2) AS demand
      FROM orders JOIN customer ON o_custkey = c_custkey
                  JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)
SELECT COALESCE(s.n_name, d.n_name) AS n_name, supply, demand,
       round(demand / NULLIF(CAST(supply AS DOUBLE), 0), 4) AS demand_per_supply
FROM s FULL OUTER JOIN d ON s.n_name = d.n_name""")
def supply_demand(t: Tables) -> DataFrame:
    """Supply and demand per UF, full outer join, guarded ratio."""
    s = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
                   .groupBy("n_name").agg(F.countDistinct("s_suppkey").alias("supply")))
    per_cust = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("_v"))
    d = (per_cust.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
                 .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                 .groupBy("n_name").agg(F.round(F.sum("_v"), 2).alias("demand")))
    return A.compare_sides(s, d, ["n_name"], "demand", "supply", "demand_per_supply", 4)


@query("series_context", """
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  round(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1),
c AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
             CAST(COUNT(*) AS BIGINT) AS n_returned
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT m.month, m.total, c.n_returned FROM m LEFT JOIN c ON m.month = c.month""")
def series_context(t: Tables) -> DataFrame:
    """The monthly series beside the month's context events (left join)."""
    m = (t.orders.groupBy(A.month_of("o_orderdate").alias("month"))
                 .agg(F.round(F.sum("o_totalprice"), 2).alias("total")))
    c = (t.lineitem.filter(F.col("l_returnflag") == "R")
                   .groupBy(A.month_of("l_shipdate").alias("month"))
                   .agg(F.count(F.lit(1)).alias("n_returned")))
    return m.join(c, "month", "left")


@query("series_pick", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, round(SUM(o_totalprice), 2) AS total
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' GROUP BY 1, 2""")
def series_pick(t: Tables) -> DataFrame:
    """One series picked by equality, another value excluded by inequality."""
    return (t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW"))
            .groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority")
            .agg(F.round(F.sum("o_totalprice"), 2).alias("total")))


@query("dim_denorm", """
SELECT c_custkey, c_name, c_mktsegment, n_name, r_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
              LEFT JOIN region ON n_regionkey = r_regionkey""")
def dim_denorm(t: Tables) -> DataFrame:
    """Denormalised entity dimension (master left-joined to its details)."""
    return (t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
            .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                  F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name"))
