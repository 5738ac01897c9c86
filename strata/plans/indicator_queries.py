"""Indicator unification (H4, F5, C10, G16), classified marts (H10) and typed
staging (H5, G18-G20) on the driver's tables.

Four tables play the four indicator branches: orders (series), customer
(geography), part (segmentation) and lineitem (infrastructure + KPIs).  Branch
projections and mart rules are data - SQL expressions in dictionaries and rule
lists - shared with the domain plan's operators (``align``/``union_all``/
``classify``/``mart``) and readable by DuckDB, so the oracle states the same rules.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.functions.keys import surrogate_key
from strata.operators.rules import align, classify, classify_sql, mart, q, union_all
from strata.plans.registry import query
from strata.sources.tables import Tables

AS_OF = dt.date(2025, 12, 31)  # fixed run date of the test mapping (never "today")

UNIFIED = [("origin", "string"), ("sub_origin", "string"), ("indicator", "string"),
           ("label", "string"), ("flag", "string"), ("cert_type", "string"),
           ("user_type", "string"), ("usage", "string"), ("period", "date"),
           ("year", "int"), ("state", "string"), ("region", "string"), ("value", "double")]
KEY_PARTS = ["origin", "flag", "period", "state", "region", "cert_type", "user_type", "usage"]

BRANCHES = {
    "orders": {
        "origin": "'tpch'", "sub_origin": "'ORD'", "indicator": "'o_totalprice'",
        "label": "o_orderpriority", "flag": "concat('ordTOTAL_', o_orderstatus)",
        "usage": "o_orderpriority", "period": "CAST(o_orderdate AS DATE)",
        "year": "year(o_orderdate)", "value": "o_totalprice"},
    "customer": {
        "origin": "'tpch'", "sub_origin": "'CUS'", "indicator": "'c_acctbal'",
        "label": "c_mktsegment", "flag": "'cusBALANCE'", "user_type": "c_mktsegment",
        "state": "CAST(c_nationkey AS STRING)",
        "region": ("CASE WHEN c_nationkey BETWEEN 0 AND 4 THEN 'NORTH' "
                   "WHEN c_nationkey BETWEEN 5 AND 14 THEN 'CENTER' ELSE 'SOUTH' END"),
        "value": "c_acctbal"},
    "part": {
        "origin": "'tpch'", "sub_origin": "'PAR'", "indicator": "'p_retailprice'",
        "label": "p_name", "flag": "concat('parTYPE_', p_type)", "cert_type": "p_brand",
        "user_type": "p_type", "usage": "p_name",
        "period": "CAST(concat(CAST(1990 + p_size AS STRING), '-01-01') AS DATE)",
        "year": "1990 + p_size", "value": "p_retailprice"},
    "lineitem": {
        "origin": "'tpch'", "sub_origin": "'LIN'", "indicator": "'l_extendedprice'",
        "label": "concat(l_returnflag, l_linestatus)", "flag": "concat('linSHIP_', l_returnflag)",
        "cert_type": "l_linestatus", "period": "CAST(l_shipdate AS DATE)",
        "year": "year(l_shipdate)", "value": "l_extendedprice"},
}


def unified(t: Tables) -> DataFrame:
    frames = [align(getattr(t, table), UNIFIED, exprs) for table, exprs in BRANCHES.items()]
    u = union_all(frames)
    return u.select(surrogate_key(*KEY_PARTS).alias("key"), *[c for c, _ in UNIFIED])


def _unified_sql() -> str:
    branches = []
    for table, exprs in BRANCHES.items():
        cols = ", ".join(f"CAST({exprs.get(c, 'NULL')} AS {'VARCHAR' if ty == 'string' else ty.upper()}) AS {c}"
                         for c, ty in UNIFIED)
        branches.append(f"SELECT {cols} FROM {table}")
    parts = ", ".join(f"COALESCE(CAST({p} AS VARCHAR), '')" for p in KEY_PARTS)
    body = " UNION ALL ".join(branches)
    return (f"WITH u AS ({body}) SELECT sha256(concat_ws('||', {parts})) AS key, "
            + ", ".join(c for c, _ in UNIFIED) + " FROM u")


@query("indicator_unify", _unified_sql())
def indicator_unify(t: Tables) -> DataFrame:
    """Four branch projections, typed-null aligned, UNION ALL, SHA-256 key."""
    return unified(t)


# Mart rule lists (test mapping).  First match wins.
SERIES_GRAIN = [("flag LIKE '%_F'", q("CLOSED"))]
SERIES_KIND = [("flag = 'ordTOTAL_F'", q("FINISHED")), ("flag = 'ordTOTAL_O'", q("OPEN ORDERS")),
               ("flag = 'ordTOTAL_P'", q("PENDING"))]
GEO_METRIC = [("user_type IN ('AUTOMOBILE', 'MACHINERY')", q("INDUSTRIAL")),
              ("user_type = 'BUILDING'", q("CONSTRUCTION")),
              ("user_type = 'HOUSEHOLD'", q("RESIDENTIAL"))]
GEO_OBJECT = [("user_type = 'FURNITURE'", q("GOODS"))]
SEG_CUT = [("flag IN ('parTYPE_ECONOMY', 'parTYPE_STANDARD')", q("BASIC")),
           ("flag = 'parTYPE_PROMO'", q("PROMOTION")),
           ("flag = 'parTYPE_LARGE'", q("BULK"))]
SEG_BRAND = [("flag IN ('parTYPE_ECONOMY', 'parTYPE_STANDARD')",
              "CASE WHEN cert_type IN ('Brand#1', 'Brand#2') THEN cert_type ELSE 'OTHER' END")]
SEG_USER = [("flag IN ('parTYPE_PROMO', 'parTYPE_LARGE')",
             "CASE WHEN usage LIKE '%red%' OR user_type LIKE '%LARG%' THEN 'RED OR LARGE' "
             "WHEN usage LIKE '%blue%' OR user_type LIKE '%PROM_%' THEN 'BLUE OR PROMO' "
             "ELSE COALESCE(upper(COALESCE(usage, user_type)), 'APPLICATION') END")]
KPI_NAME = [("label LIKE '%AF%'", q("ACCEPTED FINAL")), ("label LIKE '%NO%'", q("NEW OPEN")),
            ("label LIKE '%N%' OR label LIKE '%F%'", q("NEW OR FINAL")),
            ("label LIKE 'A_'", q("ACCEPTED OTHER"))]
KPI_KIND = [("flag LIKE '%_A'", q("ACCEPTED")), ("flag LIKE '%N'", q("NEW"))]
KPI_VALUE = [("label IN ('AF', 'NO')", q("PERCENT"))]


def _marts():
    return {
        "fact_series": ("sub_origin = 'ORD'", [
            ("key", "key"), ("year", "year"), ("period", "period"),
            ("granularity", (SERIES_GRAIN, q("OPEN"))), ("series", (SERIES_KIND, q("OTHER"))),
            ("value", "value")]),
        "fact_geo": ("sub_origin = 'CUS'", [
            ("key", "key"), ("state", "state"), ("region", "region"),
            ("metric", (GEO_METRIC, q("OTHER"))), ("object_type", (GEO_OBJECT, q("ACCOUNTS"))),
            ("value", "value")]),
        "fact_segment": ("sub_origin = 'PAR'", [
            ("key", "key"), ("year", "year"), ("period", "period"),
            ("category_cut", (SEG_CUT, q("OTHER"))), ("brand", (SEG_BRAND, "NULL")),
            ("user_class", (SEG_USER, "NULL")), ("value", "value")]),
        # the branch predicate lets Catalyst drop the other three branches' scans
        "fact_infra": ("sub_origin = 'LIN' AND flag = 'linSHIP_R'", [
            ("key", "key"), ("year", "year"), ("period", "period"),
            ("entity_type", q("RETURNED LINES")), ("metric", q("EXTENDED PRICE")),
            ("value", "value")]),
        "fact_kpi": ("sub_origin = 'LIN' AND flag <> 'linSHIP_R'", [
            ("key", "key"), ("year", "year"), ("period", "period"),
            ("kpi", (KPI_NAME, q("OTHER"))), ("kpi_kind", (KPI_KIND, q("CURRENT"))),
            ("value_kind", (KPI_VALUE, q("INTEGER"))), ("value", "value")]),
    }


def _mart_df(t: Tables, name: str) -> DataFrame:
    where, cols = _marts()[name]
    spec = [(n, classify(*e) if isinstance(e, tuple) else e) for n, e in cols]
    return mart(unified(t), where, spec)


def _mart_sql(name: str) -> str:
    where, cols = _marts()[name]
    sel = ", ".join(f"{classify_sql(*e) if isinstance(e, tuple) else e} AS {n}"
                    for n, e in cols)
    return f"WITH unified AS ({_unified_sql()}) SELECT {sel} FROM unified WHERE {where}"


def _register_marts():
    for name in _marts():
        def fn(t: Tables, _n=name) -> DataFrame:
            return _mart_df(t, _n)
        fn.__doc__ = f"H10 mart {name}: one branch filtered, flags recoded by rule list."
        query(name, _mart_sql(name))(fn)


_register_marts()


# H5 staging on events: fixed code tables of the test mapping.
EVENT_LABEL = {"click": "ui click", "view": "page view", "purchase": "order placed"}
EVENT_FLAG = {"click": "engMONTHLY", "view": "engMONTHLY", "purchase": "salMONTHLY",
              "signup": "accYEARLY"}
LABEL_YEARS_BACK = {"ui click": 0, "page view": 1, "order placed": 2}
MONTHLY_FLAGS = ["engMONTHLY", "salMONTHLY"]


def _case_map(col: str, mapping: dict, default: str) -> str:
    body = " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}"
                    for k, v in mapping.items())
    return f"CASE {col} {body} ELSE {default} END"


@query("code_staging", f"""
WITH s AS (
  SELECT event_id, event_type,
         {_case_map('event_type', EVENT_LABEL, 'event_type')} AS label,
         {_case_map('event_type', EVENT_FLAG, q('OTHER'))} AS flag,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS kd
  FROM events
), t AS (
  SELECT *, CASE WHEN kd IS NOT NULL AND kd = floor(kd) THEN CAST(kd AS BIGINT) END AS k FROM s
), u AS (
  SELECT *, {AS_OF.year} - {_case_map('label', LABEL_YEARS_BACK, 'NULL')} AS year,
         k % 13 AS month_index FROM t
)
SELECT event_id, event_type, label, flag, k, CAST(year AS INTEGER) AS year, month_index,
       CASE WHEN flag IN ({", ".join(q(f) for f in MONTHLY_FLAGS)}) AND month_index BETWEEN 0 AND 11
            THEN TRY_CAST(printf('%d-%02d-01', year, month_index + 1) AS DATE) END AS month
FROM u""")
def code_staging(t: Tables) -> DataFrame:
    """Typed staging with code tables, whole-number coercion and
    month dates for the monthly flags only (month index 12 -> null)."""
    e = t.events.select("event_id", "event_type", "props")
    label = C.lookup("event_type", EVENT_LABEL, F.col("event_type"))
    flag = C.lookup("event_type", EVENT_FLAG, "OTHER")
    k = C.whole_number(F.get_json_object("props", "$.k"))
    s = e.select("event_id", "event_type", label.alias("label"), flag.alias("flag"),
                 k.alias("k"))
    back = C.lookup("label", LABEL_YEARS_BACK)
    s = s.select("*", (F.lit(AS_OF.year) - back).cast("int").alias("year"),
                 (F.col("k") % 13).alias("month_index"))
    month = C.month_date("year", "month_index", when=F.col("flag").isin(*MONTHLY_FLAGS))
    return s.select("event_id", "event_type", "label", "flag", "k", "year", "month_index",
                    month.alias("month"))
