"""Cleansing, enrichment, dedup and lookup questions on the driver's tables.

H6 (cleansed master), H7 (address line), G13/D5 (lookups with fallback),
F4 (deterministic dedup), Q12 (lookup by punctuated id), H13 (domain checks).
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.functions.keys import dedup_by_key
from strata.operators.quality import DomainRule, domain_report
from strata.operators.enrich import lookup_join
from strata.operators.layout import along_curve, share_read
from strata.plans.registry import query
from strata.session import ensure_checkpoint_dir
from strata.sources.tables import Tables

# DuckDB has no initcap; Spark's capitalises the first letter after each space.
def _duck_initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


@query("clean_master", """
SELECT c_custkey AS entity_id,
       trim(regexp_replace(c_name, '\\s+', ' ', 'g')) AS entity_name,
       lpad(regexp_replace(c_name, '[^0-9]', '', 'g'), 14, '0') AS tax_id,
       upper(c_mktsegment) AS entity_type,
       CAST(c_nationkey AS INTEGER) AS entity_level,
       CASE WHEN c_nationkey = 7 THEN 'ACCREDITED' ELSE 'PENDING' END AS status,
       TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) AS process_number,
       TRY_CAST(printf('%04d-%02d-%02d', 2000 + c_nationkey, 1 + c_nationkey % 12, 30) AS DATE)
           AS accredited_on
FROM customer""")
def clean_master(t: Tables) -> DataFrame:
    """One cleansed row per entity id.

    ``accredited_on`` parses ``yyyy-MM-30`` text leniently, so February (and any
    bad text) becomes null instead of failing the job (T15).
    """
    c = t.customer
    date_text = F.format_string("%04d-%02d-%02d", F.col("c_nationkey") + 2000,
                                F.col("c_nationkey") % 12 + 1, F.lit(30))
    out = c.filter(F.col("c_custkey").isNotNull()).select(
        C.strict_cast("c_custkey", "bigint").alias("entity_id"),
        C.collapse_spaces("c_name").alias("entity_name"),
        C.tax_id("c_name").alias("tax_id"),
        F.upper("c_mktsegment").alias("entity_type"),
        C.strict_cast("c_nationkey", "int").alias("entity_level"),
        C.code_label("c_nationkey", 7, "ACCREDITED", "PENDING").alias("status"),
        C.digits_as_long("c_name").alias("process_number"),
        C.parse_date(date_text, "yyyy-MM-dd", lenient=True).alias("accredited_on"),
    )
    return dedup_by_key(out, ["entity_id"])


_ADDR_PARTS = """
    'Nº ' || split_part(c_name, '#', 2) AS number_raw,
    lower(c_mktsegment) AS complement,
    'rua ' || lower(c_mktsegment) AS street,
    lower(n_name) AS district,
    lower(r_name) AS city,
    lower(substr(n_name, 1, 2)) AS uf,
    lpad(CAST(c_custkey AS VARCHAR), CAST(7 + c_custkey % 3 AS INTEGER), '0') AS cep_raw
"""


@query("address_line", f"""
WITH a AS (
  SELECT c_custkey, {_ADDR_PARTS}
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
), b AS (
  SELECT *, nullif(trim(regexp_replace(number_raw, '(?i)N[º°\\.]\\s*|^\\s*$', '', 'g')), '')
              AS number_clean,
         CASE WHEN regexp_full_match(cep_raw, '\\d{{8}}')
              THEN regexp_replace(cep_raw, '(\\d{{5}})(\\d{{3}})', '\\1-\\2') ELSE cep_raw END
              AS cep_fmt
  FROM a
)
SELECT c_custkey AS entity_id,
       concat_ws(', ', {_duck_initcap("concat_ws(' ', coalesce(number_clean, complement), street)")},
                 {_duck_initcap("district")}, {_duck_initcap("city")}, upper(uf), cep_fmt)
           AS full_address,
       upper(street) AS street,
       TRY_CAST(NULLIF(regexp_extract(number_raw, '(\\d+)', 1), '') AS BIGINT) AS number,
       upper(uf) AS uf,
       regexp_replace(cep_raw, '[^0-9]', '', 'g') AS cep
FROM b""")
def address_line(t: Tables) -> DataFrame:
    """Normalised address line per customer.

    The raw parts are derived from customer, nation and region text; postal codes
    come in 7, 8 and 9 digits so only the 8-digit ones get the ``ddddd-ddd`` form.
    """
    a = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                   .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
                   .select("c_custkey",
                           F.concat(F.lit("Nº "), F.split_part("c_name", F.lit("#"), F.lit(2)))
                            .alias("number_raw"),
                           F.lower("c_mktsegment").alias("complement"),
                           F.concat(F.lit("rua "), F.lower("c_mktsegment")).alias("street"),
                           F.lower("n_name").alias("district"),
                           F.lower("r_name").alias("city"),
                           F.lower(F.substring("n_name", 1, 2)).alias("uf"),
                           F.lpad(F.col("c_custkey").cast("string"),
                                  (F.col("c_custkey") % 3 + 7).cast("int"), "0")
                            .alias("cep_raw")))
    out = a.select(
        F.col("c_custkey").alias("entity_id"),
        C.address_line(C.house_number("number_raw"), "complement", "street", "district",
                       "city", "uf", C.postal_code("cep_raw")).alias("full_address"),
        F.upper("street").alias("street"),
        C.first_number("number_raw").alias("number"),
        F.upper("uf").alias("uf"),
        C.digits_only("cep_raw").alias("cep"),
    )
    return dedup_by_key(out, ["entity_id"])


# Fixed code table for the test mapping (segment -> sector); unknown -> itself.
SEGMENT_SECTOR = {"AUTOMOBILE": "TRANSPORT", "BUILDING": "CONSTRUCTION",
                  "MACHINERY": "INDUSTRY"}


@query("region_lookup", """
SELECT c_custkey, n_name, COALESCE(r_name, 'NOT INFORMED') AS region_name,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'TRANSPORT' WHEN 'BUILDING' THEN 'CONSTRUCTION'
            WHEN 'MACHINERY' THEN 'INDUSTRY' ELSE c_mktsegment END AS sector
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
              LEFT JOIN region ON n_regionkey = r_regionkey""")
def region_lookup(t: Tables) -> DataFrame:
    """Code lookups with fallbacks (join table and literal map)."""
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = lookup_join(c, t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                    F.col("c_nationkey") == F.col("n_nationkey"))
    r = lookup_join(n, t.region.select("r_regionkey", "r_name"),
                    F.col("n_regionkey") == F.col("r_regionkey"),
                    fill={"r_name": "NOT INFORMED"})
    return r.select("c_custkey", "n_name", F.col("r_name").alias("region_name"),
                    C.lookup("c_mktsegment", SEGMENT_SECTOR, F.col("c_mktsegment"))
                     .alias("sector"))


@query("id_lookup", """
SELECT c_custkey, c_name, lpad(regexp_replace(c_name, '[^0-9]', '', 'g'), 14, '0') AS tax_id
FROM customer
WHERE lpad(regexp_replace(c_name, '[^0-9]', '', 'g'), 14, '0')
    = lpad(regexp_replace('00.000.000/0000-42', '[^0-9]', '', 'g'), 14, '0')""")
def id_lookup(t: Tables) -> DataFrame:
    """Q12: find an entity by a punctuated tax id (both sides normalised)."""
    wanted = C.tax_id(F.lit("00.000.000/0000-42"))
    c = t.customer.select("c_custkey", "c_name", C.tax_id("c_name").alias("tax_id"))
    return c.filter(F.col("tax_id") == wanted)


@query("dedup_keys", """
SELECT md5(text) AS text_md5, doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id, lang NULLS FIRST,
                               source NULLS FIRST, n_chars NULLS FIRST) AS rn
  FROM documents) WHERE rn = 1""")
def dedup_keys(t: Tables) -> DataFrame:
    """exact-copy removal; the survivor per text is the smallest doc id."""
    # group on a 256-bit digest of the whole text: the shuffle carries 64 hex chars per
    # document instead of texts of up to 20,000 words
    d = t.documents.select(F.sha2("text", 256).alias("text_sha"), F.md5("text").alias("text_md5"),
                           "doc_id", "lang", "source", "n_chars")
    return (dedup_by_key(d, ["text_sha"], order_by=["doc_id"])
            .select("text_md5", "doc_id", "lang", "source", "n_chars"))


ORDER_RULES = [
    DomainRule("orders", "status_domain", "o_orderstatus IN ('F', 'O', 'P')"),
    DomainRule("orders", "priority_domain",
               "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', "
               "'5-LOW')"),
    DomainRule("orders", "price_positive", "o_totalprice > 0"),
]
LINE_RULES = [
    DomainRule("lineitem", "returnflag_domain", "l_returnflag IN ('A', 'N', 'R')"),
    DomainRule("lineitem", "linestatus_domain", "l_linestatus IN ('O', 'F')"),
    DomainRule("lineitem", "discount_range", "l_discount BETWEEN 0.0 AND 0.1"),
    DomainRule("lineitem", "quantity_range", "l_quantity BETWEEN 1 AND 50"),
]


def _domain_sql() -> str:
    parts = []
    for rules in (ORDER_RULES, LINE_RULES):
        for r in rules:
            parts.append(
                f"SELECT '{r.table}' AS table_name, '{r.name}' AS rule, "
                f"CAST(SUM(CASE WHEN COALESCE({r.sql}, FALSE) THEN 0 ELSE 1 END) AS BIGINT)"
                f" AS n_violations, CAST(COUNT(*) AS BIGINT) AS n_rows FROM {r.table}")
    return "\nUNION ALL\n".join(parts)


@query("domain_check", _domain_sql())
def domain_check(t: Tables) -> DataFrame:
    """Allowed-domain violations per rule, one aggregate pass per table."""
    return domain_report(t.orders, ORDER_RULES).unionByName(
        domain_report(t.lineitem, LINE_RULES))


@query("clustered_two_keys", """
SELECT l_suppkey, COUNT(*) AS n_lines, CAST(SUM(l_quantity) AS BIGINT) AS quantity, MIN(l_shipdate) AS first_ship,
       TRUE AS skips_by_date, TRUE AS skips_by_supplier
FROM lineitem WHERE l_suppkey BETWEEN (SELECT MAX(l_suppkey) // 3 FROM lineitem)
  AND (SELECT MAX(l_suppkey) // 3 + MAX(l_suppkey) // 20 FROM lineitem)
GROUP BY l_suppkey""")
def clustered_two_keys(t: Tables) -> DataFrame:
    """All line items written along the curve of ship date and supplier, read back by supplier.

    The last columns say whether at most half of the files can hold a month of ship dates, and the suppliers asked for."""
    path = f"{ensure_checkpoint_dir(t.spark)}/lines-{uuid.uuid4().hex}"
    along_curve(t.lineitem, ["l_shipdate", "l_suppkey"], files=64).write.parquet(path)
    lines = t.spark.read.parquet(path)
    top, day = lines.agg(F.max("l_suppkey"), F.percentile_approx("l_shipdate", 0.5)).first()
    low, high = top // 3, top // 3 + top // 20
    by_date = share_read(lines, "l_shipdate", day, day + timedelta(days=30))
    by_supplier = share_read(lines, "l_suppkey", low, high)
    return (lines.where(F.col("l_suppkey").between(low, high)).groupBy("l_suppkey")
            .agg(F.count("*").alias("n_lines"), F.sum("l_quantity").cast("long").alias("quantity"),
                 F.min("l_shipdate").alias("first_ship"))
            .select("*", F.lit(by_date <= 0.5).alias("skips_by_date"), F.lit(by_supplier <= 0.5).alias("skips_by_supplier")))
