"""Nested-data questions on the driver's tables: B1, B2, B3/H8.

The nested documents are built from the tables row by row (``to_json``), so the
parse/flatten work grows with the tables and no group is ever collected.
"""

from __future__ import annotations

import datetime as dt
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.flatten import flatten, parse_json_column, unpivot_panel
from strata.operators.hierarchy import edges_from_parent_array, edges_from_parent_columns, parent_columns
from strata.plans import refdata as R
from strata.plans.refresh import gold_tables, raw_to_csv, refresh, silver_numbers
from strata.plans.registry import query
from strata.session import ensure_checkpoint_dir
from strata.sources.documents import read_entity_document
from strata.sources.sinks import read_csv
from strata.sources.tables import Tables


@query("edges_from_columns", """
SELECT parent_id, child_id, MIN(child_level) AS child_level FROM (
  SELECT l_partkey AS parent_id, l_orderkey AS child_id, CAST(l_linenumber AS INTEGER) AS child_level
  FROM lineitem
  UNION ALL
  SELECT l_suppkey, l_orderkey, CAST(l_linenumber AS INTEGER) FROM lineitem
) WHERE parent_id IS NOT NULL GROUP BY parent_id, child_id""")
def edges_from_columns(t: Tables) -> DataFrame:
    """Parent ids found by column name (``l_*key`` except the child key), one edge per
    (child, parent) with its lowest level."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    cols = [c for c in parent_columns(li, "l_", "key") if c != "l_orderkey"]
    return edges_from_parent_columns(li, "l_orderkey", cols, level="l_linenumber")


@query("edges_distinct_pairs", """
SELECT DISTINCT parent_id, child_id FROM (
  SELECT l_partkey AS parent_id, l_orderkey AS child_id FROM lineitem
  UNION ALL SELECT l_suppkey, l_orderkey FROM lineitem) WHERE parent_id IS NOT NULL""")
def edges_distinct_pairs(t: Tables) -> DataFrame:
    """H8 as the silver step runs it: dedup on (child, parent) only."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    cols = [c for c in parent_columns(li, "l_", "key") if c != "l_orderkey"]
    return edges_from_parent_columns(li, "l_orderkey", cols).select("parent_id", "child_id")


@query("edges_from_lists", """
SELECT parent_id, child_id, MIN(child_level) AS child_level FROM (
  SELECT CAST(l_partkey AS BIGINT) AS parent_id, CAST(l_orderkey AS BIGINT) AS child_id,
         CAST(l_linenumber AS INTEGER) AS child_level FROM lineitem
  UNION ALL SELECT l_suppkey, l_orderkey, CAST(l_linenumber AS INTEGER) FROM lineitem
) GROUP BY parent_id, child_id""")
def edges_from_lists(t: Tables) -> DataFrame:
    """H8 straight from nested lists of parents, without a column a position."""
    def parent(c):
        return F.struct(F.col(c).cast("bigint").alias("id"))
    docs = t.lineitem.select(F.col("l_orderkey").cast("bigint").alias("id"), F.col("l_linenumber").alias("nivel"),
                             F.array(parent("l_partkey"), parent("l_suppkey")).alias("ids_pai"))
    return edges_from_parent_array(docs, "id", "ids_pai", level="nivel")


@query("flatten_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events""")
def flatten_props(t: Tables) -> DataFrame:
    """B1 on a JSON text column: schema inferred by the JSON reader, then flattened."""
    e = parse_json_column(t.events.select("event_id", "props"), "props")
    return flatten(e)


def _customer_docs(t: Tables) -> DataFrame:
    j = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                   .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    k = F.col("c_custkey") % 3
    parents = (F.when(k == 0, F.array().cast("array<struct<id:bigint>>"))
                .when(k == 1, F.array(F.struct(F.col("c_nationkey").cast("bigint").alias("id"))))
                .otherwise(F.array(F.struct(F.col("c_nationkey").cast("bigint").alias("id")),
                                   F.struct(F.col("n_regionkey").cast("bigint").alias("id")))))
    doc = F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"),
        F.struct(F.col("n_name").alias("cidade"), F.col("r_name").alias("uf")).alias("endereco"),
        parents.alias("ids_pai"),
        F.array(F.col("c_mktsegment"), F.col("n_name")).alias("tags"),
        F.array(F.col("c_nationkey"), F.col("n_regionkey")).alias("codes")))
    return j.select(doc.alias("doc"))


@query("flatten_nested", """
SELECT c_custkey AS id, c_name AS nome, n_name AS endereco_cidade, r_name AS endereco_uf,
       CASE WHEN c_custkey % 3 >= 1 THEN CAST(c_nationkey AS BIGINT) END AS ids_pai_0_id,
       CASE WHEN c_custkey % 3 = 2 THEN CAST(n_regionkey AS BIGINT) END AS ids_pai_1_id,
       c_mktsegment || ', ' || n_name AS tags,
       CAST(c_nationkey AS VARCHAR) || ', ' || CAST(n_regionkey AS VARCHAR) AS codes
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def flatten_nested(t: Tables) -> DataFrame:
    """B1 on nested entity documents: struct -> ``a_b``, list of objects -> ``l_i_x``
    (as many positions as the longest list; an empty list gives nulls), list of
    scalars -> one ``', '``-joined string."""
    docs = parse_json_column(_customer_docs(t), "doc")
    return flatten(docs.select(F.col("doc.*")))


@query("flatten_mixed", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'F' THEN
         CASE WHEN o_orderstatus = 'O' THEN o_orderkey || ', ' || '{"a":' || o_custkey || '}' ELSE o_orderpriority END
       END AS info_l,
       CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS info_l_0_a, CAST(NULL AS VARCHAR) AS info_l_0_b,
       CAST(NULL AS BIGINT) AS info_l_1_a,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS info_l_1_b
FROM orders""")
def flatten_mixed(t: Tables) -> DataFrame:
    """B1 on a list that differs from row to row: objects, text, or numbers with an object behind them.

    The first element decides in each row whether the list becomes positions or one joined text."""
    a = F.to_json(F.struct(F.col("o_custkey").alias("a")))
    b = F.to_json(F.struct(F.col("o_orderpriority").alias("b")))
    text = F.to_json(F.array("o_orderpriority"))
    items = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("["), a, F.lit(","), b, F.lit("]")))
             .when(F.col("o_orderstatus") == "O", F.concat(F.lit("["), F.col("o_orderkey"), F.lit(","), a, F.lit("]")))
             .otherwise(text))
    doc = F.concat(F.lit('{"id":'), F.col("o_orderkey"), F.lit(',"info":{"l":'), items, F.lit("}}"))
    return flatten(parse_json_column(t.orders.select(doc.alias("doc")), "doc").select("doc.*"))


def _land(rows: DataFrame, item: str, path: str, head: str = '{"versao": 2, "entidades": [', tail: str = "]}") -> None:
    """Write JSON texts as documents, one file a partition: all its items in one list."""
    def work(batches):
        first = True
        yield pa.RecordBatch.from_arrays([pa.array([head])], ["value"])
        for batch in batches:
            texts = batch.column(0).to_pylist()
            lines = [t if first and not i else f",{t}" for i, t in enumerate(texts)]
            first = first and not lines
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([tail])], ["value"])
    rows.select(item).mapInArrow(work, "value string").write.text(path)


@query("entity_documents", """
SELECT c_custkey AS id, c_name AS nome, CAST(c_nationkey AS BIGINT) AS endereco_pais, c_mktsegment AS endereco_setor,
       c_custkey AS ids_pai_0_id, CAST(c_nationkey AS BIGINT) AS ids_pai_1_id
FROM customer""")
def entity_documents(t: Tables) -> DataFrame:
    """A1: all customers landed as documents with one long list each, read back element by element and flattened."""
    folder = f"{ensure_checkpoint_dir(t.spark)}/entities-{uuid.uuid4().hex}"
    item = F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"),
        F.struct(F.col("c_nationkey").alias("pais"), F.col("c_mktsegment").alias("setor")).alias("endereco"),
        F.array(F.struct(F.col("c_custkey").alias("id")), F.struct(F.col("c_nationkey").alias("id"))).alias("ids_pai")))
    _land(t.customer.select(item.alias("item")), "item", folder)
    return read_entity_document(t.spark, folder)


@query("csv_records", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority || ', "x"' END AS nota,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS cliente_id,
       CASE WHEN o_orderstatus = 'P' THEN '0' || o_custkey END AS codigo
FROM orders""")
def csv_records(t: Tables) -> DataFrame:
    """Orders as JSON records with different keys, written as CSV under all their keys, read back as text."""
    base = f"{ensure_checkpoint_dir(t.spark)}/csv-{uuid.uuid4().hex}"
    status = F.col("o_orderstatus")
    item = F.to_json(F.struct(
        F.col("o_orderkey").alias("id"),
        F.when(status != "P", F.concat("o_orderpriority", F.lit(', "x"'))).alias("nota"),
        F.when(status != "F", F.struct(F.col("o_custkey").alias("id"))).alias("cliente"),
        F.when(status == "P", F.concat(F.lit("0"), F.col("o_custkey"))).alias("codigo")))  # to_json leaves nulls out
    _land(t.orders.select(item.alias("item")), "item", f"{base}/in/entidades.json")
    written = raw_to_csv(t.spark, f"{base}/in", f"{base}/out")
    return read_csv(t.spark, written["csv"]).select("id", "nota", "cliente_id", "codigo")


@query("refresh_layers", """
WITH nodes AS (
  SELECT c_custkey AS id, c_name AS name, 900000000 + c_nationkey AS parent, c_acctbal AS balance FROM customer
  UNION ALL SELECT 900000000 + n_nationkey, n_name, 1000000000 + n_regionkey, NULL FROM nation
  UNION ALL SELECT 1000000000 + r_regionkey, r_name, NULL, NULL FROM region),
orders_of AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n FROM orders),
counted AS (
  SELECT 900000000 + c_nationkey AS id, 0 AS nations, COUNT(*) AS customers FROM customer GROUP BY c_nationkey
  UNION ALL
  SELECT 1000000000 + n_regionkey, COUNT(DISTINCT n_nationkey), COUNT(c_custkey)
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_regionkey)
SELECT CAST(nodes.id AS BIGINT) AS entity_id, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS entity_name,
       CASE WHEN nodes.id >= 1000000000 THEN 'ROOT' WHEN nodes.id >= 900000000 THEN 'NATION' ELSE 'AR' END AS entity_type,
       CASE WHEN balance < 0 THEN 'EM CREDENCIAMENTO' ELSE 'CREDENCIADA' END AS status,
       CAST(COALESCE(nations, 0) AS BIGINT) AS n_nations, CAST(COALESCE(customers, 0) AS BIGINT) AS n_customers,
       n AS indicator, (SELECT COUNT(*) FROM customer) AS lost_dates
FROM nodes LEFT JOIN counted ON nodes.id = counted.id, orders_of""")
def refresh_layers(t: Tables) -> DataFrame:
    """Customers, nations and regions landed as documents, the number of orders as a panel, then all layers.

    From gold: the entity master, the descendants counted over the hierarchy, one indicator; and, from the run's report, how
    many dates the lenient mode nulled (each customer's is bad)."""
    base = f"{ensure_checkpoint_dir(t.spark)}/refresh-{uuid.uuid4().hex}"
    def parent(c):
        return F.array(F.struct(c.cast("long").alias("id")))
    none = F.array().cast("array<struct<id:bigint>>")
    code = F.when(F.col("c_acctbal") < 0, F.lit(4001)).otherwise(F.lit(R.ACCREDITED_CODE))
    kinds = [(t.customer, "c_custkey", F.lit(0), "c_name", "AR", 3, parent(F.col("c_nationkey") + 900_000_000), code, "2020-13-01"),
             (t.nation, "n_nationkey", F.lit(900_000_000), "n_name", "Nation", 1, parent(F.col("n_regionkey") + 1_000_000_000),
              F.lit(R.ACCREDITED_CODE), "2020-01-01"),
             (t.region, "r_regionkey", F.lit(1_000_000_000), "r_name", "Root", 0, none, F.lit(R.ACCREDITED_CODE), "2020-01-01")]
    rows = None
    for df, key, offset, name, kind, level, parents, status, date in kinds:
        part = df.select(F.to_json(F.struct(
            (F.col(key) + offset).cast("long").alias("id"), F.col(name).alias("nome"), F.lit(kind).alias("entidade"),
            F.lit(level).alias("nivel"), status.alias("situacao"), F.lit(date).alias("dt_credenciamento"),
            parents.alias("ids_pai"))).alias("item"))
        rows = part if rows is None else rows.union(part)
    _land(rows, "item", f"{base}/in/entidades.json")
    total = t.orders.agg(F.count("*").alias("n")).select(
        F.concat(F.lit('{"cerVisGerAtivos":'), F.col("n"), F.lit("}")).alias("item"))
    _land(total, "item", f"{base}/in/numeros.json", "[", "]")
    result = refresh(t.spark, f"{base}/in", f"{base}/out", dt.date(2025, 12, 31))
    gold = gold_tables(t.spark, f"{base}/out")
    counts = gold["fato_metricas_entidades"].select("ID_ENTIDADE", "NR_AGREGADOS_AC_NIVEL_1", "NR_AGREGADOS_AR")
    indicator = silver_numbers(t.spark, f"{base}/out").agg(F.max("VL_METRICA").alias("indicator"))
    master = gold["dim_entidade"].join(counts, "ID_ENTIDADE", "left").join(indicator)  # one row
    return master.select(
        F.col("ID_ENTIDADE").alias("entity_id"), F.col("DS_ENTIDADE").alias("entity_name"),
        F.col("DS_TIPO").alias("entity_type"), F.col("DS_SITUACAO").alias("status"),
        F.coalesce("NR_AGREGADOS_AC_NIVEL_1", F.lit(0)).cast("long").alias("n_nations"),
        F.coalesce("NR_AGREGADOS_AR", F.lit(0)).cast("long").alias("n_customers"), "indicator",
        F.lit(result["rejects"]["entidades"]["dt_credenciamento"]).cast("long").alias("lost_dates"))


def _panel_items(t: Tables) -> DataFrame:
    c = t.conversations.select("turn", "role", "text")
    sentences = F.split(F.col("text"), r"\. ", -1)
    objs = F.transform(sentences, lambda s: F.struct(F.col("turn").alias("indice"),
                                                     s.alias("valor"),
                                                     F.length(s).alias("n")))
    head = (F.when(F.col("turn") == 0, F.to_json(F.create_map(F.col("role"), F.col("text"))))
             .when(F.col("turn") % 2 == 1, F.to_json(F.create_map(F.col("role"), sentences)))
             .otherwise(F.to_json(F.create_map(F.col("role"), objs))))
    # a second key per item must be ignored by the unpivot
    item = F.concat(F.expr("substring({0}, 1, length({0}) - 1)".format("_head")),
                    F.lit(', "turn": '), F.col("turn").cast("string"), F.lit("}"))
    return c.select(head.alias("_head"), "turn").select(item.alias("item"))


@query("panel_unpivot", """
SELECT role AS indicador, CAST(NULL AS BIGINT) AS indice, text AS valor, CAST(NULL AS BIGINT) AS n
FROM conversations WHERE turn = 0
UNION ALL
SELECT role, CAST(pos - 1 AS BIGINT), s, CAST(NULL AS BIGINT) FROM (
  SELECT role, unnest(string_split(text, '. ')) AS s,
         generate_subscripts(string_split(text, '. '), 1) AS pos
  FROM conversations WHERE turn % 2 = 1)
UNION ALL
SELECT role, CAST(turn AS BIGINT), s, CAST(length(s) AS BIGINT) FROM (
  SELECT role, turn, unnest(string_split(text, '. ')) AS s
  FROM conversations WHERE turn > 0 AND turn % 2 = 0)""")
def panel_unpivot(t: Tables) -> DataFrame:
    """B2: conversation turns as panel items ``{role: value, "turn": t}``.

    Opening turns carry the text as a scalar, odd turns a list of sentences, other
    turns a list of objects whose own ``indice`` replaces the list position.
    """
    out = unpivot_panel(_panel_items(t), "item", fields=["n"])
    return out.withColumn("n", F.col("n").try_cast("bigint"))
