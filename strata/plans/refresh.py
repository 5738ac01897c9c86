"""Full refresh raw -> bronze -> silver -> gold; each layer runnable alone.

Layout under ``out_dir``::

    bronze/{entidades,numeros,noticias}            overwritten each run
    silver/{tbl_entidades,tbl_enderecos,tbl_hierarquia,stg_silver_numeros}
    silver/tbl_silver_numeros/vNNNNNN/bucket_of_64=N  the buckets that a merge changed (H2)
    gold/{dim_entidade,...,kpi_resumo_executivo}   overwritten, clustered (A11)
    gold/dim_inteligencia_mercado/vNNNNNN/bucket_of_64=N  likewise (H3)
    gold/idx_inteligencia_mercado/{texts,postings}    trigrams of the news (H12)

Input ``in_dir`` holds the landed, untouched API answers: ``entidades*.json``,
``numeros*.json`` (or ``.jsonl``, one item a line) and ``feeds/<SOURCE NAME>.xml``.  Re-running on the same input
changes no business value (merges are idempotent; overwrites are whole).
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bucket_merge import read_buckets
from strata.operators.flatten import union_heterogeneous
from strata.operators.watch import Watch, outside
from strata.plans import gold as G
from strata.plans import indicators as I
from strata.plans import news as N
from strata.plans import refdata as R
from strata.plans import silver as S
from strata.plans.quality import RULES
from strata.sources.documents import parse_entities, read_entity_document, read_panel
from strata.sources.feeds import damage, read_feeds, whole
from strata.sources.json_lists import json_elements
from strata.sources.sinks import first_seen_keys, in_order_of_keys, write_csv, write_raw_json, write_table

log = logging.getLogger(__name__)

MARTS = list(G.MARTS)
NEWS_INDEX = "idx_inteligencia_mercado"


def _p(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def raw_to_bronze(spark: SparkSession, in_dir: str, out_dir: str, report: dict | None = None) -> dict[str, str]:
    """Landed documents -> bronze parquet (flattened, with lineage columns).

    ``report`` takes the damaged feed items of each source, counted while the feeds are written."""
    written = {}
    ent = read_entity_document(spark, _p(in_dir, "entidades*.json"), lineage=True)
    write_table(ent, _p(out_dir, "bronze", "entidades"))
    written["entidades"] = _p(out_dir, "bronze", "entidades")
    # an array document is one record a file; JSON lines are split over tasks
    forms = [(ending, lines) for ending, lines in ((".json", False), (".jsonl", True))
             if any(name.startswith("numeros") for name in _files(spark, in_dir, ending))]
    panels = [read_panel(spark, _p(in_dir, f"numeros*{ending}"), fields=I.PANEL_FIELDS, json_lines=lines, lineage=True)
              for ending, lines in forms]
    if not panels:
        raise FileNotFoundError(f"no numeros*.json or numeros*.jsonl in {in_dir}")
    num = union_heterogeneous(panels)
    write_table(num, _p(out_dir, "bronze", "numeros"))
    written["numeros"] = _p(out_dir, "bronze", "numeros")
    category = dict(R.NEWS_SOURCES)
    landed = _files(spark, _p(in_dir, "feeds"), ".xml")
    if unknown := sorted(set(landed) - set(category)):
        raise ValueError(f"feeds of unknown sources: {', '.join(unknown)}")
    feeds = [(landed[name], name, category[name]) for name in category if name in landed]
    items = read_feeds(spark, feeds) if feeds else None
    if items is not None:
        watch = Watch(damage([name for _, name, _ in feeds]))
        write_table(whole(watch.over(items)), _p(out_dir, "bronze", "noticias"))
        broken = {name: n for name, n in watch.counts.items() if n}
        if broken:
            log.warning("damaged feed items: %s", broken)
        if report is not None:
            report["noticias"] = broken
        written["noticias"] = _p(out_dir, "bronze", "noticias")
    return written


def raw_to_csv(spark: SparkSession, in_dir: str, out_dir: str) -> dict[str, str]:
    """The landed entities as raw JSON lines (A6) and as CSV (A7), for readers outside Spark.

    The CSV's header has the flattened names in the order in which the documents show their keys."""
    items = json_elements(spark, _p(in_dir, "entidades*.json"), "entidades")
    flat = parse_entities(items)
    keys = first_seen_keys(items, "item", ["file", "block", "seq"])
    raw, csv = _p(out_dir, "raw", "entidades"), _p(out_dir, "bronze_csv", "entidades")
    write_raw_json(parse_entities(items, flat=False), raw)
    write_csv(flat, csv, in_order_of_keys(flat.columns, keys))
    return {"raw": raw, "csv": csv}


def bronze_to_silver(spark: SparkSession, out_dir: str, as_of: dt.date,
                     strict: bool = False, duplicates: str = "error", report: dict | None = None) -> dict[str, int]:
    """Bronze -> silver tables; the indicator table is merged by touched buckets.

    ``report`` takes, per bronze table, the values that lenient mode nulled (T15), counted on the way."""
    b_ent = spark.read.parquet(_p(out_dir, "bronze", "entidades"))
    of_entities = Watch(S.rejects(b_ent))
    write_table(S.entities(of_entities.over(b_ent), strict), _p(out_dir, "silver", "tbl_entidades"))
    write_table(S.addresses(b_ent, strict), _p(out_dir, "silver", "tbl_enderecos"))
    write_table(S.hierarchy(b_ent), _p(out_dir, "silver", "tbl_hierarquia"))
    b_num = spark.read.parquet(_p(out_dir, "bronze", "numeros"))
    of_numbers = Watch(I.rejects(b_num))
    write_table(I.staging(of_numbers.over(b_num), as_of), _p(out_dir, "silver", "stg_silver_numeros"))
    if report is not None:
        report |= {"entidades": of_entities.counts, "numeros": of_numbers.counts}
    stg = spark.read.parquet(_p(out_dir, "silver", "stg_silver_numeros"))
    return I.merge_indicator_table(spark, _p(out_dir, "silver", "tbl_silver_numeros"),
                                   I.unify(stg, as_of, strict), duplicates=duplicates)


def silver_numbers(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current merged indicator table."""
    df = read_buckets(spark, _p(out_dir, "silver", "tbl_silver_numeros"))
    if df is None:
        raise FileNotFoundError("no indicator table yet: run bronze_to_silver first")
    return df


def silver_to_gold(spark: SparkSession, out_dir: str, news: bool = True, report: dict | None = None) -> dict[str, str]:
    """Silver -> gold star schema and the merged news table.

    ``news=False`` leaves the news table alone: the bronze batch has been merged by an earlier run.  ``report`` takes, per
    table and rule, the rows outside the documented domains (H13), counted while the table is written."""

    def write(df: DataFrame, name: str, keys: list[str]) -> None:
        watch = Watch(outside(RULES.get(name, [])))
        write_table(df, _p(out_dir, "gold", name), cluster_by=keys, watch=watch)
        if report is not None and name in RULES:
            report[name] = watch.counts
    ent = spark.read.parquet(_p(out_dir, "silver", "tbl_entidades"))
    adr = spark.read.parquet(_p(out_dir, "silver", "tbl_enderecos"))
    edg = spark.read.parquet(_p(out_dir, "silver", "tbl_hierarquia"))
    out = {}
    for name, df, keys in [
        ("dim_entidade", G.dim_entidade(ent, adr), ["SG_UF", "ID_ENTIDADE"]),
        ("dim_hierarquia", G.dim_hierarquia(edg), ["ID_ENTIDADE_PAI"]),
        ("fato_metricas_entidades", G.fato_metricas_entidades(edg, ent, adr), ["DS_TIPO"]),
    ]:
        write(df, name, keys)
        out[name] = _p(out_dir, "gold", name)
    num = silver_numbers(spark, out_dir)
    for name in MARTS:
        write(G.build_mart(num, name), name, G.cluster_keys(name))
        out[name] = _p(out_dir, "gold", name)
    bronze_news = _p(out_dir, "bronze", "noticias")
    if news and _exists(spark, bronze_news):
        batch = N.ingest(spark.read.parquet(bronze_news))
        base = _p(out_dir, "gold", "dim_inteligencia_mercado")
        if N.merge_news_table(spark, base, batch):
            N.index_news(read_buckets(spark, base), _p(out_dir, "gold", NEWS_INDEX))
        out["dim_inteligencia_mercado"] = base
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _files(spark: SparkSession, folder: str, ending: str) -> dict[str, str]:
    """Names without their ending, and paths, of the files of a folder."""
    if not _exists(spark, folder):
        return {}
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    paths = [f.getPath() for f in found]
    return {x.getName().removesuffix(ending): f"{folder}/{x.getName()}" for x in paths if x.getName().endswith(ending)}


def gold_tables(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The gold tables as DataFrames (news only if any was loaded)."""
    names = ["dim_entidade", "dim_hierarquia", "fato_metricas_entidades", *MARTS]
    tables = {n: spark.read.parquet(_p(out_dir, "gold", n)) for n in names}
    news = read_buckets(spark, _p(out_dir, "gold", "dim_inteligencia_mercado"))
    if news is not None:
        tables["dim_inteligencia_mercado"] = news
    return tables


def refresh(spark: SparkSession, in_dir: str, out_dir: str, as_of: dt.date,
            strict: bool = False, duplicates: str = "error") -> dict:
    """Run every layer in order; returns what each step wrote."""
    rej, outside_domain = {}, {}
    bronze = raw_to_bronze(spark, in_dir, out_dir, rej)
    merge = bronze_to_silver(spark, out_dir, as_of, strict, duplicates, rej)
    gold = silver_to_gold(spark, out_dir, "noticias" in bronze, outside_domain)
    log.info("refresh done: bronze=%s merge=%s rejects=%s outside=%s gold=%s", bronze, merge, rej, outside_domain,
             sorted(gold))
    return {"bronze": bronze, "merge": merge, "rejects": rej, "outside": outside_domain, "gold": gold}
