"""Market-news table of the registry domain: H11 ingestion, H3 merge, H12 search.

Feed items are cleaned, dated, hashed and tagged inside Spark (the source did
this in driver-side Python); the merge overwrites title, summary, tags and load
time of known ids and inserts new ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import dedup_by_key
from strata.functions.text import clean_html, extract_tags, rfc822_wallclock, url_id
from strata.operators.bucket_merge import merge_into
from strata.operators.merge import keyed_merge
from strata.operators.search import register_search_function, search
from strata.operators.search_index import indexed_texts, write_index
from strata.plans import refdata as R

NEWS_DDL = ("ID_NOTICIA string, NM_FONTE string, DS_CATEGORIA_FONTE string, "
            "DS_TITULO string, DS_RESUMO string, DS_URL_ORIGEM string, "
            "DT_PUBLICACAO timestamp, DS_TAGS string, DT_CARGA_DW timestamp")


#: What a known link takes from a new batch.
UPDATED = ["DS_TITULO", "DS_RESUMO", "DS_TAGS", "DT_CARGA_DW"]


def ingest(items: DataFrame) -> DataFrame:
    """Feed items (source, category, title, link, pub_date, description) -> rows.

    Items with an empty title or link are dropped (C14); within one batch a link
    seen twice keeps its newest item (the merge key must be unique).
    """
    title = clean_html(F.col("title"), R.TITLE_MAX)
    summary = clean_html(F.col("description"), R.SUMMARY_MAX)
    link = F.trim(F.coalesce(F.col("link"), F.lit("")))
    rows = items.select(
        F.col("source").alias("NM_FONTE"), F.col("category").alias("DS_CATEGORIA_FONTE"),
        title.alias("DS_TITULO"), summary.alias("DS_RESUMO"), link.alias("DS_URL_ORIGEM"),
        rfc822_wallclock(F.col("pub_date")).alias("DT_PUBLICACAO"))
    rows = rows.filter((F.length("DS_TITULO") > 0) & (F.length("DS_URL_ORIGEM") > 0))
    rows = rows.select(
        url_id("DS_URL_ORIGEM").alias("ID_NOTICIA"), "NM_FONTE", "DS_CATEGORIA_FONTE",
        "DS_TITULO", "DS_RESUMO", "DS_URL_ORIGEM", "DT_PUBLICACAO",
        extract_tags(F.concat_ws(" ", "DS_TITULO", "DS_RESUMO"), R.TAG_TERMS, R.DEFAULT_TAG)
        .alias("DS_TAGS"))
    return dedup_by_key(rows, ["ID_NOTICIA"], order_by=["DT_PUBLICACAO"], keep="last")


def merge_news(target: DataFrame | None, batch: DataFrame,
               spark: SparkSession | None = None) -> DataFrame:
    """H3: matched -> title, summary, tags, load time; new -> the whole row."""
    if target is None:
        target = (spark or batch.sparkSession).createDataFrame([], NEWS_DDL)
    src = batch.withColumn("DT_CARGA_DW", F.current_timestamp())
    return keyed_merge(target, src, ["ID_NOTICIA"], update_cols=UPDATED,
                       duplicates="ignore")  # ``ingest`` keeps one row a link


def merge_news_table(spark: SparkSession, path: str, batch: DataFrame) -> dict[str, int]:
    """H3 on the stored table: only buckets with a row of the batch are rewritten."""
    src = batch.withColumn("DT_CARGA_DW", F.current_timestamp())
    return merge_into(spark, path, src, ["ID_NOTICIA"], update_cols=UPDATED, duplicates="ignore", schema=NEWS_DDL)


def search_news(news: DataFrame, term: str | None, source: str | None = None,
                limit: int = 10) -> DataFrame:
    """The table function as a DataFrame call."""
    return search(news, term, source, text_cols=["DS_TITULO", "DS_RESUMO"],
                  source_col="NM_FONTE",
                  order_by=[F.col("DT_PUBLICACAO").desc(), F.col("DS_URL_ORIGEM")],
                  limit=limit).select("NM_FONTE", "DS_TITULO", "DS_RESUMO", "DS_URL_ORIGEM",
                                      "DT_PUBLICACAO")


def index_news(news: DataFrame, path: str) -> None:
    """Trigrams of titles and summaries, so that a search reads only news that can match."""
    write_index(news, path, "ID_NOTICIA", ["DS_TITULO", "DS_RESUMO"])


def search_news_indexed(spark: SparkSession, path: str, term: str | None, source: str | None = None,
                        limit: int = 10) -> DataFrame:
    """``search_news`` through the index at ``path``."""
    return search_news(indexed_texts(spark, path, term, "ID_NOTICIA"), term, source, limit)


def register_news_search(spark: SparkSession, view: str,
                         name: str = "fn_consultar_inteligencia_setorial",
                         temporary: bool = True) -> None:
    """H12 as SQL: ``SELECT * FROM fn(term [, source])`` over a registered view."""
    columns = dict.fromkeys(["NM_FONTE", "DS_TITULO", "DS_RESUMO", "DS_URL_ORIGEM"], "STRING")
    register_search_function(
        spark, name, view, columns | {"DT_PUBLICACAO": "TIMESTAMP"}, ["DS_TITULO", "DS_RESUMO"],
        "NM_FONTE", "DT_PUBLICACAO DESC, DS_URL_ORIGEM", limit=10, temporary=temporary)
