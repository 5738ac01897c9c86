"""The source's analytic question set (Q1-Q26) over the gold tables.

Each function takes the gold tables (``refresh.gold_tables``) and returns a
DataFrame; parameters the source typed into its SQL are arguments here.  Every
top-k adds the key as a tie-breaker so the answer is repeatable.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.clean import tax_id
from strata.operators import analytics as A
from strata.plans import refdata as R
from strata.plans.news import search_news

Gold = Mapping[str, DataFrame]
AC_TYPES = ["AC 1º NÍVEL", "AC 2º NÍVEL"]
MONTHLY = "MENSAL CORRENTE"


def _active_ars(g: Gold) -> DataFrame:
    return g["dim_entidade"].filter((F.col("DS_SITUACAO") == R.ACCREDITED) &
                                    (F.col("DS_TIPO") == "AR"))


def q1_top_authorities(g: Gold, n: int = 5) -> DataFrame:
    """Five largest accredited ACs by subordinate ARs."""
    m = g["fato_metricas_entidades"]
    return (m.filter(F.col("DS_TIPO").isin(*AC_TYPES) & (F.col("DS_SITUACAO") == R.ACCREDITED))
             .orderBy(F.col("NR_AGREGADOS_AR").desc(), F.col("ID_ENTIDADE"))
             .limit(n).select("ID_ENTIDADE", "DS_ENTIDADE", "SG_UF", "DS_TIPO", "NR_AGREGADOS_AR"))


def q2_monthly_emissions(g: Gold) -> DataFrame:
    e = g["fato_emissao_mensal"].filter(F.col("DS_TIPO_SERIE") == MONTHLY)
    return (e.groupBy("DT_ANO", "DT_MES_ANO").agg(F.sum("VL_METRICA").alias("TOTAL_EMISSOES"))
             .orderBy(F.col("DT_MES_ANO").desc()))


def q3_active_ars_by_uf(g: Gold) -> DataFrame:
    return (_active_ars(g).groupBy("SG_UF", "DS_REGIAO")
            .agg(F.countDistinct("ID_ENTIDADE").alias("TOTAL_ARS"))
            .orderBy(F.col("TOTAL_ARS").desc(), F.col("SG_UF")))


def q4_recent_news(g: Gold, term: str = "icp-brasil", sources=("ANCD", "CRYPTO ID"),
                   n: int = 5) -> DataFrame:
    d = g["dim_inteligencia_mercado"]
    hit = F.lower("DS_TITULO").like(f"%{term}%") | F.lower("DS_TAGS").like(f"%{term}%")
    return (d.filter(hit & F.col("NM_FONTE").isin(*sources))
             .orderBy(F.col("DT_PUBLICACAO").desc(), F.col("ID_NOTICIA")).limit(n)
             .select("NM_FONTE", "DS_TITULO", "DT_PUBLICACAO", "DS_URL_ORIGEM"))


def q5_latest_month_total(g: Gold) -> DataFrame:
    m = (g["fato_emissao_mensal"].filter(F.col("DS_TIPO_SERIE") == MONTHLY)
         .filter(F.col("DT_MES_ANO").isNotNull())
         .groupBy("DT_MES_ANO").agg(F.sum("VL_METRICA").alias("VL_METRICA")))
    return A.latest_period_rows(m, "DT_MES_ANO").agg(
        F.sum("VL_METRICA").alias("TOTAL_EMISSOES_MES"))


def q6_active_ars_in_uf(g: Gold, uf: str = "SP") -> DataFrame:
    return (_active_ars(g).filter(F.col("SG_UF") == uf)
            .agg(F.countDistinct("ID_ENTIDADE").alias("TOTAL_ARS")))


def q7_trailing_12_months(g: Gold) -> DataFrame:
    m = (g["fato_emissao_mensal"].filter(F.col("DS_TIPO_SERIE") == MONTHLY)
         .filter(F.col("DT_MES_ANO").isNotNull())
         .groupBy("DT_MES_ANO").agg(F.sum("VL_METRICA").alias("VL_METRICA")))
    return A.trailing_period_rows(m, "DT_MES_ANO", 12).agg(
        F.sum("VL_METRICA").alias("TOTAL_12_MESES"))


def q8_a1_a3_share(g: Gold) -> DataFrame:
    s = (g["fato_segmentacao_certificados"]
         .filter((F.col("DS_CATEGORIA_CORTE") == "TIPO CERTIFICADO") &
                 F.col("DS_TIPO_CERTIFICADO").isin("A1", "A3"))
         .groupBy("DS_TIPO_CERTIFICADO").agg(F.sum("VL_METRICA").alias("VL_METRICA")))
    return A.share_of_total(s, "VL_METRICA", "PARTICIPACAO", 4)


def q9_supply(g: Gold) -> DataFrame:
    return (_active_ars(g).groupBy("SG_UF", "DS_REGIAO")
            .agg(F.countDistinct("ID_ENTIDADE").alias("QTD_ARS_OFERTA")))


def q10_demand(g: Gold, metric: str = "EMISSAO ANUAL") -> DataFrame:
    d = g["fato_distribuicao_geografica"]
    return (d.filter((F.col("DS_METRICA") == metric) & (F.col("DS_TIPO_OBJETO") == "CERTIFICADOS"))
             .groupBy("SG_UF", "DS_REGIAO").agg(F.sum("VL_METRICA").alias("TOTAL_EMISSOES_DEMANDA")))


def q11_demand_per_supply(g: Gold, metric: str = "EMISSAO ANUAL") -> DataFrame:
    s = q9_supply(g).groupBy("DS_REGIAO").agg(F.sum("QTD_ARS_OFERTA").alias("QTD_ARS_OFERTA"))
    d = q10_demand(g, metric).groupBy("DS_REGIAO").agg(
        F.sum("TOTAL_EMISSOES_DEMANDA").alias("TOTAL_EMISSOES_DEMANDA"))
    return A.compare_sides(s, d, ["DS_REGIAO"], "TOTAL_EMISSOES_DEMANDA", "QTD_ARS_OFERTA",
                           "EMISSOES_POR_AR", 2)


def q12_lookup_tax_id(g: Gold, tax: str) -> DataFrame:
    return g["dim_entidade"].filter(F.col("NR_CNPJ") == tax_id(F.lit(tax)))


def q13_top_ufs(g: Gold, n: int = 10) -> DataFrame:
    return q3_active_ars_by_uf(g).limit(n)


def q14_per_authority(g: Gold) -> DataFrame:
    m = g["fato_metricas_entidades"]
    return m.groupBy("ID_ENTIDADE", "DS_ENTIDADE", "DS_TIPO").agg(
        F.sum("NR_AGREGADOS_AC_NIVEL_1").alias("NR_AGREGADOS_AC_NIVEL_1"),
        F.sum("NR_AGREGADOS_AC_NIVEL_2").alias("NR_AGREGADOS_AC_NIVEL_2"),
        F.sum("NR_AGREGADOS_AR").alias("NR_AGREGADOS_AR"))


def q15_accreditations_by_year_type(g: Gold) -> DataFrame:
    return (g["dim_entidade"].groupBy(F.year("DT_CREDENCIAMENTO").alias("ANO"), "DS_TIPO")
            .agg(F.count(F.lit(1)).alias("QTD")))


def q16_region_crosstab(g: Gold) -> DataFrame:
    return A.pivot_counts(g["dim_entidade"], ["DS_REGIAO"], "DS_TIPO", R.ENTITY_TYPES,
                          ["QTD_AR", "QTD_AC_1", "QTD_AC_2", "QTD_AC_RAIZ"])


def q17_parent_child(g: Gold) -> DataFrame:
    ent = g["dim_entidade"].select("ID_ENTIDADE", "DS_ENTIDADE")
    p = ent.toDF("ID_ENTIDADE_PAI", "DS_ENTIDADE_PAI")
    c = ent.toDF("ID_ENTIDADE", "DS_ENTIDADE")
    return (g["dim_hierarquia"].join(p, "ID_ENTIDADE_PAI", "left").join(c, "ID_ENTIDADE", "left")
            .select("ID_ENTIDADE_PAI", "DS_ENTIDADE_PAI", "ID_ENTIDADE", "DS_ENTIDADE", "DS_NIVEL"))


def q18_metric_view(g: Gold, uf=None, region=None, kind=None, status=None) -> DataFrame:
    return A.metric_view(g["dim_entidade"], ["SG_UF", "DS_REGIAO", "DS_TIPO", "DS_SITUACAO"],
                         [F.countDistinct("ID_ENTIDADE").alias("QTD_ENTIDADES")],
                         filters={"SG_UF": uf, "DS_REGIAO": region, "DS_TIPO": kind,
                                  "DS_SITUACAO": status})


def _yearly(g: Gold, kind: str) -> DataFrame:
    return (g["fato_emissao_mensal"].filter(F.col("DS_TIPO_SERIE") == kind)
            .groupBy("DT_ANO").agg(F.sum("VL_METRICA").alias("VL_METRICA")))


def q19_active_over_issued(g: Gold) -> DataFrame:
    a = _yearly(g, "HISTORICO ATIVOS").withColumnRenamed("VL_METRICA", "ATIVOS")
    e = _yearly(g, "HISTORICO EMITIDOS").withColumnRenamed("VL_METRICA", "EMITIDOS")
    return A.compare_sides(a, e, ["DT_ANO"], "ATIVOS", "EMITIDOS", "RAZAO_ATIVOS_EMITIDOS", 4)


def q20_year_over_year(g: Gold, kind: str = "HISTORICO ATIVOS") -> DataFrame:
    return A.year_over_year(_yearly(g, kind).filter(F.col("DT_ANO").isNotNull()), "DT_ANO",
                            "VL_METRICA", prev_col="VL_ANO_ANTERIOR", pct_col="VARIACAO_PCT")


def q21_series_with_news(g: Gold, keyword: str | None = None) -> DataFrame:
    e = (g["fato_emissao_mensal"].filter(F.col("DS_TIPO_SERIE") == MONTHLY)
         .groupBy("DT_MES_ANO").agg(F.sum("VL_METRICA").alias("TOTAL_EMISSOES")))
    n = g["dim_inteligencia_mercado"]
    if keyword:
        n = n.filter(F.lower("DS_TITULO").like(f"%{keyword.lower()}%") |
                     F.lower("DS_TAGS").like(f"%{keyword.lower()}%"))
    n = n.select(A.month_of("DT_PUBLICACAO").alias("DT_MES_ANO"), "NM_FONTE", "DS_TITULO",
                 "DS_URL_ORIGEM")
    return e.join(n, "DT_MES_ANO", "left")


def q22_news_search(g: Gold, term: str | None, source: str | None = None) -> DataFrame:
    return search_news(g["dim_inteligencia_mercado"], term, source)


def q23_title_or_tag_in_source(g: Gold, term: str, source: str, n: int = 10) -> DataFrame:
    d = g["dim_inteligencia_mercado"]
    hit = F.col("DS_TITULO").ilike(f"%{term}%") | F.col("DS_TAGS").ilike(f"%{term}%")
    return (d.filter(hit & (F.col("NM_FONTE") == source))
             .orderBy(F.col("DT_PUBLICACAO").desc(), F.col("ID_NOTICIA")).limit(n))


def q24_series_of_year(g: Gold, kind: str, year: int) -> DataFrame:
    return g["fato_emissao_mensal"].filter((F.col("DS_TIPO_SERIE") == kind) &
                                           (F.col("DS_GRANULARIDADE") == "ANUAL") &
                                           (F.col("DT_ANO") == year))


def q25_holder_segments(g: Gold) -> DataFrame:
    s = (g["fato_segmentacao_certificados"]
         .filter(F.col("DS_CATEGORIA_CORTE").isin("TIPO USO", "TIPO TITULAR") &
                 F.col("DS_TIPO_USUARIO").isin(*R.HOLDER_TYPES))
         .groupBy("DS_TIPO_USUARIO").agg(F.sum("VL_METRICA").alias("VL_METRICA")))
    return A.share_of_total(s, "VL_METRICA", "PARTICIPACAO", 4)


def q26_kpi_pick(g: Gold, indicator: str, kind: str = "ACUMULADO ATUAL") -> DataFrame:
    return g["kpi_resumo_executivo"].filter((F.col("DS_INDICADOR") == indicator) &
                                            (F.col("DS_TIPO_INDICADOR") == kind))


ALL = {name: fn for name, fn in globals().items() if name[:1] == "q" and name[1:2].isdigit()}
