"""H13 on the gold tables: documented column domains as checks.

The source documented each gold column's allowed values in catalog comments;
here those sets become rules evaluated in one aggregate pass per table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from strata.operators.quality import DomainRule, domain_report
from strata.plans import refdata as R


def _in(col: str, values) -> str:
    vals = ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
                     for v in values)
    return f"{col} IN ({vals})"


def _opt(col: str, values) -> str:
    return f"({col} IS NULL OR {_in(col, values)})"


RULES: dict[str, list[DomainRule]] = {
    "dim_entidade": [
        DomainRule("dim_entidade", "tipo", _in("DS_TIPO", R.ENTITY_TYPES)),
        DomainRule("dim_entidade", "situacao", _in("DS_SITUACAO", R.STATUSES)),
        DomainRule("dim_entidade", "uf_formato", "SG_UF IS NULL OR SG_UF RLIKE '^[A-Z]{2}$'"),
        DomainRule("dim_entidade", "regiao", _in("DS_REGIAO", [*R.REGIONS, R.REGION_UNKNOWN])),
        DomainRule("dim_entidade", "cnpj_14", "NR_CNPJ IS NULL OR NR_CNPJ RLIKE '^[0-9]{14}$'"),
    ],
    "dim_hierarquia": [
        DomainRule("dim_hierarquia", "nivel", _in("DS_NIVEL", R.LEVELS)),
    ],
    "fato_emissao_mensal": [
        DomainRule("fato_emissao_mensal", "granularidade",
                   _in("DS_GRANULARIDADE", R.GRANULARITIES)),
        DomainRule("fato_emissao_mensal", "serie", _in("DS_TIPO_SERIE", R.SERIES_KINDS)),
    ],
    "fato_distribuicao_geografica": [
        DomainRule("fato_distribuicao_geografica", "metrica", _in("DS_METRICA", R.GEO_METRICS)),
        DomainRule("fato_distribuicao_geografica", "objeto", _in("DS_TIPO_OBJETO", R.GEO_OBJECTS)),
    ],
    "fato_segmentacao_certificados": [
        DomainRule("fato_segmentacao_certificados", "corte",
                   _in("DS_CATEGORIA_CORTE", R.SEGMENT_CUTS)),
        DomainRule("fato_segmentacao_certificados", "tipo_certificado",
                   _opt("DS_TIPO_CERTIFICADO", R.CERT_TYPES)),
        DomainRule("fato_segmentacao_certificados", "titular",
                   _opt("DS_TIPO_USUARIO", R.HOLDER_TYPES)),
    ],
    "kpi_resumo_executivo": [
        DomainRule("kpi_resumo_executivo", "tipo_indicador", _in("DS_TIPO_INDICADOR", R.KPI_KINDS)),
    ],
    "dim_inteligencia_mercado": [
        DomainRule("dim_inteligencia_mercado", "fonte",
                   _in("NM_FONTE", [n for n, _ in R.NEWS_SOURCES])),
    ],
}


def gold_domain_report(gold: Mapping[str, DataFrame]) -> DataFrame:
    """One row per (table, rule) with violation and row counts."""
    frames = [domain_report(gold[t], rules) for t, rules in RULES.items() if t in gold]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
