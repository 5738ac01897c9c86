"""Silver layer of the registry domain: H6 entities, H7 addresses, H8 hierarchy edges.

Each table is one projection over the flattened bronze entity rows plus a
deterministic dedup on its key (F4).  ``strict=True`` keeps the source's ANSI
behaviour (a bad date or id fails the run); the default lenient mode nulls the
bad value (T15).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.functions.keys import dedup_by_key
from strata.operators.hierarchy import edges_from_parent_columns, parent_columns
from strata.operators.watch import lost
from strata.plans import refdata as R

UF_REGION = C.invert_groups(R.REGION_UFS)


def _col(df: DataFrame, name: str):
    """A flattened column, or a typed null when no document carried it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def entities(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """H6: ``tbl_entidades``."""
    to_long = (lambda c: C.strict_cast(c, "bigint")) if strict else C.safe_long
    to_int = (lambda c: C.strict_cast(c, "int")) if strict else (lambda c: c.try_cast("int"))
    out = bronze.filter(_col(bronze, "id").isNotNull()).select(
        to_long(_col(bronze, "id")).alias("id_entidade"),
        C.collapse_spaces(_col(bronze, "nome")).alias("nome_entidade"),
        C.tax_id(_col(bronze, "cnpj").cast("string")).alias("cnpj"),
        F.upper(_col(bronze, "entidade")).alias("descricao_tipo_entidade"),
        to_int(_col(bronze, "nivel")).alias("nivel_hierarquico"),
        to_int(_col(bronze, "situacao")).alias("codigo_situacao"),
        C.code_label(to_int(_col(bronze, "situacao")), R.ACCREDITED_CODE, R.ACCREDITED,
                     R.IN_ACCREDITATION).alias("situacao"),
        C.parse_date(_col(bronze, "dt_credenciamento").cast("string"), "yyyy-MM-dd",
                     lenient=not strict).alias("data_credenciamento"),
        C.digits_as_long(_col(bronze, "processo").cast("string")).alias("numero_processo"),
        _col(bronze, "telefone").cast("string").alias("telefone"),
    ).filter(F.col("id_entidade").isNotNull())
    return dedup_by_key(out, ["id_entidade"]).withColumn("data_processamento",
                                                         F.current_timestamp())


def region_of(uf) -> F.Column:
    """Macro-region of a UF (upper-cased, trimmed); unknown -> NÃO INFORMADO."""
    return C.lookup(F.upper(F.trim(uf)), UF_REGION, R.REGION_UNKNOWN)


def addresses(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """H7: ``tbl_enderecos`` from the first address of each entity."""
    a = lambda f: _col(bronze, f"enderecos_0_{f}").cast("string")
    to_long = (lambda c: C.strict_cast(c, "bigint")) if strict else C.safe_long
    out = bronze.filter(_col(bronze, "id").isNotNull()).select(
        to_long(_col(bronze, "id")).alias("id_entidade"),
        C.address_line(C.house_number(a("numero")), a("complemento"), a("logradouro"),
                       a("bairro"), a("cidade"), a("uf"), C.postal_code(a("cep")))
         .alias("endereco_completo"),
        F.upper(a("logradouro")).alias("logradouro"),
        C.first_number(a("numero")).alias("numero"),
        F.upper(a("complemento")).alias("complemento"),
        F.upper(a("bairro")).alias("bairro"),
        F.upper(a("cidade")).alias("cidade"),
        F.upper(a("uf")).alias("uf"),
        region_of(a("uf")).alias("regiao"),
        C.digits_only(a("cep")).alias("cep"),
    ).filter(F.col("id_entidade").isNotNull())
    return dedup_by_key(out, ["id_entidade"]).withColumn("data_processamento",
                                                         F.current_timestamp())


def hierarchy(bronze: DataFrame) -> DataFrame:
    """H8: ``tbl_hierarquia`` - one edge per (entity, parent) from ``ids_pai_{i}_id``."""
    cols = parent_columns(bronze, "ids_pai_", "id")
    b = bronze.filter(_col(bronze, "id").isNotNull())
    e = edges_from_parent_columns(b, _col(b, "id").try_cast("bigint"), cols,
                                  level=_col(b, "nivel").try_cast("int"))
    return e.select(F.col("parent_id").alias("id_entidade_pai"),
                    F.col("child_id").alias("id_entidade"),
                    F.col("child_level").alias("nivel_hierarquia_filho"),
                    F.current_timestamp().alias("data_processamento"))


def rejects(bronze: DataFrame) -> dict[str, Column]:
    """Conditions for entity values that the lenient projection nulls (bad ids, codes, dates)."""
    raw = lambda n: _col(bronze, n).cast("string")
    return lost({
        "id": (raw("id"), C.safe_long(raw("id"))),
        "nivel": (raw("nivel"), raw("nivel").try_cast("int")),
        "situacao": (raw("situacao"), raw("situacao").try_cast("int")),
        "dt_credenciamento": (raw("dt_credenciamento"),
                              C.parse_date(raw("dt_credenciamento"), "yyyy-MM-dd")),
        "processo": (raw("processo"), C.digits_as_long(raw("processo"))),
    })
