"""Code tables of the certification-registry domain.

FIXED VALUES - these must equal the source system's values for the results to
match (indicator keys and labels, flags, year offsets, region lists, feed
sources, tag terms, status code).  They are listed plainly, in their natural
order.  Year offsets are relative to the run's ``as_of`` date instead of the
wall clock.
"""

from __future__ import annotations

# --- FIXED VALUES: panel indicator key -> label (33 entries) -------------------------
INDICATOR_LABELS = {
    "cerVisGerHisAtivos": "cerVisao Geral Ativos Ano a ano",
    "cerVisGerHistEmitidos": "cerVisao Geral Emitidos Ano a ano",
    "cerVisGerCompMenAnoAtual": "cerVisao Geral Mes a mes ANO ATUAL",
    "cerVisGerCompMenAnoPassado": "cerVisao Geral Mes a mes ANO PASSADO",
    "cerVisGerCompMenAnoRetrasado": "cerVisao Geral Mes a mes ANO RETRASADO",
    "certDistMapa": "cerDistribuicao Mapa ANO ATUAL",
    "certDistCerMen": "cerDistribuicao Mes a mes ",
    "estMap": "estVisao Geral Mapa ANO ATUAL",
    "certDistCerTipo": "cerDistribuicao Tipo ANO ATUAL",
    "certDistCerUso": "cerDistribuicao Uso ANO ATUAL",
    "cerVisGerDisAssinatura": "cerVisao Geral Assinatura certificado ACUMULADO",
    "cerVisGerDisTipo": "cerVisao Geral Tipo certificado ACUMULADO",
    "cerVisGerAtivos": "cerVisao Geral Ativos (nao expirados, nao revogados)",
    "cerVisGerEmitidos": "cerVisao Geral Emitidos",
    "cerVisGerToEmRelAAnterior":
        "cerVisao Geral Total de emissoes em relacao ao ano anterior PERCENTUAL",
    "cerVisGerProAAtual": "cerVisao Geral Projecao para ANO ATUAL",
    "estAgtRegistro": "estVisao Geral Agentes de Registro ACUMULADO",
    "estAcumuladoAc1": "estVisao Geral AC-1 ACUMULADO",
    "estAcumuladoAc2": "estVisao Geral AC-2 ACUMULADO",
    "estAcumuladoAutReg": "estVisao Geral Autoridades de Registro ACUMULADO",
    "estAcumuladoPSS": "estVisao Geral Prestadores de Servico de Suporte ACUMULADO",
    "estAcumuladoACT": "estVisao Geral Autoridade de Carimbo do Tempo ACUMULADO",
    "estAcumuladoPSC": "estVisao Geral Prestadores de Servico de Confianca ACUMULADO",
    "estAcumuladoPSB": "estVisao Geral Prestadores de Servico Biometrico ACUMULADO",
    "estCompAC2": "estComparativo AC-2 com o ANO ATUAL",
    "estCompAC2RelAnoAnterior": "estComparativo AC-2 com o ANO PASSADO PERCENTUAL",
    "estCompAR": "estComparativo AR com o ANO ATUAL",
    "estCompARRelAnoAnterior": "estComparativo AR com o ANO PASSADO PERCENTUAL",
    "estCompMenAnoAtual": "estComparativo AR credenciamento com o ANO ATUAL",
    "estCompMenAnoAnterior": "estComparativo AR credenciamento com o ANO PASSADO",
    "manutencao": "manutencao",
    "versao": "versao",
    "finalizado": "finalizado",
}

# --- FIXED VALUES: panel indicator key -> flag (30 entries; unknown -> OUTROS) -------
INDICATOR_FLAGS = {
    "cerVisGerHisAtivos": "cerHISTORICO_ANUAL_EMISSAO_ATIVOS",
    "cerVisGerHistEmitidos": "cerHISTORICO_ANUAL_EMISSAO_EMITIDOS",
    "cerVisGerCompMenAnoAtual": "cerEMISSAO_CORRENTE",
    "cerVisGerCompMenAnoPassado": "cerEMISSAO_CORRENTE",
    "cerVisGerCompMenAnoRetrasado": "cerEMISSAO_CORRENTE",
    "certDistMapa": "regEMISSAO_ANUAL",
    "certDistCerMen": "regEMISSAO_MENSAL",
    "estMap": "regAR_CORRENTE",
    "certDistCerTipo": "disTIPO",
    "certDistCerUso": "disUSO",
    "cerVisGerDisAssinatura": "disCERTIFICADOS_ASSINATURA",
    "cerVisGerDisTipo": "disCERTIFICADOS_TIPO",
    "cerVisGerAtivos": "infHEADER_ATIVOS",
    "cerVisGerEmitidos": "infHEADER_EMITIDOS",
    "cerVisGerToEmRelAAnterior": "infHEADER_TOTAL_REL_ANTERIOR",
    "cerVisGerProAAtual": "infHEADER_PROJECAO_ATUAL",
    "estAgtRegistro": "infHEADER_ACUMULADO_AGENTE_REGISTRO",
    "estAcumuladoAc1": "infHEADER_ACUMULADO_AC1",
    "estAcumuladoAc2": "infHEADER_ACUMULADO_AC2",
    "estAcumuladoAutReg": "infHEADER_ACUMULADO_AUT_REG",
    "estAcumuladoPSS": "infHEADER_ACUMULADO_PSS",
    "estAcumuladoACT": "infHEADER_ACUMULADO_ACT",
    "estAcumuladoPSC": "infHEADER_ACUMULADO_PSC",
    "estAcumuladoPSB": "infHEADER_ACUMULADO_PSB",
    "estCompAC2": "infHEADER_COMPARATIVO_AC2",
    "estCompAC2RelAnoAnterior": "infHEADER_COMPARATIVO_AC2_REL_ANTERIOR",
    "estCompAR": "infHEADER_COMPARATIVO_AR",
    "estCompARRelAnoAnterior": "infHEADER_COMPARATIVO_AR_REL_ANTERIOR",
    "estCompMenAnoAtual": "infCREDENCIAMENTO_AR",
    "estCompMenAnoAnterior": "infCREDENCIAMENTO_AR",
}
UNKNOWN_FLAG = "OUTROS"

# --- FIXED VALUES: label -> years before the as_of year (0 current, 1 last, 2 the one before)
LABEL_YEARS_BACK = {
    "cerVisao Geral Mes a mes ANO ATUAL": 0,
    "cerVisao Geral Mes a mes ANO PASSADO": 1,
    "cerVisao Geral Mes a mes ANO RETRASADO": 2,
    "cerDistribuicao Mapa ANO ATUAL": 0,
    "cerDistribuicao Tipo ANO ATUAL": 0,
    "cerDistribuicao Uso ANO ATUAL": 0,
    "estVisao Geral Mapa ANO ATUAL": 0,
    "estComparativo AC-2 com o ANO ATUAL": 0,
    "estComparativo AR com o ANO ATUAL": 0,
    "estComparativo AR credenciamento com o ANO ATUAL": 0,
    "estComparativo AC-2 com o ANO PASSADO PERCENTUAL": 1,
    "estComparativo AR com o ANO PASSADO PERCENTUAL": 1,
    "estComparativo AR credenciamento com o ANO PASSADO": 1,
}

# --- FIXED VALUES: labels whose value stands for a whole year: years before the as_of year ---
YEAR_LABELS = {
    "cerDistribuicao Mapa ANO ATUAL": 0,
    "estVisao Geral Mapa ANO ATUAL": 0,
    "cerVisao Geral Ativos (nao expirados, nao revogados)": 0,
    "cerVisao Geral Emitidos": 0,
    "cerVisao Geral Total de emissoes em relacao ao ano anterior PERCENTUAL": 0,
    "cerVisao Geral Projecao para ANO ATUAL": 0,
    "estVisao Geral Agentes de Registro ACUMULADO": 0,
    "estVisao Geral AC-1 ACUMULADO": 0,
    "estVisao Geral AC-2 ACUMULADO": 0,
    "estVisao Geral Autoridades de Registro ACUMULADO": 0,
    "estVisao Geral Prestadores de Servico de Suporte ACUMULADO": 0,
    "estVisao Geral Autoridade de Carimbo do Tempo ACUMULADO": 0,
    "estVisao Geral Prestadores de Servico de Confianca ACUMULADO": 0,
    "estVisao Geral Prestadores de Servico Biometrico ACUMULADO": 0,
    "estComparativo AC-2 com o ANO ATUAL": 0,
    "estComparativo AR com o ANO ATUAL": 0,
    "estComparativo AC-2 com o ANO PASSADO PERCENTUAL": 1,
    "estComparativo AR com o ANO PASSADO PERCENTUAL": 1,
}
# FIXED VALUES: flags of the yearly series; their index 0 to 5 counts up to the as_of year
HISTORY_FLAGS = ["cerHISTORICO_ANUAL_EMISSAO_ATIVOS", "cerHISTORICO_ANUAL_EMISSAO_EMITIDOS"]
HISTORY_LAST_INDEX = 5
# FIXED VALUES: first three letters of a flag -> part of the indicator table
FLAG_PARTS = {"cer": "CTE_CER", "reg": "CTE_REG", "inf": "CTE_INF", "dis": "CTE_DIS"}

# Month of a 0-based index is index + 1 (rule, not a table); only these flags are monthly.
MONTHLY_FLAGS = ["cerEMISSAO_CORRENTE", "infCREDENCIAMENTO_AR"]

# --- FIXED VALUES: federative unit -> macro-region ------------------------------------
REGION_UFS = {
    "SUDESTE": ["SP", "RJ", "MG", "ES"],
    "SUL": ["PR", "SC", "RS"],
    "CENTRO-OESTE": ["DF", "GO", "MT", "MS"],
    "NORDESTE": ["BA", "PE", "CE", "MA", "PB", "RN", "AL", "SE", "PI"],
    "NORTE": ["AM", "PA", "AC", "RO", "RR", "AP", "TO"],
}
REGION_UNKNOWN = "NÃO INFORMADO"

# --- FIXED VALUES: entity status ------------------------------------------------------
ACCREDITED_CODE = 4002
ACCREDITED = "CREDENCIADA"
IN_ACCREDITATION = "EM CREDENCIAMENTO"

# --- FIXED VALUES: news sources (name, category) --------------------------------------
NEWS_SOURCES = [
    ("ANCD", "Associação e Políticas Setoriais"),
    ("AR FEDERAL", "Operações de AR e Práticas de Mercado"),
    ("CRYPTO ID", "Segurança, Criptografia e Identidade Digital"),
    ("ABRID", "Indústria e Tecnologia de Identificação"),
    ("CONVERGENCIA DIGITAL", "Políticas Públicas e Telecomunicações"),
]

# --- FIXED VALUES: tag terms, in reporting order; default tag -------------------------
TAG_TERMS = [
    "ICP-Brasil", "Certificado Digital", "Assinatura Eletrônica", "AR", "AC", "ITI", "DREX",
    "Identidade Digital", "Biometria", "Cibersegurança", "Criptografia", "LGPD",
]
DEFAULT_TAG = "Setorial"
TITLE_MAX = 300
SUMMARY_MAX = 600

# --- FIXED VALUES: labels of the marts ------------------------------------------------
# by flag
SERIES_OF_FLAG = {"cerHISTORICO_ANUAL_EMISSAO_ATIVOS": "HISTORICO ATIVOS",
                  "cerHISTORICO_ANUAL_EMISSAO_EMITIDOS": "HISTORICO EMITIDOS",
                  "cerEMISSAO_CORRENTE": "MENSAL CORRENTE"}
METRIC_OF_FLAG = {"regEMISSAO_MENSAL": "EMISSAO MENSAL", "regEMISSAO_ANUAL": "EMISSAO ANUAL",
                  "regAR_CORRENTE": "TOTAL AR ESTADO"}
OBJECT_OF_FLAG = {"regAR_CORRENTE": "ENTIDADES"}
CUT_OF_FLAG = {"disTIPO": "TIPO CERTIFICADO", "disCERTIFICADOS_TIPO": "TIPO CERTIFICADO",
               "disUSO": "TIPO USO", "disCERTIFICADOS_ASSINATURA": "TIPO TITULAR"}
VALUE_OF_FLAG = {"infHEADER_COMPARATIVO_AC2_REL_ANTERIOR": "PERCENTUAL",
                 "infHEADER_COMPARATIVO_AR_REL_ANTERIOR": "PERCENTUAL",
                 "infHEADER_TOTAL_REL_ANTERIOR": "PERCENTUAL"}
# by a part of the flag, the first that matches
GRAIN_BY_PART = [("HISTORICO", "ANUAL")]
KPI_BY_PART = [("AC1", "AUTORIDADE CERTIFICADORA 1"), ("AC2", "AUTORIDADE CERTIFICADORA 2"),
               ("ACT", "AUTORIDADE CARIMBO TEMPO"), ("AGENTE_REGISTRO", "AGENTE REGISTRO"),
               ("AUT_REG", "AUTORIDADE REGISTRO"), ("AR", "AUTORIDADE REGISTRO"),
               ("PSB", "SERVICO BIOMETRICO"), ("PSC", "SERVICO CONFIANCA"), ("PSS", "SERVICO SUPORTE"),
               ("ATIVOS", "CERTIFICADOS ATIVOS"), ("EMITIDOS", "CERTIFICADOS EMITIDOS"),
               ("TOTAL_REL", "CERTIFICADOS EMITIDOS"), ("PROJECAO", "PROJECAO ANO ATUAL")]
KIND_BY_PART = [("REL_ANTERIOR", "COMPARATIVO PERCENTUAL"), ("COMPARATIVO", "COMPARATIVO ABSOLUTO"),
                ("PROJECAO", "PROJECAO")]
# holder by a part of the use (with accents) or of the user type (without), the first that matches
HOLDER_BY_PART = [("Físic", "Fisic", "PESSOA FISICA"), ("Jurídic", "Juridic", "PESSOA JURIDICA"),
                  ("Equipamento", "Equipamento", "EQUIPAMENTO/APLICACAO")]
HOLDER_UNKNOWN = "APLICACAO"

# --- FIXED VALUES: documented column domains (re-aimed as checks) ---------------------
ENTITY_TYPES = ["AR", "AC 1º NÍVEL", "AC 2º NÍVEL", "AC RAIZ"]
STATUSES = [ACCREDITED, IN_ACCREDITATION]
REGIONS = list(REGION_UFS)
LEVELS = [0, 1, 2, 3]
SERIES_KINDS = ["HISTORICO ATIVOS", "HISTORICO EMITIDOS", "MENSAL CORRENTE"]
GRANULARITIES = ["MENSAL", "ANUAL"]
GEO_METRICS = ["EMISSAO MENSAL", "EMISSAO ANUAL", "TOTAL AR ESTADO"]
GEO_OBJECTS = ["CERTIFICADOS", "ENTIDADES"]
SEGMENT_CUTS = ["TIPO CERTIFICADO", "TIPO USO", "TIPO TITULAR"]
CERT_TYPES = ["A1", "A3"]
HOLDER_TYPES = ["PESSOA FISICA", "PESSOA JURIDICA", "EQUIPAMENTO/APLICACAO"]
KPI_KINDS = ["ACUMULADO ATUAL", "COMPARATIVO PERCENTUAL", "COMPARATIVO ABSOLUTO", "PROJECAO"]
