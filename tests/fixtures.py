"""Hand-written landed inputs of the registry domain (see FIXTURES.md).

Entities: a four-level tree with one, two and three parents, an orphan parent,
a two-node cycle, duplicate and null ids, odd addresses and identifiers.
Panel: every branch, index edge cases, numeric coercion cases, metadata keys,
an unknown key, a second key per item and an object element with its own index.
Feeds: entities, long text, bad and zoned dates, missing link, empty title,
duplicate link, tag case, a tag inside a word, and one malformed feed file.
"""

from __future__ import annotations

import json
import os


def addr(numero, cep, uf, logradouro="rua das flores", bairro="centro", cidade="são paulo",
         complemento="sala 1"):
    return {"numero": numero, "complemento": complemento, "logradouro": logradouro,
            "bairro": bairro, "cidade": cidade, "uf": uf, "cep": cep}


ENTITIES = [
    {"id": 1, "nome": "AC  Raiz\tNacional ", "cnpj": "00.394.460/0058-87", "entidade": "AC Raiz",
     "nivel": 0, "situacao": 4002, "dt_credenciamento": "2001-06-28", "processo": "00100.000001/2001-01",
     "telefone": "61 0000-0000", "enderecos": [addr("Nº 100", "70000000", "DF")], "ids_pai": []},
    {"id": 2, "nome": "AC Primeira", "cnpj": "12345678000190", "entidade": "AC 1º Nível", "nivel": 1,
     "situacao": 4002, "dt_credenciamento": "2005-01-10", "processo": "200",
     "telefone": "11", "enderecos": [addr("Nº 12", "01310100", "sp")], "ids_pai": [{"id": 1}]},
    {"id": 3, "nome": "AC Segunda", "cnpj": "1234567890123", "entidade": "AC 2º NÍVEL", "nivel": 2,
     "situacao": 4002, "dt_credenciamento": "2010-02-03", "processo": "x",
     "telefone": "21", "enderecos": [addr("N. 7", "2004003", "RJ")], "ids_pai": [{"id": 2}]},
    {"id": 4, "nome": "AR Um", "cnpj": "", "entidade": "AR", "nivel": 3, "situacao": 4002,
     "dt_credenciamento": "2015-05-05", "processo": "4",
     "telefone": "31", "enderecos": [addr("S/N", "301400001", "MG")], "ids_pai": [{"id": 3}]},
    {"id": 4, "nome": "AR Um (copia)", "cnpj": "", "entidade": "AR", "nivel": 3, "situacao": 4002,
     "dt_credenciamento": "2015-05-05", "processo": "4",
     "telefone": "31", "enderecos": [addr("S/N", "301400001", "MG")], "ids_pai": [{"id": 3}]},
    {"id": 5, "nome": "AR Dois", "cnpj": "98.765.432/0001-10", "entidade": "AR", "nivel": 3,
     "situacao": 4001, "dt_credenciamento": "2016-06-06", "processo": "5",
     "telefone": "41", "enderecos": [addr("", "80000000", "PR")], "ids_pai": [{"id": 3}, {"id": 2}]},
    {"id": 6, "nome": "AR Tres", "cnpj": "1", "entidade": "AR", "nivel": 3, "situacao": None,
     "dt_credenciamento": "2017-07-07", "processo": "6", "telefone": "51",
     "enderecos": [addr("N° 9", "90000000", "XX")], "ids_pai": [{"id": 3}, {"id": 2}, {"id": 1}]},
    {"id": 7, "nome": "AR Orfa", "cnpj": "7", "entidade": "AR", "nivel": 3, "situacao": 4002,
     "dt_credenciamento": "2020-13-45", "processo": "7", "telefone": "61",
     "enderecos": [addr("70", "71000000", "GO")], "ids_pai": [{"id": 99}]},
    {"id": None, "nome": "sem id", "entidade": "AR", "nivel": 3, "situacao": 4002},
    {"id": 8, "nome": "Ciclo A", "cnpj": "8", "entidade": "AC 1º NÍVEL", "nivel": 1, "situacao": 4002,
     "dt_credenciamento": "2019-01-01", "processo": "8", "telefone": "0",
     "enderecos": [addr("1", "69000000", "AM")], "ids_pai": [{"id": 9}]},
    {"id": 9, "nome": "Ciclo B", "cnpj": "9", "entidade": "AC 2º NÍVEL", "nivel": 2, "situacao": 4002,
     "dt_credenciamento": "2019-01-01", "processo": "9", "telefone": "0",
     "enderecos": [addr("2", "69000001", "AM")], "ids_pai": [{"id": 8}]},
    {"id": 10, "nome": "Sem Endereco", "cnpj": "10", "entidade": "AR", "nivel": 3, "situacao": 4002,
     "dt_credenciamento": "2021-01-01", "processo": "10", "telefone": "0", "enderecos": [],
     "ids_pai": []},
]

PANEL = [
    {"cerVisGerHisAtivos": [100, 200, 300, 400, 500, 600, 700]},
    {"cerVisGerCompMenAnoAtual": [10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22]},
    {"cerVisGerCompMenAnoPassado": [5, 6]},
    {"certDistMapa": [{"id": "SP", "count": 5, "reg": "SUDESTE"},
                      {"id": "XX", "value": 3, "reg": "NORTE"}]},
    {"certDistCerMen": [{"id": "RJ", "anomes": "2025-03", "count": 7}]},
    {"estMap": [{"id": "MG", "count": 12}]},
    {"certDistCerTipo": [{"tipo": "A1", "qtdcertificado": 70}, {"tipo": "A3", "qtdcertificado": 30},
                         {"tipo": "BIO", "qtdcertificado": 1}]},
    {"certDistCerUso": [{"uso": "Pessoa Física", "count": 50}, {"uso": "Pessoa Jurídica", "count": 40},
                        {"uso": "Outro uso", "count": 1}]},
    {"cerVisGerDisAssinatura": [{"tipo_usuario": "Equipamento", "value": 5}]},
    {"cerVisGerAtivos": 1000},
    {"cerVisGerEmitidos": "2.0"},
    {"cerVisGerToEmRelAAnterior": 1.5},
    {"cerVisGerProAAtual": 1200},
    {"estAcumuladoAc1": 3},
    {"estAcumuladoAutReg": 400},
    {"estCompAR": 10},
    {"estCompARRelAnoAnterior": "x"},
    {"estCompMenAnoAtual": [1, 2, 3]},
    {"estCompMenAnoAnterior": [{"indice": 4, "valor": 2}]},
    {"estAgtRegistro": 9, "segunda": 1},
    {"manutencao": False},
    {"versao": "1.2"},
    {"finalizado": True},
    {"chaveDesconhecida": 5},
]


def rss(items: list[dict]) -> str:
    body = []
    for it in items:
        parts = []
        for tag in ("title", "link", "pubDate", "description"):
            if tag in it:
                parts.append(f"<{tag}>{it[tag]}</{tag}>")
        body.append("<item>" + "".join(parts) + "</item>")
    return ('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel>'
            "<title>feed</title>" + "".join(body) + "</channel></rss>")


ANCD_ITEMS = [
    {"title": "ICP-Brasil e DREX em debate", "link": "https://ancd.org.br/a",
     "pubDate": "Mon, 01 Dec 2025 10:30:00 -0300",
     "description": "&lt;p&gt;Olá &lt;b&gt;Mundo&lt;/b&gt;! &amp;amp; Bem-vindo.&lt;/p&gt;"},
    {"title": "Certificado digital cresce", "link": " https://ancd.org.br/b ",
     "pubDate": "Tue, 02 Dec 2025 08:00:00 GMT",
     "description": "Texto&amp;nbsp;com espaço e &amp;#233; entidade numérica , ok ."},
    {"title": "Sem link"},
    {"title": "", "link": "https://ancd.org.br/vazio", "pubDate": "Wed, 03 Dec 2025 09:00:00 GMT"},
    {"title": "Data ruim", "link": "https://ancd.org.br/c", "pubDate": "ontem à tarde"},
    {"title": "ICP-Brasil e DREX em debate (repetido)", "link": "https://ancd.org.br/a",
     "pubDate": "Mon, 01 Dec 2025 10:30:00 -0300", "description": "mesma notícia"},
]
CRYPTO_ITEMS = [
    {"title": "T" * 350, "link": "https://cryptoid.com.br/x",
     "pubDate": "Thu, 04 Dec 2025 23:59:59 +0000", "description": "D" * 700},
    {"title": "Nova CRIPTOGRAFIA pós-quântica; cibersegurança e lgpd",
     "link": "https://cryptoid.com.br/y", "pubDate": "Fri, 05 Dec 2025 12:00:00 -0300",
     "description": "A ARENA de biometria (tag dentro de palavra: ARENA)."},
]


def write_landing(root: str, panel: list | None = None, entities: list | None = None,
                  with_feeds: bool = True) -> str:
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, "entidades.json"), "w", encoding="utf-8") as f:
        json.dump({"entidades": entities if entities is not None else ENTITIES}, f,
                  ensure_ascii=False)
    with open(os.path.join(root, "numeros.json"), "w", encoding="utf-8") as f:
        json.dump(panel if panel is not None else PANEL, f, ensure_ascii=False)
    if with_feeds:
        fd = os.path.join(root, "feeds")
        os.makedirs(fd, exist_ok=True)
        with open(os.path.join(fd, "ANCD.xml"), "w", encoding="utf-8") as f:
            f.write(rss(ANCD_ITEMS))
        with open(os.path.join(fd, "CRYPTO ID.xml"), "w", encoding="utf-8") as f:
            f.write(rss(CRYPTO_ITEMS))
        with open(os.path.join(fd, "ABRID.xml"), "w", encoding="utf-8") as f:
            f.write("<rss><channel><item><title>quebrado")
    return root
