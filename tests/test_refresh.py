"""End to end: landed JSON/RSS -> bronze -> silver -> gold, two batches, questions."""

import datetime as dt
import os

import pytest

from strata.plans import questions as Q
from strata.plans import refresh as RF

import fixtures as FX

AS_OF = dt.date(2025, 12, 31)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    FX.write_landing(os.path.join(root, "in1"))
    out = os.path.join(root, "out")
    first = RF.refresh(spark, os.path.join(root, "in1"), out, AS_OF)
    return {"root": root, "out": out, "first": first,
            "gold": RF.gold_tables(spark, out)}


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_first_batch_inserts_everything(run):
    assert set(run["first"]["merge"]) == {"insert"}
    assert run["first"]["merge"]["insert"] == 46


def test_lenient_rejects_are_counted(run):
    rej = run["first"]["rejects"]
    assert rej["entidades"]["dt_credenciamento"] == 1   # "2020-13-45"
    assert rej["entidades"]["processo"] == 1            # "x" has no digits
    assert rej["entidades"]["id"] == 0
    assert rej["numeros"]["valor"] == 3  # "x" and the two boolean metadata values


def test_domains_are_checked_while_gold_is_written(run):
    out = run["first"]["outside"]
    # the fixtures carry an 'OUTROS' certificate type on purpose
    assert out["fato_segmentacao_certificados"]["tipo_certificado"] == 1
    assert out["fato_segmentacao_certificados"]["titular"] == 1
    assert out["dim_entidade"]["uf_formato"] == 0 and out["dim_entidade"]["tipo"] == 0
    assert out["fato_emissao_mensal"]["serie"] == 0 and out["dim_hierarquia"]["nivel"] == 0


def test_entity_master(run):
    d = run["gold"]["dim_entidade"]
    assert d.count() == 10  # null id dropped, duplicate id 4 kept once
    got = {r["ID_ENTIDADE"]: r for r in d.collect()}
    assert got[1]["DS_ENTIDADE"] == "AC Raiz Nacional"
    assert got[1]["NR_CNPJ"] == "00394460005887"
    assert got[3]["NR_CNPJ"] == "01234567890123"
    assert got[4]["NR_CNPJ"] == "00000000000000" and got[4]["DS_ENTIDADE"] == "AR Um"
    assert got[5]["DS_SITUACAO"] == "EM CREDENCIAMENTO"
    assert got[6]["DS_SITUACAO"] == "EM CREDENCIAMENTO" and got[6]["DS_REGIAO"] == "NÃO INFORMADO"
    assert got[2]["SG_UF"] == "SP" and got[2]["DS_REGIAO"] == "SUDESTE"
    assert got[7]["DT_CREDENCIAMENTO"] is None
    assert got[2]["DS_ENDERECO"] == "12 Rua Das Flores, Centro, São Paulo, SP, 01310-100"
    assert got[3]["DS_ENDERECO"].endswith("RJ, 2004003")
    assert got[5]["DS_ENDERECO"].startswith("Sala 1 Rua")
    assert got[10]["DS_ENDERECO"] == "" and got[10]["SG_UF"] is None


def test_descendant_counts(run):
    m = run["gold"]["fato_metricas_entidades"]
    got = {r["ID_ENTIDADE"]: (r["NR_AGREGADOS_AC_NIVEL_1"], r["NR_AGREGADOS_AC_NIVEL_2"],
                              r["NR_AGREGADOS_AR"]) for r in m.collect()}
    assert got == {1: (1, 1, 3), 2: (0, 1, 3), 3: (0, 0, 3), 8: (1, 1, 0), 9: (1, 1, 0),
                   99: (0, 0, 1)}
    orphan = m.filter("ID_ENTIDADE = 99").first()
    assert orphan["DS_ENTIDADE"] is None and orphan["SG_UF"] is None


def test_marts_partition_the_indicators(spark, run):
    g = run["gold"]
    num = RF.silver_numbers(spark, run["out"])
    parts = sum(g[n].count() for n in RF.MARTS)
    # every merged row lands in exactly one mart (accreditation + KPI = INF branch)
    assert parts == num.count() == 46
    assert g["fato_emissao_mensal"].count() == 22
    assert g["kpi_resumo_executivo"].count() == 9


def test_series_rules(run):
    e = run["gold"]["fato_emissao_mensal"]
    hist = rows(e.filter("DS_TIPO_SERIE = 'HISTORICO ATIVOS'"), "VL_METRICA", "DT_ANO")
    assert hist[:6] == [(100.0, 2020), (200.0, 2021), (300.0, 2022), (400.0, 2023),
                        (500.0, 2024), (600.0, 2025)]
    assert hist[6] == (700.0, None)  # index 6 is outside the 0..5 window
    months = e.filter("DS_TIPO_SERIE = 'MENSAL CORRENTE' AND DT_ANO = 2025")
    assert months.count() == 13 and months.filter("DT_MES_ANO IS NULL").count() == 1


def test_segment_and_geo_rules(run):
    s = run["gold"]["fato_segmentacao_certificados"]
    assert rows(s.filter("DS_CATEGORIA_CORTE = 'TIPO CERTIFICADO'"), "DS_TIPO_CERTIFICADO") == \
        [("A1",), ("A3",), ("OUTROS",)]
    assert rows(s.filter("DS_CATEGORIA_CORTE <> 'TIPO CERTIFICADO'"), "DS_TIPO_USUARIO") == \
        [("EQUIPAMENTO/APLICACAO",), ("OUTRO USO",), ("PESSOA FISICA",), ("PESSOA JURIDICA",)]
    geo = run["gold"]["fato_distribuicao_geografica"]
    assert rows(geo, "SG_UF", "DS_REGIAO", "DS_METRICA") == [
        ("MG", "SUDESTE", "TOTAL AR ESTADO"), ("RJ", "SUDESTE", "EMISSAO MENSAL"),
        ("SP", "SUDESTE", "EMISSAO ANUAL"), ("XX", "NORTE", "EMISSAO ANUAL")]


def test_kpi_recode_order(run):
    k = run["gold"]["kpi_resumo_executivo"]
    got = {r["VL_METRICA"]: (r["DS_INDICADOR"], r["DS_TIPO_INDICADOR"], r["DS_TIPO_VALOR"])
           for r in k.collect() if r["VL_METRICA"] is not None}
    assert got[10.0] == ("AUTORIDADE REGISTRO", "COMPARATIVO ABSOLUTO", "INTEIRO")
    assert got[1.5] == ("CERTIFICADOS EMITIDOS", "COMPARATIVO PERCENTUAL", "PERCENTUAL")
    assert got[3.0] == ("AUTORIDADE CERTIFICADORA 1", "ACUMULADO ATUAL", "INTEIRO")
    assert got[1200.0] == ("PROJECAO ANO ATUAL", "PROJECAO", "INTEIRO")


def test_news(run):
    n = run["gold"]["dim_inteligencia_mercado"]
    got = {r["DS_URL_ORIGEM"]: r for r in n.collect()}
    assert len(got) == 5  # missing link, empty title dropped; duplicate link kept once
    a = got["https://ancd.org.br/a"]
    assert a["DS_TAGS"] == "ICP-Brasil, DREX"
    assert a["DT_PUBLICACAO"] == dt.datetime(2025, 12, 1, 10, 30)
    assert got["https://ancd.org.br/b"]["DS_RESUMO"] == "Texto com espaço e é entidade numérica, ok."
    assert got["https://ancd.org.br/c"]["DT_PUBLICACAO"] is None
    x = got["https://cryptoid.com.br/x"]
    assert len(x["DS_TITULO"]) == 300 and len(x["DS_RESUMO"]) == 600
    assert got["https://cryptoid.com.br/y"]["DS_TAGS"] == \
        "Biometria, Cibersegurança, Criptografia, LGPD"


def test_questions_run(run):
    g = run["gold"]
    assert [r["ID_ENTIDADE"] for r in Q.q1_top_authorities(g).collect()] == [2, 3, 8, 9]
    assert Q.q5_latest_month_total(g).first()[0] == 21.0
    assert Q.q6_active_ars_in_uf(g, "MG").first()[0] == 1
    share = {r[0]: r[2] for r in Q.q8_a1_a3_share(g).collect()}
    assert share == {"A1": 0.7, "A3": 0.3}
    assert Q.q12_lookup_tax_id(g, "00.394.460/0058-87").first()["ID_ENTIDADE"] == 1
    assert [r["DS_URL_ORIGEM"] for r in Q.q22_news_search(g, "drex").collect()] == \
        ["https://ancd.org.br/a"]
    assert Q.q22_news_search(g, None, "crypto").count() == 2
    for name, fn in Q.ALL.items():
        if name in ("q12_lookup_tax_id", "q22_news_search", "q23_title_or_tag_in_source",
                    "q24_series_of_year", "q26_kpi_pick"):
            continue
        fn(g).collect()
    Q.q23_title_or_tag_in_source(g, "icp", "ANCD").collect()
    assert Q.q24_series_of_year(g, "HISTORICO ATIVOS", 2023).count() == 1
    assert Q.q26_kpi_pick(g, "CERTIFICADOS ATIVOS").count() == 1


def test_search_function_sql(spark, run):
    from strata.plans.news import register_news_search
    run["gold"]["dim_inteligencia_mercado"].createOrReplaceTempView("noticias_gold")
    register_news_search(spark, "noticias_gold", "fn_busca")
    assert spark.sql("SELECT * FROM fn_busca('drex')").count() == 1
    assert spark.sql("SELECT * FROM fn_busca(NULL, 'ancd')").count() == 3


def test_indexed_news_search(spark, run):
    from strata.plans import news as N
    path = os.path.join(run["out"], "gold", RF.NEWS_INDEX)
    for term, source in (("drex", None), (None, "ancd"), ("dr_x", "CRYPTO"), ("no such words", None)):
        got = N.search_news_indexed(spark, path, term, source)
        want = N.search_news(run["gold"]["dim_inteligencia_mercado"], term, source)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_second_batch_updates_and_is_idempotent(spark, run):
    panel = [dict(i) for i in FX.PANEL]
    panel[9] = {"cerVisGerAtivos": 1100}          # changed value -> update
    panel[13] = {"estAcumuladoAc1": None}         # null never clears -> keep
    panel.append({"estAcumuladoPSB": 4})          # new key -> insert
    land = FX.write_landing(os.path.join(run["root"], "in2"), panel=panel, with_feeds=False)
    res = RF.refresh(spark, land, run["out"], AS_OF)
    assert res["merge"]["update"] >= 1 and res["merge"]["insert"] == 1
    num = RF.silver_numbers(spark, run["out"])
    assert num.count() == 47
    assert num.filter("DS_FLAG = 'infHEADER_ATIVOS'").first()["VL_METRICA"] == 1100.0
    assert num.filter("DS_FLAG = 'infHEADER_ACUMULADO_AC1'").first()["VL_METRICA"] == 3.0
    again = RF.refresh(spark, land, run["out"], AS_OF)
    # unchanged input: only null-valued keys are touched, no value changes
    assert again["merge"].get("insert", 0) == 0
    num2 = RF.silver_numbers(spark, run["out"])
    assert rows(num2, "CD_CHAVE_INDICADOR", "VL_METRICA") == rows(num, "CD_CHAVE_INDICADOR", "VL_METRICA")


def test_duplicate_keys_are_reported(spark, tmp_path):
    panel = [{"cerVisGerAtivos": 1}, {"cerVisGerAtivos": 2}]
    land = FX.write_landing(str(tmp_path / "in"), panel=panel, with_feeds=False)
    with pytest.raises(ValueError, match="duplicate merge keys"):
        RF.refresh(spark, land, str(tmp_path / "out"), AS_OF)
    res = RF.refresh(spark, land, str(tmp_path / "out2"), AS_OF, duplicates="last")
    assert res["merge"] == {"insert": 1}


def test_gold_domain_checks(spark, run):
    from strata.plans.quality import gold_domain_report
    gold = RF.gold_tables(spark, run["out"])  # earlier tests rewrote the gold files
    rep = {(r["table_name"], r["rule"]): r["n_violations"]
           for r in gold_domain_report(gold).collect()}
    # the fixtures carry an unknown UF ("XX") and an 'OUTROS' certificate type on purpose
    assert rep[("dim_entidade", "uf_formato")] == 0
    assert rep[("dim_entidade", "tipo")] == 0
    assert rep[("fato_segmentacao_certificados", "tipo_certificado")] == 1
    assert rep[("fato_segmentacao_certificados", "titular")] == 1
    assert rep[("fato_emissao_mensal", "serie")] == 0
    assert rep[("dim_hierarquia", "nivel")] == 0


def test_bronze_lineage(spark, run):
    b = spark.read.parquet(os.path.join(run["out"], "bronze", "entidades"))
    assert {r[0] for r in b.select("nome_arquivo").distinct().collect()} == {"entidades.json"}
    n = spark.read.parquet(os.path.join(run["out"], "bronze", "numeros"))
    assert "data_insercao" in n.columns


def test_a_run_without_feeds_leaves_the_news_alone(spark, tmp_path):
    import shutil
    first, second, out = (str(tmp_path / n) for n in ("in1", "in2", "out"))
    FX.write_landing(first)
    RF.refresh(spark, first, out, AS_OF)
    before = sorted(map(str, RF.gold_tables(spark, out)["dim_inteligencia_mercado"].collect()))
    shutil.copytree(first, second, ignore=lambda d, names: [n for n in names if n == "feeds"])
    RF.refresh(spark, second, out, AS_OF)
    assert sorted(map(str, RF.gold_tables(spark, out)["dim_inteligencia_mercado"].collect())) == before


def test_feeds_of_unknown_sources_raise(spark, tmp_path):
    FX.write_landing(str(tmp_path / "in"))
    (tmp_path / "in" / "feeds" / "SOMEONE.xml").write_text("<rss/>")
    with pytest.raises(ValueError, match="SOMEONE"):
        RF.raw_to_bronze(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_repeated_link_keeps_the_newest_item(spark):
    from strata.plans import news
    rows = [("ANCD", "c", "Alfa old", "http://x/1", "Mon, 05 May 2025 10:00:00 GMT", "d"),
            ("ANCD", "c", "Zebra new", "http://x/1", "Tue, 06 May 2025 10:00:00 GMT", "a")]
    df = spark.createDataFrame(rows, "source string, category string, title string, link string, pub_date string, "
                                     "description string")
    assert [r["DS_TITULO"] for r in news.ingest(df).collect()] == ["Zebra new"]


def test_panel_as_json_lines(spark, tmp_path):
    import json
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    FX.write_landing(src)
    RF.raw_to_bronze(spark, src, out)
    name = next(n for n in os.listdir(src) if n.startswith("numeros"))
    want = rows_key(spark, out)
    items = json.load(open(os.path.join(src, name), encoding="utf-8"))
    os.rename(os.path.join(src, name), os.path.join(src, "old.txt"))
    with open(os.path.join(src, "numeros.jsonl"), "w", encoding="utf-8") as f:
        f.writelines(json.dumps(i, ensure_ascii=False) + "\n" for i in items)
    RF.raw_to_bronze(spark, src, out)
    assert rows_key(spark, out) == want


def rows_key(spark, out):
    got = spark.read.parquet(f"{out}/bronze/numeros").select("indicador", "indice", "valor").collect()
    return sorted(str(tuple(r)) for r in got)
