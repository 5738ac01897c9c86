"""Every operator of documents: nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

import pytest

from strata.llm import (attention_lm, cws, embed_graph, gam, langid, packing, pieces, secrets, simhash,
                        toxicity)


def _labels(spark, rows=((4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None), (4, 0, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "simhash": lambda s, d: simhash.simhash(d),
    "secrets": lambda s, d: secrets.secrets(d),
    "pieces": lambda s, d: pieces.encode(d),
    "toxicity": lambda s, d: toxicity.toxicity(d, _labels(s)),
    "lm": lambda s, d: attention_lm.scores(d),
    "cws": lambda s, d: cws.fingerprints(d),
    "langid": lambda s, d: langid.languages(d),
    "gam": lambda s, d: gam.quality(d, _labels(s)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, name):
    got = OPERATORS[name](spark, odd).collect()
    assert len(got) == odd.count()
    want = sorted(str(r["doc_id"]) for r in odd.select("doc_id").collect())
    assert sorted(str(r["doc_id"]) for r in got) == want
    text = {}
    for r in got:  # repeated rows get equal results but for where they stand
        text.setdefault(r["doc_id"], []).append(r)
    if name not in ("cws",):
        assert len({str(r) for r in text[4]}) <= 2


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, odd, name):
    full = OPERATORS[name](spark, odd)
    none = OPERATORS[name](spark, odd.limit(0))
    assert none.columns == full.columns
    assert none.collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_only_null_texts(spark, odd, name):
    rows = odd.where("text is null")
    assert OPERATORS[name](spark, rows).count() == rows.count()


def test_packing_of_odd_rows(spark, odd):
    got = packing.pack(odd).collect()
    for r in odd.where("text is null and doc_id is not null").collect():
        assert [(p["start"], p["length"], p["doc_tokens"]) for p in got if p["doc_id"] == r["doc_id"]] == [(0, 1, 1)]
    assert packing.pack(odd.limit(0)).collect() == []


def test_filters_keep_columns(spark, odd):
    assert simhash.deduplicated(odd).columns == odd.columns
    assert secrets.redact(odd).columns == odd.columns
    assert simhash.deduplicated(odd.limit(0)).collect() == []
    assert secrets.redact(odd.limit(0)).collect() == []
    assert secrets.redact(odd).count() == odd.count()


CLASHING = ["_row", "row", "doc", "_p", "p", "_spans", "spans", "hits", "masked", "fp", "root", "place", "found", "owner", "value"]


def _clashing(spark):
    secret = 'password = "hunter2hunter2" '
    rows = [(i, f"{secret if i % 3 == 0 else ''}text of number {i} with words {i * 7} and more {i * 11}", "xx", f"s{i}", 1)
            + tuple(f"{c}{i}" for c in CLASHING) for i in range(12)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{c}` string" for c in CLASHING))


def test_clashing_columns_keep_their_values(spark):
    df = _clashing(spark)
    want = {r["doc_id"]: [r[c] for c in CLASHING] for r in df.collect()}
    for out in (simhash.deduplicated(df), secrets.redact(df)):
        assert out.columns == df.columns
        assert {r["doc_id"]: [r[c] for c in CLASHING] for r in out.collect()} == want


def test_stages_keep_columns_and_take_odd_tables(spark, corpus, odd, tmp_path):
    import corpus_pipeline
    _labels(spark, [(i, 1, int(i % 7 == 0)) for i in range(12)]).write.parquet(f"{tmp_path}/labels.parquet")
    df = _clashing(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns, name
        want = {r["doc_id"]: [r[c] for c in CLASHING] for r in df.collect()}
        assert all([r[c] for c in CLASHING] == want[r["doc_id"]] for r in out.collect()), name
        for table in (odd, df.limit(0), odd.where("text is null")):
            got = stage(spark, table, str(tmp_path))
            assert got.columns == table.columns and got.count() <= table.count(), name
    for table in (odd, df.limit(0)):
        corpus_pipeline.pack(spark, table, str(tmp_path)).count()


def test_redaction_of_many_and_touching_spans(spark):
    secret = "token=abcdef123456"
    text = " ".join(f"é{secret}{i:04d}" for i in range(3000))
    df = spark.createDataFrame([(1, text, "s"), (2, None, "s"), (3, "none here", "s"), (4, f"{secret},{secret}", "t")],
                               "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert "abcdef" not in got[1] and got[1].count("<secret>") == 3000
    assert got[2] is None and got[3] == "none here" and got[4].count("<secret>") == 2


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [2.0, 0.01]), (10, [1.0, 0.0, 0.0]),
            (None, [1.0, 0.001]), (2, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, node string")
    got = embed_graph.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: r for r in got}
    for alone in (3, 4, 5, 6, 7, 8, 10):
        assert (by[alone]["n_links"], by[alone]["component_id"], by[alone]["kept"]) == (0, alone, True)
    for near in (1, 2, 9, None):
        assert (by[near]["n_links"], by[near]["component_id"]) == (4, 1)
    assert embed_graph.near_duplicates(df.limit(0)).collect() == []
