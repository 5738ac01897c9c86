"""Search by trigrams: the same rows as a scan, and folders without a candidate unread."""

import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import search_index as S
from strata.operators.search import search

TERMS = ["drex", "DREX pix", "d%x", "d_ex", "a\\%b", "ção", "ÇÃO d", "x", "", None, "é日本", "nothing at all", "%", "re_ pi", "\\_z"]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    words = ["drex", "Drex pix", "DRIX", "certificação DIGITAL", "a%b", "aéb", "é日本語", "🙂é日本", "deex", "q_z", "ok", "re: pi"]
    out = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(4))), draw.choice([None, "", *words]),
            draw.choice(["ANCD", "ITI", None])) for i in range(300)]
    return out + [(None, "drex without id", "x", "ITI"), (7, "drex again", None, "ITI"), (301, None, None, "ITI")]


@pytest.fixture(scope="module")
def indexed(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("search"))
    df = spark.createDataFrame(rows, "id int, title string, summary string, source string")
    S.write_index(df, path, "id", ["title", "summary"], parts=16)
    return path, df


def ordered(df):
    return sorted(map(tuple, df.select("id", "title", "summary", "source").collect()), key=str)


@pytest.mark.parametrize("term", TERMS)
@pytest.mark.parametrize("listed", [10_000, 0])
def test_same_rows_as_a_scan(spark, indexed, term, listed, monkeypatch):
    monkeypatch.setattr(S, "LISTED", listed)
    path, df = indexed
    for source in (None, "iti"):
        got = S.indexed_search(spark, path, term, source, id_col="id", limit=0, parts=16)
        assert ordered(got) == ordered(search(df, term, source, limit=0))


def test_limits_and_order(spark, indexed):
    path, df = indexed
    by = [F.col("id").desc(), F.col("title")]
    got = S.indexed_search(spark, path, "drex", id_col="id", order_by=by, limit=5, parts=16)
    assert [tuple(r) for r in got.select(*df.columns).collect()] == [tuple(r) for r in search(df, "drex", order_by=by, limit=5).collect()]


def test_grams_of_terms(spark):
    assert S.term_grams(spark, "Drex") == ["dre", "rex"]
    assert S.term_grams(spark, "a\\%b%cde_fg") == ["a%b", "cde"]
    assert S.term_grams(spark, "ab_cd%") == []


def test_other_folders_are_not_read(spark, tmp_path):
    rows = [(i, f"text number {i:04d} of many") for i in range(500)] + [(1000, "the needle in there")]
    S.write_index(spark.createDataFrame(rows, "id int, t string"), str(tmp_path), "id", ["t"])
    part = spark.range(1).select(S._part(F.lit(1000), S.PARTS)).first()[0]
    slots = spark.createDataFrame([(g,) for g in S.term_grams(spark, "needle")], "g string").select(S._slot(F.col("g"), S.SLOTS))
    needed = {f"_part={part}", *(f"slot={r[0]}" for r in slots.collect())}
    spoilt = 0
    for folder, _, files in os.walk(tmp_path):
        if "=" in os.path.basename(folder) and os.path.basename(folder) not in needed:
            for f in files:  # whoever reads these fails
                if f.endswith(".parquet"):
                    spoilt += 1
                    with open(os.path.join(folder, f), "r+b") as file:
                        file.seek(4)  # the first page; the schema is read from the end of any file
                        file.write(b"\xff" * 16)
                    os.remove(os.path.join(folder, f".{f}.crc"))
    assert spoilt > 50
    found = S.indexed_texts(spark, str(tmp_path), "NEEDLE", "id")
    assert [r["id"] for r in found.collect()] == [1000]
    with pytest.raises(Exception):  # noqa: B017
        S.indexed_texts(spark, str(tmp_path), "xt", "id").collect()


@pytest.mark.parametrize("chars", [4_000_000, 50])
def test_postings_of_blocks(spark, rows, indexed, tmp_path, monkeypatch, chars):
    import pyarrow as pa
    monkeypatch.setattr(S, "BLOCK_CHARS", chars)
    want = {(r[0], g) for r in indexed[1].where("id is not null").select("id", *[
        F.explode(F.array_distinct(F.flatten(F.array(S.grams(F.col("title")), S.grams(F.col("summary")))))).alias("g")]).collect()
        for g in [r["g"]]}
    some = [r for r in rows if r[0] is not None]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in some]), pa.array(
        [[t and t.lower() for t in r[1:3]] for r in some], pa.list_(pa.string()))], ["id", "texts"])
    made = [(g, i) for b in S._postings(iter([batch])) for g, ids in zip(b["gram"].to_pylist(), b["ids"].to_pylist()) for i in ids]
    assert {(i, g) for g, i in made} == want
    assert sum(b.num_rows for b in S._postings(iter([batch]))) < len(made)


def test_postings_take_a_row_a_gram_and_block(spark, tmp_path):
    df = spark.range(400).select("id", F.lit("the same words in all texts").alias("t")).coalesce(1)
    S.write_index(df, str(tmp_path), "id", ["t"])
    postings = spark.read.parquet(f"{tmp_path}/postings")
    assert postings.count() < 400 * 5
    assert postings.select(F.explode("ids")).count() == 400 * len(S.term_grams(spark, "the same words in all texts"))


def test_no_texts(spark, tmp_path):
    df = spark.createDataFrame([], "id int, t string, source string")
    S.write_index(df, str(tmp_path), "id", ["t"])
    assert S.indexed_search(spark, str(tmp_path), "drex", id_col="id", text_cols=["t"], limit=0).collect() == []
