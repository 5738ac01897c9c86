"""Golden and rule tests for the column functions."""

import datetime as dt
import decimal
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.functions import text as X
from strata.functions.keys import surrogate_key
from strata.plans import refdata as R


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def col_values(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r["r"] for r in df.select(fn(F.col("v")).alias("r")).collect()]


def test_sources_are_five(spark):
    assert [n for n, _ in R.NEWS_SOURCES] == ["ANCD", "AR FEDERAL", "CRYPTO ID", "ABRID",
                                               "CONVERGENCIA DIGITAL"]


def test_clean_html_golden(spark):
    html = "<div>Três <i>notas</i>\n  , &lt;breves&gt; &amp; <br/>claras ;</div>"
    assert one(spark, X.clean_html(F.col("v"), 600), html) == "Três notas, <breves> & claras;"


def test_clean_html_edges(spark):
    vals = [None, "", "a&nbsp;b", "x &#233; y", "t  ,  u", "abcdef"]
    out = col_values(spark, lambda c: X.clean_html(c, 4), vals)
    assert out == ["", "", "a b", "x é ", "t, u", "abcd"]  # strip happens before the cut


def test_extract_tags_golden(spark):
    text = "A lgpd muda a biometria; o iti publica norma sobre identidade digital."
    tags = one(spark, X.extract_tags(F.col("v"), R.TAG_TERMS, R.DEFAULT_TAG), text)
    assert tags == "ITI, Identidade Digital, Biometria, LGPD"


@pytest.mark.parametrize("text", [
    "nada aqui", "", None, "A ARENA e a ar", "cibersegurança e CIBERSEGURANÇA",
    "LGPD; lgpd. ITI-x", "AC/AR", "ação da AC"])
def test_extract_tags_matches_python(spark, text):
    got = one(spark, X.extract_tags(F.col("v"), R.TAG_TERMS, R.DEFAULT_TAG), text)
    want = [t for t in R.TAG_TERMS if re.search(rf"\b{re.escape(t)}\b", text or "", re.IGNORECASE)]
    assert got == (", ".join(want) or R.DEFAULT_TAG)


OVERLAPPING = ["AC", "AC Raiz", "Raiz", "AC Raiz Brasileira", "ac", "Brasileira v5", "C++", "C", ".NET", "NET", "a|b", "x\\y", "É",
               "straße", "K9", "K", "R$ 5", "AC-R", "Raiz Brasil", "\\E", "(", "ſ", "ITI"]


def test_overlapping_terms_against_one_pattern_a_term(spark):
    draw = random.Random(5)
    pieces = [*OVERLAPPING, "ac raiz", "STRASSE", "STRAẞE", "é", "É", "k9", "S", "brasileira", " İTI ", "RAİZ", " ", " ", "-", ".", "\n", "xAC", "AC_"]
    texts = ["".join(draw.choice(pieces) + draw.choice(["", " "]) for _ in range(draw.randrange(9))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "v string")
    slow = F.array_join(F.array(*[F.when(F.col("v").rlike(X.keyword_pattern(t)), F.lit(t)) for t in OVERLAPPING]), ", ")
    got = df.select("v", X.extract_tags(F.col("v"), OVERLAPPING, "NONE").alias("got"), slow.alias("want")).collect()
    for text, tags, want in got:
        assert tags == (want or "NONE"), text
    assert sum(bool(r["want"]) for r in got) > 250


def test_many_terms_are_one_search(spark):
    terms = [f"term{i} of {i % 7}" for i in range(200)]
    col = X.extract_tags(F.col("v"), terms, "NONE")
    plan = spark.createDataFrame([("TERM7 of 0, term12 of 5; term8 of 2",)], "v string").select(col.alias("t"))
    assert plan.first()["t"] == "term7 of 0, term12 of 5"
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") <= 1


def test_rfc822(spark):
    vals = ["Wed, 07 May 2025 06:45:10 -0300", "9 May 2025 18:20 GMT", "bad", None,
            "Wed, 07 May 25 06:45:10 GMT", "Wednesday, 07-May-97 06:45:10 GMT", "7 MAY 2025 06:45 Z"]
    out = col_values(spark, X.rfc822_wallclock, vals)
    assert out[0] == dt.datetime(2025, 5, 7, 6, 45, 10)
    assert out[1] == dt.datetime(2025, 5, 9, 18, 20)
    assert out[2] is None and out[3] is None
    assert out[4] == out[0] and out[5] == dt.datetime(1997, 5, 7, 6, 45, 10)
    assert out[6] == dt.datetime(2025, 5, 7, 6, 45)


def test_whole_numbers_keep_every_digit(spark):
    vals = ["2", "2.0", "9007199254740993", "9210000000000000000", "-9223372036854775808", "9223372036854775808",
            "1.5", "x", "", None, "1e3"]
    assert col_values(spark, C.whole_number, vals) == [
        2, 2, 9007199254740993, 9210000000000000000, -9223372036854775808, None, None, None, None, None, 1000]


def test_whole_numbers_are_never_rounded(spark):
    draw = random.Random(9)
    vals = ["1.00000000001", "0.99999999999", "0.5", ".0", "5.", "00", "-0.0", "1e-400000", "0e999999", "12e-1", "120e-1", "1.5E1",
            "+7", " 8 ", "9\n", "1 2", "1e", "e5", ".", "-", "NaN", "Infinity", "1d", "٣", "99999999999999999999.0", "1e19", "1e18"]
    vals += ["".join(draw.choice(["0", "1", "9", ".", "e", "-", "00"]) for _ in range(draw.randrange(1, 8))) for _ in range(400)]

    def plain(text):
        if not re.fullmatch(r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,6})?\s*", text):
            return None
        number = decimal.Decimal(text.strip())
        if number == 0:
            return 0
        if number.adjusted() > 20 or number.adjusted() < 0 or number != number.to_integral_value():
            return None
        return int(number) if -2 ** 63 <= number < 2 ** 63 else None
    assert col_values(spark, C.whole_number, vals) == [plain(v) for v in vals]


def test_tax_id(spark):
    out = col_values(spark, C.tax_id, ["00.394.460/0058-87", "", None, "123456789012345"])
    assert out == ["00394460005887", "00000000000000", None, "12345678901234"]


def test_collapse_and_digits(spark):
    assert one(spark, C.collapse_spaces(F.col("v")), "  a \t b  ") == "a b"
    assert one(spark, C.digits_as_long(F.col("v")), "00.123/4") == 1234


def test_house_number_and_first_number(spark):
    assert col_values(spark, C.house_number, ["Nº 12", "n. 7", "N°9", "  ", "S/N"]) == \
        ["12", "7", "9", None, "S/N"]
    assert col_values(spark, C.first_number, ["Nº 12", "S/N", None]) == [12, None, None]


def test_postal_code(spark):
    assert col_values(spark, C.postal_code, ["01310100", "2004003", "301400001"]) == \
        ["01310-100", "2004003", "301400001"]


def test_address_line_keeps_empty_parts(spark):
    df = spark.createDataFrame([("", "c", "rua a", "", "são paulo", "sp", None)],
                               "n string, c string, s string, b string, ci string, u string, p string")
    r = df.select(C.address_line("n", "c", "s", "b", "ci", "u", "p").alias("r")).first()["r"]
    assert r == " Rua A, , São Paulo, SP"


def test_whole_number(spark):
    assert col_values(spark, C.whole_number, ["2", "2.0", "1.5", "x", "", None]) == \
        [2, 2, None, None, None, None]


def test_month_date(spark):
    df = spark.createDataFrame([(2025, 0), (2025, 11), (2025, 12), (None, 3)], "y long, i long")
    out = [r[0] for r in df.select(C.month_date("y", "i")).collect()]
    assert out == [dt.date(2025, 1, 1), dt.date(2025, 12, 1), None, None]


def test_month_start_spellings(spark):
    assert col_values(spark, C.month_start, ["2026-01", "202601", "2026-01-15", "x"]) == \
        [dt.date(2026, 1, 1), dt.date(2026, 1, 1), dt.date(2026, 1, 15), None]


def test_lookup_with_fallback(spark):
    m = {"SP": "SUDESTE"}
    assert col_values(spark, lambda c: C.lookup(c, m, "NÃO INFORMADO"), ["SP", "XX", None]) == \
        ["SUDESTE", "NÃO INFORMADO", "NÃO INFORMADO"]


def test_surrogate_key_matches_python(spark):
    import hashlib
    df = spark.createDataFrame([("a", None, dt.date(2025, 1, 1))], "x string, y string, d date")
    got = df.select(surrogate_key("x", "y", "d").alias("k")).first()["k"]
    assert got == hashlib.sha256("a||||2025-01-01".encode()).hexdigest()


def test_initcap_only_after_spaces(spark):
    assert one(spark, F.initcap(F.col("v")), "das-flores RUA") == "Das-flores Rua"


@pytest.mark.parametrize("text", [
    "a &amp; b", "&amp;lt;x&amp;gt;", "&lt;b&gt; &quot;q&quot; &#39;s&#39; &apos;", "x&nbsp;y",
    "&copy; 2025 &middot; &#233;&#x41;", "url?a=1&ref=x", "&ampx &copyright", "&&lt;", "plain"])
def test_decode_entities_matches_python(spark, text):
    import html
    assert one(spark, X.decode_entities(F.col("v")), text) == html.unescape(text)


def test_rfc822_to_utc(spark):
    vals = ["Mon, 01 Dec 2025 10:30:00 -0300", "Tue, 02 Dec 2025 08:00:00 GMT",
            "Tue, 02 Dec 2025 08:00:00 EST", "Tue, 02 Dec 2025 23:30:00 +0130"]
    out = col_values(spark, lambda c: X.rfc822_wallclock(c, to_utc=True), vals)
    assert out == [dt.datetime(2025, 12, 1, 13, 30), dt.datetime(2025, 12, 2, 8, 0),
                   dt.datetime(2025, 12, 2, 13, 0), dt.datetime(2025, 12, 2, 22, 0)]


def test_entities_as_the_standard_library_reads_them(spark):
    import html
    vals = ["a & b", "&amp;lt;", "&copy 2020 &copy; &copyx &notit; &not", "&#233;&#xE9;&#XE9 &#0;&#128;&#x80;&#1;&#13;&#9;",
            "&#1114112; &#xD800; &#99999999999999999999; &#65534;", "&hellip;&rarr;&nGt;&acE;", "&unknown; &;&&amp&ampx;",
            "AT&T &lt", "&", "", None, "&middot;&#8217;&eacute&Eacute;", "&#x1F600;!", "x&nbsp;y&#;&#x;"]
    got = col_values(spark, X.decode_entities, vals)
    assert got == [None if v is None else html.unescape(v) for v in vals]
