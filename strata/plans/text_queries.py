"""Feed-text questions on the driver's tables: G17, G21, G22, H12, H2, H3.

``pages`` stands in for the news feed (url + html), ``documents`` for searchable
articles, ``orders`` for the indicator table that the conditional merge keeps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import clean_html, extract_tags, rfc822_wallclock, url_id
from strata.operators.bucket_merge import merge_into, read_buckets, write_buckets
from strata.operators.flatten import union_heterogeneous
from strata.operators.merge import keyed_merge, value_changed
from strata.operators.search import search
from strata.operators.search_index import indexed_search, write_index
from strata.plans.news import ingest
from strata.plans.registry import query
from strata.session import ensure_checkpoint_dir
from strata.sources.tables import Tables

# Fixed values for the test mapping: tag terms that occur in the synthetic prose.
TEST_TERMS = ["the", "and", "that", "with", "de", "la", "und", "Is"]
NO_TAG = "GENERAL"

# DuckDB pieces: RE2's \s and \b are ASCII, so whitespace and word boundaries are
# spelled out to match Python/Java Unicode semantics.
_WS = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
       r"\x{202f}\x{205f}\x{3000}]")
_W = r"[\pL\pM\p{Nd}\p{Nl}\p{Pc}]"
_NW = r"[^\pL\pM\p{Nd}\p{Nl}\p{Pc}]"


def _duck_clean(x: str, n: int) -> str:
    s = f"regexp_replace(coalesce({x}, ''), '<[^>]+>', ' ', 'g')"
    # legacy names decode with or without ";" (as html.unescape does); "&amp" goes
    # last so the chain stays single-pass
    for ent, ch in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"),
                    ("amp", "&")):
        s = f"regexp_replace({s}, '&{ent};?', '{ch}', 'g')"
    s = f"regexp_replace({s}, '{_WS}+([.,!?;:])', '\\1', 'g')"
    s = f"regexp_replace({s}, '{_WS}+', ' ', 'g')"
    s = f"regexp_replace({s}, '^{_WS}+|{_WS}+$', '', 'g')"
    return f"substring({s}, 1, {n})"


def _duck_tags(x: str) -> str:
    hits = ", ".join(
        f"CASE WHEN regexp_matches({x}, '(?i)(^|{_NW}){t}({_NW}|$)') THEN '{t}' END"
        for t in TEST_TERMS)
    joined = f"array_to_string(list_filter([{hits}], lambda v: v IS NOT NULL), ', ')"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' OR {joined} = '' THEN '{NO_TAG}' "
            f"ELSE {joined} END")


def _title(html_col: str, tag: str = "title"):
    return F.regexp_extract(F.col(html_col), rf"(?s)<{tag}>(.*?)</{tag}>", 1)


@query("page_clean", f"""
SELECT page_id, md5(url) AS news_id,
       {_duck_clean("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)", 300)} AS title,
       {_duck_clean("html", 600)} AS summary
FROM pages""")
def page_clean(t: Tables) -> DataFrame:
    """Page title and summary cleaned of markup, id = md5(url)."""
    p = t.pages
    return p.select("page_id", url_id("url").alias("news_id"),
                    clean_html(_title("html"), 300).alias("title"),
                    clean_html(F.col("html"), 600).alias("summary"))


@query("doc_tags", f"SELECT doc_id, {_duck_tags('text')} AS tags FROM documents")
def doc_tags(t: Tables) -> DataFrame:
    """Whole-word, case-insensitive tag terms found in each document (full text)."""
    return t.documents.select("doc_id", extract_tags(F.col("text"), TEST_TERMS, NO_TAG)
                              .alias("tags"))


@query("search", """
SELECT doc_id, source, n_chars FROM documents
WHERE lower(text) LIKE lower('%th_t%') AND upper(source) LIKE upper('%src1%')
ORDER BY n_chars DESC, doc_id LIMIT 10""")
def search_docs(t: Tables) -> DataFrame:
    """Term (wildcards active) and source filter, top 10."""
    d = t.documents.select("doc_id", "source", "n_chars", "text")
    return search(d, "th_t", "src1", text_cols=["text"], source_col="source",
                  order_by=[F.col("n_chars").desc(), F.col("doc_id")], limit=10) \
        .select("doc_id", "source", "n_chars")


@query("search_indexed", """
SELECT doc_id, source, n_chars FROM documents WHERE lower(text) LIKE lower('%keit_ich%the%') AND upper(source) LIKE upper('%src1%')""")
def search_indexed(t: Tables) -> DataFrame:
    """H12/C11/Q22 by index: all documents written with their trigrams, all matches of a term with wildcards."""
    path = f"{ensure_checkpoint_dir(t.spark)}/search-{uuid.uuid4().hex}"
    write_index(t.documents.select("doc_id", "source", "n_chars", "text"), path, "doc_id", ["text"])
    return indexed_search(t.spark, path, "KEIT_ich%The", "src1", id_col="doc_id", text_cols=["text"], source_col="source",
                          limit=0).select("doc_id", "source", "n_chars")


_MERGE_T = ("SELECT o_orderkey, o_orderstatus, o_totalprice AS value, 1 AS batch "
            "FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'")
_MERGE_S = ("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN "
            "o_totalprice + 100.0 WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END "
            "AS value, 2 AS batch FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'")


@query("merge_conditional", f"""
WITH t AS ({_MERGE_T}), s AS ({_MERGE_S}),
j AS (
  SELECT t.o_orderkey AS tk, s.o_orderkey AS sk, t.o_orderstatus AS ts, s.o_orderstatus AS ss,
         t.value AS tv, s.value AS sv, t.batch AS tb, s.batch AS sb
  FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
), a AS (
  SELECT *, CASE WHEN tk IS NULL THEN 'insert' WHEN sk IS NULL THEN 'retain'
                 WHEN (tv <> sv OR tv IS NULL) THEN 'update' ELSE 'keep' END AS merge_action
  FROM j
)
SELECT COALESCE(tk, sk) AS o_orderkey,
       CASE WHEN merge_action = 'insert' THEN ss ELSE ts END AS o_orderstatus,
       CASE WHEN merge_action IN ('insert', 'update') THEN sv ELSE tv END AS value,
       CASE WHEN merge_action IN ('insert', 'update') THEN 2 ELSE tb END AS batch,
       merge_action
FROM a""")
def merge_conditional(t: Tables) -> DataFrame:
    """H2: value-conditional upsert.

    Target = yesterday's snapshot (orders before 2000, batch 1); source = today's
    pull (orders from 1996, batch 2) where open orders were repriced and pending
    ones arrive without a value.  A null source value never clears a target value.
    """
    o = t.orders
    tgt = (o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
            .select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("value"),
                    F.lit(1).alias("batch")))
    src = (o.filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
            .select("o_orderkey", "o_orderstatus",
                    F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 100.0)
                     .when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
                     .otherwise(F.col("o_totalprice")).alias("value"),
                    F.lit(2).alias("batch")))
    merged = keyed_merge(tgt, src, ["o_orderkey"], update_cols=["value"],
                         condition=value_changed("value"),
                         on_update={"batch": F.lit(2)}, on_insert={"batch": F.lit(2)},
                         duplicates="ignore")
    return merged.withColumnRenamed("_action", "merge_action")


# CRC-32 of a text of ASCII characters, bit by bit
_CRC = """xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


@query("merge_stored", f"""
WITH last AS (SELECT CAST(MAX(o_orderdate) AS DATE) AS d FROM orders),
t AS (SELECT o_orderkey, o_orderstatus, o_totalprice AS value, 1 AS batch FROM orders, last
      WHERE CAST(o_orderdate AS DATE) < d),
s AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN NULL
             WHEN CAST(o_orderdate AS DATE) < d - 1 THEN o_totalprice ELSE o_totalprice + 100 END AS value
      FROM orders, last WHERE CAST(o_orderdate AS DATE) >= d - 2),
a AS (SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_orderstatus AS ts, s.o_orderstatus AS ss,
             t.value AS tv, s.value AS sv, t.o_orderkey IS NULL AS ins,
             t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL AND (t.value <> s.value OR t.value IS NULL) AS upd
      FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey),
b AS (SELECT *, {_CRC.format("CAST(o_orderkey AS VARCHAR)")} % 64 AS bucket FROM a)
SELECT o_orderkey, CASE WHEN ins THEN ss ELSE ts END AS o_orderstatus,
       CASE WHEN ins OR upd THEN sv ELSE tv END AS value, CASE WHEN ins OR upd THEN 2 ELSE 1 END AS batch,
       bool_or(COALESCE(ins OR upd, FALSE)) OVER (PARTITION BY bucket) AS rewritten
FROM b""")
def merge_stored(t: Tables) -> DataFrame:
    """H2/D4 on a stored table: all orders but those of the last day, merged with the last three days.

    The oldest of the three days brings nothing new, the next one new prices, the last one new orders; pending orders come
    without a value.  ``rewritten`` says whether the row's bucket was written anew (from its file's path)."""
    path = f"{ensure_checkpoint_dir(t.spark)}/orders-{uuid.uuid4().hex}"
    day = F.col("o_orderdate").cast("date")
    last = t.orders.agg(F.max(day)).first()[0]
    rows = ["o_orderkey", "o_orderstatus"]
    write_buckets(t.orders.where(day < F.lit(last)).select(*rows, F.col("o_totalprice").alias("value"),
                                                           F.lit(1).alias("batch")), path, ["o_orderkey"])
    value = (F.when(F.col("o_orderstatus") == "P", F.lit(None))
             .when(day < F.date_sub(F.lit(last), 1), F.col("o_totalprice")).otherwise(F.col("o_totalprice") + 100))
    merge_into(t.spark, path, t.orders.where(day >= F.date_sub(F.lit(last), 2)).select(
        *rows, value.alias("value"), F.lit(2).alias("batch")), ["o_orderkey"], update_cols=["value"],
        condition=value_changed("value"), on_update={"batch": F.lit(2)})
    merged = read_buckets(t.spark, path)
    return merged.select(*merged.columns, F.col("_metadata.file_path").contains("/v000002/").alias("rewritten"))


def _news_frames(t: Tables):
    p = t.pages
    tgt = p.select(url_id("url").alias("news_id"), F.col("url"),
                   clean_html(_title("html"), 300).alias("title"),
                   clean_html(F.col("html"), 600).alias("summary"),
                   F.lit(1).alias("batch"))
    norm = F.regexp_replace("url", r"[?#].*$", "")
    src = p.select(F.col("page_id"), url_id(norm).alias("news_id"), norm.alias("url"),
                   clean_html(_title("html", "h1"), 300).alias("title"),
                   clean_html(F.col("html"), 600).alias("summary"),
                   F.lit(2).alias("batch"))
    return tgt, src


def _with_tags(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", extract_tags(F.concat_ws(" ", "title", "summary"),
                                              TEST_TERMS, NO_TAG))


_NEWS_T = f"""SELECT md5(url) AS news_id, url,
    {_duck_clean("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)", 300)} AS title,
    {_duck_clean("html", 600)} AS summary, 1 AS batch FROM pages"""
_NEWS_S = f"""SELECT page_id, md5(regexp_replace(url, '[?#].*$', '')) AS news_id,
    regexp_replace(url, '[?#].*$', '') AS url,
    {_duck_clean("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)", 300)} AS title,
    {_duck_clean("html", 600)} AS summary, 2 AS batch FROM pages"""


@query("merge_subset", f"""
WITH t0 AS ({_NEWS_T}), s0 AS ({_NEWS_S}),
t AS (SELECT *, {_duck_tags("concat_ws(' ', title, summary)")} AS tags FROM t0),
s1 AS (SELECT *, {_duck_tags("concat_ws(' ', title, summary)")} AS tags FROM s0),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY news_id ORDER BY page_id DESC)
                            AS rn FROM s1) WHERE rn = 1),
j AS (
  SELECT t.news_id AS tk, s.news_id AS sk, t.url AS tu, s.url AS su, t.title AS tt,
         s.title AS st, t.summary AS tsum, s.summary AS ssum, t.tags AS ttag, s.tags AS stag,
         t.batch AS tb, s.batch AS sb
  FROM t FULL OUTER JOIN s ON t.news_id = s.news_id
), a AS (
  SELECT *, CASE WHEN tk IS NULL THEN 'insert' WHEN sk IS NULL THEN 'retain' ELSE 'update' END
            AS merge_action FROM j
)
SELECT COALESCE(tk, sk) AS news_id,
       CASE WHEN merge_action = 'insert' THEN su ELSE tu END AS url,
       CASE WHEN merge_action = 'retain' THEN tt ELSE st END AS title,
       CASE WHEN merge_action = 'retain' THEN tsum ELSE ssum END AS summary,
       CASE WHEN merge_action = 'retain' THEN tb ELSE sb END AS batch,
       CASE WHEN merge_action = 'retain' THEN ttag ELSE stag END AS tags,
       merge_action
FROM a""")
def merge_subset(t: Tables) -> DataFrame:
    """H3: unconditional upsert of a column subset (title, summary, tags, batch).

    Today's crawl normalises URLs (query and fragment dropped), so pages whose URL
    had none match yesterday's rows and others arrive as new ids; the URL of a
    matched row stays as first stored.  Colliding normalised URLs keep the newest
    page (largest page id).
    """
    tgt, src = _news_frames(t)
    merged = keyed_merge(_with_tags(tgt), _with_tags(src), ["news_id"],
                         update_cols=["title", "summary", "tags", "batch"],
                         duplicates="last", dedup_order=["page_id"])
    return merged.withColumnRenamed("_action", "merge_action")


def _doc_cards(t: Tables, sources) -> DataFrame:
    # the source predicate is applied before the tag regexes run over the full texts
    d = t.documents.filter(F.col("source").isin(*sources))
    return d.select("doc_id", "source", "n_chars", "text",
                    F.substring_index("text", "\n", 1).alias("title"),
                    extract_tags(F.col("text"), TEST_TERMS, NO_TAG).alias("tags"))


_DUCK_CARDS = f"""SELECT doc_id, source, n_chars, text, split_part(text, chr(10), 1) AS title,
    {_duck_tags('text')} AS tags FROM documents"""


@query("topic_in_sources", f"""
WITH c AS ({_DUCK_CARDS})
SELECT doc_id, source, title, tags FROM c
WHERE (lower(text) LIKE '%the%' OR lower(tags) LIKE '%that%') AND source IN ('src1', 'src2')
ORDER BY n_chars DESC, doc_id LIMIT 5""")
def topic_in_sources(t: Tables) -> DataFrame:
    """The whole text or a tag mentions a topic, two named sources, newest-first top 5
    (size stands in for recency; the key breaks ties)."""
    c = _doc_cards(t, ["src1", "src2"])
    hit = F.lower("text").like("%the%") | F.lower("tags").like("%that%")
    return (c.filter(hit)
             .orderBy(F.col("n_chars").desc(), F.col("doc_id")).limit(5)
             .select("doc_id", "source", "title", "tags"))


@query("ilike_in_source", f"""
WITH c AS ({_DUCK_CARDS})
SELECT doc_id, title, tags FROM c
WHERE (text ILIKE '%UND%' OR tags ILIKE '%UND%') AND source = 'src3'
ORDER BY n_chars DESC, doc_id LIMIT 10""")
def ilike_in_source(t: Tables) -> DataFrame:
    """Q23/C11: case-insensitive search of the whole text or the tags inside one source, top 10."""
    c = _doc_cards(t, ["src3"])
    hit = F.col("text").ilike("%UND%") | F.col("tags").ilike("%UND%")
    return (c.filter(hit)
             .orderBy(F.col("n_chars").desc(), F.col("doc_id")).limit(10)
             .select("doc_id", "title", "tags"))


@query("search_any_term", """
SELECT doc_id, source, n_chars FROM documents
WHERE upper(source) LIKE upper('%src1%') ORDER BY n_chars DESC, doc_id LIMIT 10""")
def search_any_term(t: Tables) -> DataFrame:
    """A null term drops its condition, the source filter stays."""
    d = t.documents.select("doc_id", "source", "n_chars", "text")
    return search(d, None, "src1", text_cols=["text"], source_col="source",
                  order_by=[F.col("n_chars").desc(), F.col("doc_id")], limit=10) \
        .select("doc_id", "source", "n_chars")


@query("news_ingest", f"""
WITH items AS (
  SELECT {_duck_clean("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)", 300)} AS title,
         {_duck_clean("html", 600)} AS summary, regexp_replace(url, '[?#].*$', '') AS link,
         TIMESTAMP '2025-01-01 06:30:00' + to_days(CAST(page_id % 300 AS INTEGER)) AS published
  FROM pages),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY published DESC, title DESC, summary DESC) AS place
  FROM items WHERE title <> '' AND link <> '')
SELECT md5(link) AS news_id, title, link, CAST(published AS VARCHAR) AS published FROM ranked WHERE place = 1""")
def news_ingest(t: Tables) -> DataFrame:
    """Pages as feed items; empty titles go, a repeated link keeps its newest item."""
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("page_id") % 300).cast("int"))
    text = F.concat(F.date_format(day, "EEE, dd MMM yy"), F.lit(" 06:30:00 -0300"))
    items = t.pages.select(F.lit("PAGES").alias("source"), F.lit("web").alias("category"),
                           _title("html").alias("title"), F.regexp_replace("url", r"[?#].*$", "").alias("link"),
                           text.alias("pub_date"), F.col("html").alias("description"))
    return ingest(items).select(F.col("ID_NOTICIA").alias("news_id"), F.col("DS_TITULO").alias("title"),
                                F.col("DS_URL_ORIGEM").alias("link"),
                                F.col("DT_PUBLICACAO").cast("string").alias("published"))


@query("rfc822_dates", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL (o_orderkey % 86400) SECOND AS VARCHAR) AS wall_clock
FROM orders""")
def rfc822_dates(t: Tables) -> DataFrame:
    """Order dates written in the four forms that feeds use, read back."""
    at = F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400).cast("int"),
                         F.col("o_orderdate").cast("date").cast("timestamp"))
    form = F.element_at(F.array(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.date_format(at, "d MMM yyyy HH:mm:ss"),
                                F.date_format(at, "EEEE, dd-MMM-yy HH:mm:ss"), F.date_format(at, "EEE, d MMM yy HH:mm:ss")),
                        (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select("o_orderkey", rfc822_wallclock(F.concat(form, F.lit(" GMT"))).cast("string").alias("wall_clock"))


@query("union_sources", """
SELECT 'order' AS kind, CAST(o_orderkey AS BIGINT) AS id, CAST(o_totalprice AS DOUBLE) AS price, NULL::VARCHAR AS url FROM orders
UNION ALL SELECT 'page', CAST(page_id AS BIGINT), NULL, url FROM pages""")
def union_sources(t: Tables) -> DataFrame:
    """Records with different keys in one frame; what a record lacks is null."""
    orders = t.orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").cast("bigint").alias("id"),
                             F.col("o_totalprice").cast("double").alias("price"))
    pages = t.pages.select(F.lit("page").alias("kind"), F.col("page_id").cast("bigint").alias("id"), "url")
    return union_heterogeneous([orders, pages])
