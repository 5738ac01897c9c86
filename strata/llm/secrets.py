"""Secret scan with corpus-wide ownership of the values found.

Per text, by fixed patterns: ``assign`` (a named value), ``access`` (a cloud access key) and ``hex``
(a long run of hexadecimal digits).  Beside these base spans the scan notes bare values that look
like credentials (20 characters or more, letters and digits, high entropy) outside every base span.

Ownership: the SHA-256 of every value is counted over the whole corpus, by distinct repositories
and distinct owners.  A value of ``example_owners`` owners or more is a widely copied example; any other
is owner-specific and live-looking.  A bare value becomes an added span ``owned`` if it is
live-looking, or if a base pattern names the same value anywhere in the corpus and it is live-looking.
Base spans stay whatever their class; ``n_live`` and ``n_example`` count the spans of each class.

A value that a third of all rows hold is reduced before each shuffle (distinct per repository, then counted per
owner, then per value); its class is joined back on the value, where adaptive execution splits it.

Defined cases: null text is empty (no spans, the SHA-256 of nothing); a null owner or repository is an
owner or repository of its own; repeated rows give repeated rows and count once a repository; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import boxed, checkpoint, text_udf, texts_of, with_row

#: Fixed values of the base kinds, in their order.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the same runs as [0-9a-f]+ of 24 characters or more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
BARE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Bits a character that a bare value needs.
BARE_ENTROPY = 3.0
#: Distinct owners from which a value counts as a copied example.
EXAMPLE_OWNERS = 5

SCAN = "array<struct<kind:int,start:long,end:long,value:string>>"
_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                            ("value", pa.string())]))


def entropy(value: str) -> float:
    """Shannon entropy in bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """Spans ``(kind, start, end, SHA-256 of the value)`` of a whole text, by start, then kind;
    kind 3: bare values, still without a verdict."""
    found: list[tuple[int, int, int, str]] = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(0, m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= ASSIGN_LEAST]
    if max(map(len, text.split()), default=0) >= ACCESS_LEAST:
        runs = list(BARE.finditer(text))  # every key and hex run lies within one of them
        for run in runs:
            found += [(1, m.start(), m.end(), m.group()) for m in ACCESS.finditer(text, run.start(), run.end())
                      if m.end() - m.start() >= ACCESS_LEAST]
            found += [(2, m.start(), m.end(), m.group()) for m in HEX.finditer(text, run.start(), run.end())]
        for run in runs:
            value = run.group()
            if (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
                    and entropy(value) >= BARE_ENTROPY
                    and not any(s < run.end() and run.start() < e for _, s, e, _ in found)):
                found.append((3, run.start(), run.end(), value))
    found.sort(key=lambda x: (x[1], x[0]))
    return [(k, s, e, hashlib.sha256(v.encode("utf-8", "replace")).hexdigest()) for k, s, e, v in found]


def scanner():
    """Column function: whole text to its spans."""

    def make():
        def work(batch: pa.Array) -> pa.Array:
            return pa.array([[dict(zip(("kind", "start", "end", "value"), x)) for x in scan(t)]
                             for t in texts_of(batch)], _SPAN)
        return work
    return text_udf(make, SCAN)


def ownership(found: DataFrame) -> DataFrame:
    """``value, n_repos, n_owners, named`` from rows ``value, repo, owner, kind``."""
    per_repo = found.groupBy("value", "owner", "repo").agg(F.max((F.col("kind") < 3).cast("int")).alias("named"))
    per_owner = per_repo.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.max("named").alias("named"))
    return per_owner.groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"),
                                          (F.max("named") == 1).alias("named"))


def judged(rows: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """From a written table of scanned rows (``_row, owner, repo, found``): ``_row`` and its ``spans``, for rows
    that have any: ``array<struct<start, kind, end, live, n_repos, n_owners>>`` in order."""
    each = rows.select("_row", "owner", "repo", F.explode("found").alias("s")).select(
        "_row", "owner", "repo", "s.*")
    owned = checkpoint(ownership(each), cache=False)
    verdict = each.join(owned, "value").withColumn("live", F.col("n_owners") < example_owners)
    verdict = verdict.where((F.col("kind") < 3) | F.col("live"))
    return verdict.groupBy("_row").agg(F.array_sort(F.collect_list(
        F.struct("start", "kind", "end", "live", "n_repos", "n_owners"))).alias("spans"))


def _joined(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
            repo_col: str | None = None, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row a document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_live,
    n_example``.  ``repo_col``: the document itself if not given."""
    repo = df[repo_col or id_col].cast("string")
    rows = df.select(df[id_col].alias("doc_id"), df[owner_col].cast("string").alias("owner"), repo.alias("repo"),
                     scanner()(F.coalesce(df[text_col], F.lit(""))).alias("found"))
    rows = checkpoint(with_row(rows), cache=False)
    found = judged(rows, example_owners)
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean,"
                           "n_repos:bigint,n_owners:bigint>>")
    all_rows = rows.select("_row", "doc_id").join(found, "_row", "left").withColumn(
        "spans", F.coalesce("spans", empty))

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(k):  # a second parameter of the test, with a default or not, would be the index
        return lambda s: s["kind"] == k
    return all_rows.select(
        "doc_id", *[count(of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"), count(lambda s: s["kind"] == 3).alias("n_owned"),
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_example"))


def redact(df: DataFrame, text_col: str = "text", owner_col: str = "source", id_col: str = "doc_id",
           example_owners: int = EXAMPLE_OWNERS, mask: str = "<secret>") -> DataFrame:
    """The same rows and columns, each live-looking span of the text replaced by ``mask``;
    copied examples stay, and so do texts without a span.

    Rows are numbered in the order in which ``df`` gives them: it must be a table, or a frame that
    gives the same rows in the same order whenever it is read."""
    docs = df.select(boxed(df).alias("doc"), F.monotonically_increasing_id().alias("_row"))
    of = F.col("doc").getField
    rows = docs.select("_row", of(owner_col).cast("string").alias("owner"), of(id_col).cast("string").alias("repo"),
                       scanner()(F.coalesce(of(text_col), F.lit(""))).alias("found"))
    live = judged(checkpoint(rows.where(F.size("found") > 0), cache=False), example_owners)
    live = live.select("_row", F.filter("spans", lambda s: s["live"]).alias("hits")).where("size(hits) > 0")
    joined = docs.join(live, "_row", "left").withColumn(
        "masked", _masked(mask)(F.when(F.col("hits").isNotNull(), of(text_col)),
                                F.transform("hits", lambda s: s["start"]), F.transform("hits", lambda s: s["end"])))
    return joined.select(*[(F.coalesce("masked", of(c)) if c == text_col else of(c)).alias(c) for c in df.columns])


def _masked(mask: str):
    """Column function: a text with the spans between starts and ends replaced, in one walk; null stays null."""

    def work(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, starts, ends in batches:
            out = []
            for text, first, last in zip(texts, starts, ends):
                if not text.is_valid or not first.is_valid:
                    out.append(None)
                    continue
                whole, parts, at = text.as_py(), [], 0
                for start, end in zip(first.as_py(), last.as_py()):
                    if start >= at:
                        parts += [whole[at:start], mask]
                    at = max(at, end)
                out.append("".join([*parts, whole[at:]]))
            yield pa.array(out, pa.string())
    work.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(work, "string").asNondeterministic()
