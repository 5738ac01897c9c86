"""Keyword search that reads only texts that can match.

``ILIKE '%term%'`` has to look at every text.  The index is a posting table of trigrams, built when the texts are
written: ``(gram, ids)`` for every run of three characters of the lower-cased text columns of a block of texts, in folders by
a hash of the gram and sorted within, so that a look-up reads a few folders and row groups.  A task makes the postings of its
texts block by block; none of them is shuffled, and a block is bounded by ``BLOCK_CHARS``.  A term's literal stretches (between the
wildcards ``%`` and ``_``, which stay active) give the grams that every match holds; the ids that have all of them
are the candidates, and ``operators/search.py`` decides on their texts alone.

The texts lie in folders by a hash of their id.  Up to ``LISTED`` candidates are looked up by folder and by id, so other
folders are not read; more of them are joined (a left semi join).  A term without three literal characters in a
row has no grams: all texts are read, as without an index.  Rows without id are always candidates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.search import search

PARTS = 64
SLOTS = 64
#: Candidates that are looked up by id; the only ones that reach the driver.
LISTED = 10_000
#: Characters of the texts whose postings are made together; a longer text goes alone.
BLOCK_CHARS = 4_000_000


def grams(text: Column) -> Column:
    """Distinct runs of three characters of a text in lower case; null and shorter texts have none."""
    chars = F.split(F.lower(text), "")
    # shifted copies side by side: within a transform's function the split would be done for every character
    runs = F.transform(F.arrays_zip(chars.alias("a"), F.slice(chars, 2, F.length(text) + 2).alias("b"),
                                    F.slice(chars, 3, F.length(text) + 2).alias("c")),
                       lambda z: F.concat(z["a"], z["b"], z["c"]))
    whole = F.filter(F.array_distinct(runs), lambda g: g.isNotNull())
    return F.when(F.length(text) > 2, whole).otherwise(F.array().cast("array<string>"))


def _block_postings(texts: list[str], owner: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct grams of lower-cased texts, where the owners of each begin (one more at the end), and the distinct owners."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    seen = np.zeros(0x110000, dtype=bool)
    seen[chars] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(0x110000, dtype=np.int64)
    number[alphabet] = np.arange(len(alphabet))
    rank, base = number[chars], len(alphabet)
    inside = np.ones(len(chars), dtype=bool)  # where a gram begins: not at a text's last two characters
    stops = np.cumsum(size)
    inside[(stops - 1)[size > 0]] = False
    inside[(stops - 2)[size > 1]] = False
    at = np.flatnonzero(inside)
    if not len(at):
        return [], np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64)
    gram = (rank[at] * base + rank[at + 1]) * base + rank[at + 2]  # base is at most 0x110000: below 2 ** 61
    kinds = None
    owners = int(owner.max()) + 1
    if base ** 3 * owners >= 1 << 63:
        kinds, gram = np.unique(gram, return_inverse=True)
    pair = np.sort(gram * owners + np.repeat(owner, size)[at])
    pair = pair[np.concatenate([[True], pair[1:] != pair[:-1]])]
    gram, holder = pair // owners, pair % owners
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    codes = gram[first] if kinds is None else kinds[gram[first]]
    text = np.stack([alphabet[codes // base ** 2], alphabet[codes // base % base], alphabet[codes % base]], axis=1)
    flat = text.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [flat[i:i + 3] for i in range(0, len(flat), 3)], np.append(first, len(gram)), holder


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``gram, ids`` of rows ``id, texts``, a block of texts at a time."""
    for batch in batches:
        ids, lists = batch.columns
        values = lists.flatten().to_pylist()
        bounds = lists.value_lengths().to_numpy(zero_copy_only=False).cumsum()
        total = np.concatenate([[0], np.cumsum([len(v or "") for v in values], dtype=np.int64)])
        start = 0
        while start < len(ids):
            low = int(bounds[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(total[bounds], total[low] + BLOCK_CHARS, side="right")))
            count = np.diff(np.concatenate([[low], bounds[start:stop]]))
            grams_, begin, holder = _block_postings([v or "" for v in values[low:int(bounds[stop - 1])]],
                                                    np.repeat(np.arange(stop - start), count))
            if grams_:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams_, pa.string()), pa.ListArray.from_arrays(
                        pa.array(begin, pa.int32()), ids.take(pa.array(start + holder)))], ["gram", "ids"])
            start = stop


def _part(key: Column, parts: int) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(key), F.lit(parts)), F.lit(-1)).cast("int")


def _slot(gram: Column, slots: int) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(slots)).cast("int")


def _texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/texts")


def write_index(df: DataFrame, path: str, id_col: str, text_cols: Sequence[str], parts: int = PARTS,
                slots: int = SLOTS) -> None:
    """Write the texts and their postings below ``path``; an older index there is replaced."""
    key = F.col(id_col)
    rows = df.withColumn("_part", F.when(key.isNull(), F.lit(-1)).otherwise(_part(key, parts)))
    rows.hint("rebalance", "_part").sortWithinPartitions("_part", id_col).write.mode("overwrite").partitionBy(
        "_part").parquet(f"{path}/texts")
    rows.limit(0).write.mode("overwrite").parquet(f"{path}/schema")  # what the texts look like, also without any
    texts = _texts(df.sparkSession, path).where(key.isNotNull())
    lowered = F.array(*[F.lower(F.col(c)) for c in text_cols])
    found = texts.select(key.alias("id"), lowered.alias("texts")).mapInArrow(
        _postings, f"gram string, ids array<{texts.schema[id_col].dataType.simpleString()}>")
    found.withColumn("slot", _slot(F.col("gram"), slots)).sortWithinPartitions("slot", "gram").write.mode(
        "overwrite").partitionBy("slot").parquet(f"{path}/postings")


def term_grams(spark: SparkSession, term: str) -> list[str]:
    """Grams that every text with ``ILIKE '%term%'`` holds."""
    pattern = F.lit(f"%{term}%")  # in lower case as ILIKE has it
    whole = spark.range(1).select(F.lower(pattern)).first()[0]
    literal = re.sub(r"\\(.)|[%_]", lambda m: m.group(1) or "\0", whole, flags=re.S).split("\0")
    row = spark.range(1).select(F.array_distinct(F.flatten(F.array(*[grams(F.lit(s)) for s in literal])))).first()
    return sorted(row[0])


def _slots_made(spark: SparkSession, path: str, column: str) -> list[int]:
    """Numbers of the folders of a partition column."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return [int(n.split("=")[1]) for n in names if n.startswith(f"{column}=")]


def candidates(spark: SparkSession, path: str, term: str, slots: int = SLOTS) -> DataFrame | None:
    """Ids whose texts hold all grams of the term; None if it has none."""
    wanted = term_grams(spark, term)
    if not wanted:
        return None
    if not _slots_made(spark, f"{path}/postings", "slot"):
        return spark.createDataFrame([], "id string")
    places = spark.createDataFrame([(g,) for g in wanted], "gram string").select(_slot(F.col("gram"), slots)).distinct()
    hit = spark.read.parquet(f"{path}/postings").where(
        F.col("slot").isin([r[0] for r in places.collect()]) & F.col("gram").isin(wanted))
    return hit.select("gram", F.explode("ids").alias("id")).groupBy("id").agg(F.collect_set("gram").alias("grams")).where(
        F.size("grams") >= len(wanted)).select("id")


def indexed_texts(spark: SparkSession, path: str, term: str | None, id_col: str, parts: int = PARTS,
                  slots: int = SLOTS) -> DataFrame:
    """Rows that may match a term: the stored texts of its candidates."""
    texts = _texts(spark, path)
    ids = candidates(spark, path, term, slots) if term is not None else None
    if ids is None:
        return texts.drop("_part")
    listed = [r[0] for r in ids.limit(LISTED + 1).collect()]
    if len(listed) > LISTED:
        few = texts.where("_part >= 0").join(ids.withColumnRenamed("id", id_col), id_col, "left_semi")
        return few.unionByName(texts.where("_part < 0")).drop("_part")
    key = texts.schema[id_col].dataType
    here = spark.createDataFrame([(i,) for i in listed], f"id {key.simpleString()}").select(
        _part(F.col("id"), parts)).distinct().collect()
    known = texts.where(F.col("_part").isin([r[0] for r in here]) & F.col(id_col).isin(listed))
    if -1 not in _slots_made(spark, f"{path}/texts", "_part"):
        return known.drop("_part")
    return known.unionByName(texts.where("_part < 0")).drop("_part")


def indexed_search(spark: SparkSession, path: str, term: str | None = None, source: str | None = None, *, id_col: str,
                   text_cols: Sequence[str] = ("title", "summary"), source_col: str = "source",
                   order_by: Sequence[Column] | None = None, limit: int = 10, parts: int = PARTS,
                   slots: int = SLOTS) -> DataFrame:
    """``search`` over an indexed table: the same rows, read from the term's candidates."""
    texts = indexed_texts(spark, path, term, id_col, parts, slots)
    return search(texts, term, source, text_cols=text_cols, source_col=source_col, order_by=order_by, limit=limit)
