"""Document fingerprints by consistent weighted sampling.

Terms are the lower-cased words of the whole text, weighted by their counts.  For sample ``k`` a term's hash gives
``r`` and ``c`` (gamma distributed, shape two) and ``b`` (uniform); at weight ``w`` the term's level is
``t = floor(ln w / r + b)`` and its value ``ln c - r * (t - b) - r``.  The sample is the term and level of the lowest value.
Two documents agree in a sample with the probability of their generalised Jaccard similarity (sum of the smaller
weights over sum of the larger ones).  The value depends on term and level alone, so the lowest value itself
stands for the sample: a fingerprint is ``SAMPLES`` digests of 16 bits, and the likeness of two is the share of
equal digests.

Neighbours: documents are dealt into consecutive ranges of ``doc_id`` (bounds from quantiles, one number a
range), each range sorted in its task; the first document of a range also goes to the range before it, so
every document meets the next one with the texts shuffled once.

Defined cases: null text is empty; empty texts have a fingerprint of zeros and likeness 1 to each other; a lone
document is its own next one; documents with the same ``doc_id`` follow by text; null ids come first; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import documents

SAMPLES = 128
SEED = 7
#: Characters of text that are sampled at a time; a longer text goes alone.
WINDOW_CHARS = 1_500_000
#: Terms that are drawn at a time.
STRIP = 512
LEAST = -(1 << 63)

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


@lru_cache(maxsize=1)
def _gamma() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the gamma distribution of shape two at 2**16 even steps, and their logarithms."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.sqrt(2 * p) + p  # Newton steps on 1 - (1 + x) exp(-x) = p, in logarithms for the upper tail
    x = np.where(p > 0.7, -np.log1p(-p) + np.log1p(-np.log1p(-p)), x)
    for _ in range(60):
        x = np.maximum(x - (np.log1p(x) - x - np.log1p(-p)) / (1 / (1 + x) - 1), 1e-9)
    return x.astype(np.float32), np.log(x).astype(np.float32)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 32-bit finaliser in place: every bit of the result depends on every bit of ``h``."""
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def values(terms: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """(n, samples) values of terms (hashes) at their weights."""
    gamma, log_gamma = _gamma()
    out = np.empty((len(terms), samples), dtype=np.float32)
    log_weight = np.log(weights).astype(np.float32)[:, None]
    plain = bool((weights == 1).all())
    halves = terms.view(np.uint32).reshape(-1, 2) if terms.flags.c_contiguous else np.ascontiguousarray(
        terms).view(np.uint32).reshape(-1, 2)
    step = np.arange(1, samples + 1, dtype=np.uint32) * np.uint32(0x9E3779B1)
    for at in range(0, len(terms), STRIP):  # rows that stay in a core's cache
        rows = np.s_[at:at + STRIP]
        one = _mixed(halves[rows, :1] + step)
        two = _mixed((halves[rows, 1:] ^ one) + step)
        r = gamma[one >> np.uint32(16)]
        b = (two >> np.uint32(8)).astype(np.float32)
        b *= np.float32(2.0 ** -24)
        if not plain:
            b -= np.floor(log_weight[rows] / r + b)
        b -= 1
        b *= r
        np.add(log_gamma[one & np.uint32(0xFFFF)], b, out=out[rows])
    return out


def signatures(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """(texts, samples) digests of 16 bits of whole texts."""
    words = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string()).cast(pa.string())))
    bounds = words.offsets.to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(words.values)
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in names), dtype=np.uint64, count=len(names))
    filled = np.array([bool(w) for w in names] or [False])
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    keep = filled[word] if len(word) else np.zeros(0, dtype=bool)
    size = max(1, len(names))
    pair, weight = np.unique(owner[keep] * size + word[keep], return_counts=True)
    out = np.zeros((len(texts), samples), dtype=np.uint16)
    if not len(pair):
        return out
    heavy = int(weight.max()) + 1
    kind, place = np.unique((pair % size) * heavy + weight, return_inverse=True)
    light = kind % heavy == 1
    value = np.empty((len(kind), samples), dtype=np.float32)
    for part in (light, ~light):
        if part.any():
            value[part] = values(hashes[kind[part] // heavy], (kind[part] % heavy).astype(np.float64), samples)
    text = pair // size
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    low = np.empty((len(first), samples), dtype=np.float32)
    for row, (a, b) in enumerate(zip(first.tolist(), [*first[1:].tolist(), len(pair)])):
        value[place[a:b]].min(axis=0, out=low[row])
    out[text[first]] = (_mixed(low.view(np.uint32) + np.uint32(1)) >> np.uint32(16)).astype(np.uint16)
    return out


def written(signature: np.ndarray) -> str:
    """Hexadecimal form of a fingerprint, four digits a sample."""
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimate of the generalised Jaccard similarity."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the following one."""
    n = len(text)
    q = n // 4
    return text[:n - q] + following[:q]


def _compare(samples: int):
    """Rows of a range in order to results; the last rows of a range are guests from the next one."""

    def window(rows: list[tuple]) -> pa.RecordBatch:
        texts = [r[3] for r in rows]
        own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
        new = [edited(texts[i], texts[i + 1]) for i in own]
        found = signatures(texts + new, samples)
        out = []
        for j, i in enumerate(own):
            a, b, c = found[i], found[len(rows) + j], found[i + 1]
            out.append((rows[i][2], len(texts[i]), hashlib.sha256(new[j].encode("utf-8", "replace")).hexdigest(),
                        written(a), written(b), likeness(a, b), likeness(a, c)))
        names = [c.split()[0] for c in RESULT.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chars = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns]):
                    rows.append(row)
                    chars += len(row[3])
                    if chars >= WINDOW_CHARS and len(rows) > 1:
                        yield window(rows)
                        rows, chars = rows[-1:], len(row[3])
        if len(rows) > 1:
            yield window(rows)
    return run


def _deal(bounds: np.ndarray, first: dict[int, int], before: dict[int, int]):
    """Adds the range; the first documents of a range go to the range before as guests too."""
    firsts = np.array(sorted(first.values()), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = pc.fill_null(batch.column(0), LEAST).to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, key, side="right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(np.zeros(len(key), bool)), *batch.columns],
                ["part", "guest", "doc_id", "text"])
            guests = np.flatnonzero(np.isin(key, firsts))
            if len(guests):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([before[int(p)] for p in part[guests]], pa.int32()),
                     pa.array(np.ones(len(guests), bool)), *[c.take(pa.array(guests)) for c in batch.columns]],
                    ["part", "guest", "doc_id", "text"])
    return run


def _ranges(bounds: np.ndarray):
    def run(batches):
        for batch in batches:
            key = pc.fill_null(batch.column(0), LEAST).to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, key, side="right")
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(key)], ["part", "key"])
    return run


def neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``part, guest, doc_id, text``: ranges of ``doc_id`` in order, each followed by the first document(s) of the
    next range (of the first one after the last) as guests."""
    spark = df.sparkSession
    docs = documents(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)] or [0.5]
    # one number a range
    found = docs.agg(F.percentile_approx("doc_id", steps, 20 * parts).alias("q")).first()["q"] or []
    bounds = np.unique(np.array(found, dtype=np.int64))
    mins = docs.select("doc_id").mapInArrow(_ranges(bounds), "part int, key long").groupBy("part").agg(
        F.min("key").alias("key")).collect()
    first = {r["part"]: r["key"] for r in mins}
    order = sorted(first)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    dealt = docs.mapInArrow(_deal(bounds, first, before), "part int, guest boolean, doc_id long, text string")
    return dealt.repartitionById(max(1, len(bounds) + 1), F.col("part")).sortWithinPartitions(
        "part", "guest", F.col("doc_id").asc_nulls_first(), "text")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 samples: int = SAMPLES) -> DataFrame:
    """One row a document: its fingerprint, that of its edited text, and the likeness to the edited text and
    to the next document."""
    return neighbours(df, id_col, text_col).mapInArrow(_compare(samples), RESULT)
