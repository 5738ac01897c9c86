"""Toxicity by a classifier chain over graded categories.

Features: a chosen vocabulary of whole lower-cased words and of word beginnings (four and five letters); a
feature's value is ``log(1 + number of the document's distinct words that show it)``.  The vocabulary is chosen
on a bounded sample of labelled rows by smoothed log-odds, so that it holds what toxic rows show
and clean rows don't.

Chain: the categories are predicted one after the other by linear (logistic) models.  Each model reads the
features and the log-odds of all earlier categories.  While fitting, these come out of fold: the rows are dealt
into ``FOLDS`` parts and each part's probabilities come from models of the other parts, so that a later
model learns how far earlier predictions can be trusted.

``labels`` marks one category, so the query grades it: ``abusive`` (a toxic row with a vocabulary word),
``repeated`` (two or more) and ``dense`` (four or more, or one in forty words) come before ``toxic``.

Defined cases: null or empty text has no feature; null labels are not learned from; several labels of one
document count as toxic if one does; without toxic or without clean rows every probability is 0;
equal texts get equal results; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, text_udf
from strata.llm.langid import fold
from strata.llm.wordbpe import values

CATEGORIES = ("abusive", "repeated", "dense", "toxic")
FOLDS = 4
#: Bounds of the labelled sample: toxic and clean rows (in the mean, chosen by a hash of the id).
TOXIC_ROWS, CLEAN_ROWS = 4000, 8000
VOCABULARY = 1500
#: A feature needs this share of the toxic sample, and these log-odds against the clean one.
LEAST_SHARE, LEAST_ODDS = 0.004, 3.0
BEGINNINGS = (4, 5)
SLICE_BYTES = 500_000


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """``(text, word)`` numbers of the distinct words of each text, and the words."""
    words = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    coded = pc.dictionary_encode(words.values)
    first = coded.indices.to_numpy(zero_copy_only=False)
    trimmed = pc.dictionary_encode(pc.utf8_trim(coded.dictionary, characters=string.punctuation))
    number = trimmed.indices.to_numpy(zero_copy_only=False)[first]
    size = max(1, len(trimmed.dictionary))
    pairs = np.unique(owner.astype(np.int64) * size + number)
    return pairs // size, pairs % size, values(trimmed.dictionary)


def _names(word: str) -> list[str]:
    """Features of a word: itself and its beginnings."""
    return ["=" + word, *("^" + word[:n] for n in BEGINNINGS if len(word) > n)] if word else []


def _parts(column: pa.Array):
    """Consecutive slices of whole texts."""
    column = pc.fill_null(column, "")
    size = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) if len(column) else []
    at = 0
    while at < len(column):
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + SLICE_BYTES, side="right")))
        yield column.take(pa.array(np.arange(at, to)))
        at = to


@dataclass
class Chain:
    """Vocabulary and linear models of the categories, in their order."""

    categories: tuple[str, ...]
    column: dict[str, int]
    weights: list[np.ndarray]  # of a category: features, earlier log-odds, bias

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse rows ``(text, feature, value)``."""
        owner, word, names = _words(texts)
        get = self.column.get
        shows = [[c for f in _names(w) if (c := get(f)) is not None] for w in names]
        count = np.fromiter(map(len, shows), dtype=np.int64, count=len(shows))
        hit = np.flatnonzero(count[word] > 0)
        rows, cols = [], []
        for t, w in zip(owner[hit].tolist(), word[hit].tolist()):
            rows += [t] * len(shows[w])
            cols += shows[w]
        width = max(1, len(self.column))
        cell, n = np.unique(np.array(rows, dtype=np.int64) * width + np.array(cols, dtype=np.int64),
                            return_counts=True)
        return cell // width, cell % width, np.log1p(n)

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        rows, cols, value = self.features(texts)
        return chained(rows, cols, value, len(texts), self.weights)


def log_odds(rows, cols, value, n: int, earlier: np.ndarray, weight: np.ndarray) -> np.ndarray:
    width = len(weight) - earlier.shape[1] - 1
    return np.bincount(rows, weight[cols] * value, n) + earlier @ weight[width:-1] + weight[-1]


def chained(rows, cols, value, n: int, weights: list[np.ndarray]) -> np.ndarray:
    """(n, categories) probabilities, each category after the earlier ones."""
    earlier = np.zeros((n, 0))
    for weight in weights:
        z = np.clip(log_odds(rows, cols, value, n, earlier, weight), -12, 12)
        earlier = np.concatenate([earlier, z[:, None]], axis=1)
    return 1 / (1 + np.exp(-earlier))


def fit_linear(rows, cols, value, n: int, width: int, earlier: np.ndarray, y: np.ndarray,
               ridge: float = 1e-3, steps: int = 250, rate: float = 0.15) -> np.ndarray:
    """Logistic regression by full-batch Adam steps over sparse rows."""
    extra = earlier.shape[1]
    weight = np.zeros(width + extra + 1)
    weight[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    mean, square = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(log_odds(rows, cols, value, n, earlier, weight), -30, 30)))
        off = (p - y) / n
        grad = np.concatenate([np.bincount(cols, value * off[rows], width), earlier.T @ off, [off.sum()]])
        grad[:-1] += ridge / n ** 0.5 * weight[:-1]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad ** 2
        weight -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return weight


def fit_chain(rows, cols, value, n: int, width: int, targets: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """Weights of each category; the earlier log-odds that they learn from come out of fold."""
    weights, outside = [], np.zeros((n, 0))
    for at in range(targets.shape[1]):
        y = targets[:, at].astype(float)
        weights.append(fit_linear(rows, cols, value, n, width, outside, y))
        if at + 1 < targets.shape[1]:
            z = np.zeros(n)
            for f in range(FOLDS):
                held = folds == f
                own = ~held[rows]
                place = np.cumsum(~held) - 1
                part = fit_linear(place[rows[own]], cols[own], value[own], int((~held).sum()), width,
                                  outside[~held], y[~held])
                z[held] = np.clip(log_odds(rows, cols, value, n, outside, part), -12, 12)[held]
            outside = np.concatenate([outside, z[:, None]], axis=1)
    return weights


def _document_frequencies(batches):
    """Distinct-document counts of features among toxic and clean texts; Spark adds them up."""
    for batch in batches:
        toxic = batch.column(0).to_numpy(zero_copy_only=False)
        at = 0
        for part in _parts(batch.column(1)):
            owner, word, names = _words(part)
            number: dict[str, int] = {}
            shows = [[number.setdefault(f, len(number)) for f in _names(w)] for w in names]
            size = np.fromiter(map(len, shows), dtype=np.int64, count=len(shows))
            flat = np.fromiter((f for x in shows for f in x), dtype=np.int64, count=int(size.sum()))
            begin = np.cumsum(size) - size
            times = size[word]
            place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            feature = flat[np.repeat(begin[word], times) + place]
            width = max(1, len(number))
            cell = np.unique(np.repeat(owner, times) * width + feature)
            bad = toxic[at + cell // width] > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(number), pa.string()),
                 pa.array(np.bincount(cell[bad] % width, minlength=width)[:len(number)]),
                 pa.array(np.bincount(cell[~bad] % width, minlength=width)[:len(number)])],
                ["feature", "toxic", "clean"])
            at += len(part)


def _rows(column: dict[str, int]):
    chain = Chain((), column, [])

    def run(batches):
        for batch in batches:
            toxic = batch.column(0).to_pylist()
            folds = batch.column(2).to_pylist()
            at = 0
            for part in _parts(batch.column(1)):
                rows, cols, value = chain.features(part)
                words = np.bincount(_words(part)[0], minlength=len(part))
                bounds = np.searchsorted(rows, np.arange(len(part) + 1))
                spans = list(zip(bounds[:-1], bounds[1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(toxic[at:at + len(part)], pa.int64()), pa.array(folds[at:at + len(part)], pa.int64()),
                     pa.array(words, pa.int64()), pa.array([cols[a:b].tolist() for a, b in spans], pa.list_(pa.int64())),
                     pa.array([value[a:b].tolist() for a, b in spans], pa.list_(pa.float64()))],
                    ["toxic", "fold", "words", "cols", "value"])
                at += len(part)
    return run


def grades(toxic: np.ndarray, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    """(n, 4) targets in the order of ``CATEGORIES``."""
    yes = toxic > 0
    return np.stack([yes & (hits >= 1), yes & (hits >= 2),
                     yes & ((hits >= 4) | ((hits >= 2) & (hits * 40 >= words))), yes], axis=1)


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS,
           clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """Bounded labelled sample ``(toxic, text, fold)`` of documents outside fold 0 of 5."""
    marked = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
              .where("id is not null and toxic is not null").where(fold(F.col("id"), 5) != 0)
              .groupBy("id").agg(F.max("toxic").alias("toxic")))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("toxicity")), F.lit(1 << 20))
    sizes = {r["toxic"] > 0: r["n"] for r in marked.groupBy((F.col("toxic") > 0).cast("int").alias("toxic"))
             .agg(F.count("*").alias("n")).collect()}
    limit = F.when(F.col("toxic") > 0, int(min(1.0, toxic_rows / sizes.get(True, 1)) * (1 << 20))).otherwise(
        int(min(1.0, clean_rows / sizes.get(False, 1)) * (1 << 20)))
    chosen = marked.withColumn("draw", draw).where(F.col("draw") < limit)
    # the sample's ids are bounded by the two parameters
    return docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["id"]).select(
        (F.col("toxic") > 0).cast("long").alias("toxic"), "text", (F.col("draw") % FOLDS).alias("fold"))


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS,
        vocabulary: int = VOCABULARY) -> Chain | None:
    """The chain; ``docs``: ``doc_id, text``; ``labels``: ``doc_id, toxic``.  None without both classes."""
    rows = checkpoint(sample(docs, labels, toxic_rows, clean_rows), cache=False)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    found = rows.select("toxic", "text").mapInArrow(_document_frequencies, "feature string, toxic long, clean long")
    found = found.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = (F.log((F.col("toxic") + 0.5) / (sizes[1] - F.col("toxic") + 0.5))
            - F.log((F.col("clean") + 0.5) / (sizes[0] - F.col("clean") + 0.5)))
    least = max(3, int(np.ceil(LEAST_SHARE * sizes[1])))
    chosen = (found.where(F.col("toxic") >= least).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
              .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "feature").limit(vocabulary))
    names = sorted(r["feature"] for r in chosen.select("feature").collect())
    column = {name: i for i, name in enumerate(names)}
    got = rows.select("toxic", "text", "fold").mapInArrow(
        _rows(column), "toxic long, fold long, words long, cols array<long>, value array<double>").toArrow()
    toxic, folds, words = (got[c].to_numpy() for c in ("toxic", "fold", "words"))
    lists = got["cols"].combine_chunks()
    bounds = np.diff(lists.offsets.to_numpy())
    at = np.repeat(np.arange(len(toxic)), bounds)
    cols = lists.flatten().to_numpy()
    value = got["value"].combine_chunks().flatten().to_numpy()
    whole = np.array([n.startswith("=") for n in names] or [False])
    hits = np.bincount(at, np.expm1(value) * (whole[cols] if len(cols) else 0), len(toxic))
    targets = grades(toxic, hits, words)
    return Chain(CATEGORIES, column, fit_chain(at, cols, value, len(toxic), len(names), targets, folds))


RESULT = "struct<" + ",".join(f"p_{c}:double" for c in CATEGORIES) + ">"


def predict(chain: Chain | None):
    """Column function: whole text to ``struct<p_abusive, p_repeated, p_dense, p_toxic>``."""
    if chain is None:
        return lambda text: F.struct(*[F.lit(0.0).alias(f"p_{c}") for c in CATEGORIES])

    def make():
        def work(batch: pa.Array) -> pa.Array:
            parts = [chain.probabilities(p) for p in _parts(batch)] or [np.zeros((0, len(CATEGORIES)))]
            p = np.concatenate(parts)
            return pa.StructArray.from_arrays([pa.array(p[:, i]) for i in range(len(CATEGORIES))],
                                              names=[f"p_{c}" for c in CATEGORIES])
        return work
    return text_udf(make, RESULT)


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.5) -> DataFrame:
    """One row a document: ``doc_id, held_out, p_abusive, p_repeated, p_dense, p_toxic, toxic``; documents of fold
    0 of 5 are held out of the learning."""
    docs = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    chain = fit(docs, labels)
    held = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return docs.select("doc_id", held, predict(chain)("text").alias("p")).select(
        "doc_id", "held_out", "p.*", (F.col("p.p_toxic") >= threshold).alias("toxic"))
