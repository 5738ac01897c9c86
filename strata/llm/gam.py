"""Quality by a generalised additive model with pairwise interactions.

Features are counts of a whole text's characters, words and lines, as shares that don't grow with its length
(``FEATURES``).  Each is cut into bins at quantiles of a bounded labelled sample.  The model is a sum of one table
a feature and one a chosen pair of features.  Boosting goes round the features: in every round each feature gets one
shallow tree over its bins (up to four leaves) on the current gradient, added to its table in a small step; no
feature sees the others' trees but through the gradient.  Pairs are ranked by what four quadrants would
still gain, and their tables are boosted in the same way.  A score is the logistic function of the looked-up and
added table entries.

Defined cases: null text is empty; an empty or blank text has all shares zero and gets the score of these bins; null
labels are not learned from; several labels of one document count as good if one does; without labels of both
classes every score is 0.5; equal texts get equal scores; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, text_udf
from strata.llm.langid import fold
from strata.llm.toxicity import _parts

FEATURES = ("log_chars", "upper", "digits", "stops", "bangs", "pipes", "signs", "spaces", "lines", "word_chars",
            "distinct_words", "top_word", "repeated_lines", "odd_ends", "sentence_words")
#: Bound of the labelled sample (rows, in the mean, chosen by a hash of the id).
SAMPLE_ROWS = 12_000
BINS = 32
ROUNDS, RATE = 150, 0.15
PAIRS, PAIR_ROUNDS, PAIR_BINS = 6, 60, 12

# kinds of characters: letters are 0 or 1 (upper), others below
_UPPER, _DIGIT, _SPACE, _LINE, _STOP, _BANG, _PIPE, _SIGN = range(1, 9)


def _kinds() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x3000):
        ch = chr(c)
        if ch.isupper():
            table[c] = _UPPER
        elif ch.isdigit():
            table[c] = _DIGIT
        elif ch.isspace():
            table[c] = _LINE if ch == "\n" else _SPACE
        elif not ch.isalpha():
            table[c] = _STOP if ch in ".,;:'\"()-?" else _BANG if ch == "!" else _PIPE if ch == "|" else _SIGN
    return table


_kind_table: list[np.ndarray] = []


def _shares_of_groups(owner: np.ndarray, item: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: items, distinct items, count of its most frequent item."""
    width = int(item.max()) + 1 if len(item) else 1
    pair, count = np.unique(owner * width + item, return_counts=True)
    text = pair // width
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, text, count)
    return np.bincount(owner, minlength=n), np.bincount(text, minlength=n), top


def features(texts: pa.Array) -> np.ndarray:
    """(texts, features) of whole texts."""
    if not _kind_table:
        _kind_table.append(_kinds())
    n = len(texts)
    lines_of = texts.to_pylist()
    points = np.frombuffer("".join(lines_of).encode("utf-32-le", "replace"), dtype=np.uint32)
    chars = np.fromiter(map(len, lines_of), dtype=np.int64, count=n)
    kind = _kind_table[0][points]
    owner = np.repeat(np.arange(n, dtype=np.int64), chars)
    counts = np.bincount(owner * 16 + kind, minlength=16 * n).reshape(n, 16)

    words = pc.ascii_split_whitespace(texts)
    coded = pc.dictionary_encode(words.values)
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(n, dtype=np.int64), np.diff(words.offsets.to_numpy()))
    filled = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    odd = pc.match_substring_regex(coded.dictionary, r"[^\pL\pN.,;:?]$").to_numpy(zero_copy_only=False)
    keep = filled[word] if len(word) else np.zeros(0, bool)
    word, of = word[keep], of[keep]
    n_words, distinct, top = _shares_of_groups(of, word, n)
    odd_ends = np.bincount(of, odd[word] if len(word) else None, minlength=n)

    rows = pc.split_pattern(texts, "\n")
    row = pc.dictionary_encode(rows.values)
    row_text = row.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row_of = np.repeat(np.arange(n, dtype=np.int64), np.diff(rows.offsets.to_numpy()))
    full = pc.greater(pc.utf8_length(row.dictionary), 20).to_numpy(zero_copy_only=False)
    keep = full[row_text] if len(row_text) else np.zeros(0, bool)
    n_rows, distinct_rows, _ = _shares_of_groups(row_of[keep], row_text[keep], n)

    def per(a, b):
        return a / np.maximum(b, 1)
    letters = counts[:, 0] + counts[:, _UPPER]
    return np.stack([
        np.log1p(chars), per(counts[:, _UPPER], letters), per(counts[:, _DIGIT], chars), per(counts[:, _STOP], chars),
        per(counts[:, _BANG], chars), per(counts[:, _PIPE], chars), per(counts[:, _SIGN], chars),
        per(counts[:, _SPACE], chars), per(counts[:, _LINE], chars),
        per(chars - counts[:, _SPACE] - counts[:, _LINE], n_words), per(distinct, n_words), per(top, n_words),
        per(n_rows - distinct_rows, n_rows), per(odd_ends, n_words), per(n_words, counts[:, _STOP])], axis=1)


@dataclass
class Additive:
    """Bin edges, a table a feature, and tables of pairs."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, (edge, value) in enumerate(zip(self.edges, self.tables)):
            z += value[np.searchsorted(edge, x[:, j], side="right")]
        for a, b, value in self.pairs:
            z += value[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                       np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _gain(g, h):
    return g * g / (h + 1.0)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Newton step of each bin by a tree of the given depth over the bins' gradient and curvature sums."""
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > _gain(g.sum(), h.sum()) + 1e-9:
            return np.concatenate([shallow_tree(g[:cut], h[:cut], depth - 1),
                                   shallow_tree(g[cut:], h[cut:], depth - 1)])
    return np.full(len(g), g.sum() / (h.sum() + 1.0))


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps of the four parts of a pair's table at its best cut, and the gain of the cut."""
    G, H = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    if G.shape[0] < 2 or G.shape[1] < 2:
        return np.zeros_like(g), 0.0

    def parts(s):
        a = s[:-1, :-1]
        b, c = s[:-1, -1:] - a, s[-1:, :-1] - a
        return a, b, c, s[-1, -1] - a - b - c
    gp, hp = parts(G), parts(H)
    gain = sum(_gain(x, y) for x, y in zip(gp, hp)) - _gain(G[-1, -1], H[-1, -1])
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = np.empty_like(g)
    for value, where in zip((x[i, j] / (y[i, j] + 1.0) for x, y in zip(gp, hp)),
                            (np.s_[:i + 1, :j + 1], np.s_[:i + 1, j + 1:], np.s_[i + 1:, :j + 1],
                             np.s_[i + 1:, j + 1:])):
        step[where] = value
    return step, float(gain[i, j])


def fit_tables(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS) -> Additive:
    """Boost the tables on rows ``x`` with labels ``y``."""
    n, width = x.shape
    edges = [_edges(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    z = np.full(n, base)
    for _ in range(rounds):
        for j in range(width):
            p = 1 / (1 + np.exp(-z))
            step = rate * shallow_tree(np.bincount(bins[j], y - p, len(tables[j])),
                                       np.bincount(bins[j], p * (1 - p), len(tables[j])))
            tables[j] += step
            z += step[bins[j]]
    pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    small = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]

    def sums(a, b, v):
        shape = len(pair_edges[a]) + 1, len(pair_edges[b]) + 1
        return np.bincount(small[a] * shape[1] + small[b], v, shape[0] * shape[1]).reshape(shape)
    p = 1 / (1 + np.exp(-z))
    ranked = sorted(((quadrants(sums(a, b, y - p), sums(a, b, p * (1 - p)))[1], a, b)
                     for a in range(width) for b in range(a + 1, width)), key=lambda t: (-t[0], t[1], t[2]))
    chosen = [[a, b, np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1))] for g, a, b in ranked[:pairs] if g > 0]
    for _ in range(PAIR_ROUNDS):
        for pair in chosen:
            a, b, value = pair
            p = 1 / (1 + np.exp(-z))
            step = rate * quadrants(sums(a, b, y - p), sums(a, b, p * (1 - p)))[0]
            value += step
            z += step[small[a], small[b]]
    return Additive(edges, tables, pair_edges, [tuple(c) for c in chosen], base)


def _rows(batches):
    for batch in batches:
        label = batch.column(0)
        at = 0
        for part in _parts(batch.column(1)):
            yield pa.RecordBatch.from_arrays([label.slice(at, len(part)), pa.array(
                features(part).tolist(), pa.list_(pa.float64()))], ["label", "x"])
            at += len(part)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Additive | None:
    """The model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, quality``) outside fold 1 of 3; None
    without both classes."""
    marked = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
              .where("id is not null and label is not null").where(fold(F.col("id"), 3) != 1)
              .groupBy("id").agg(F.max("label").alias("label")))
    limit = int(min(1.0, sample_rows / max(1, marked.count())) * (1 << 20))
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("quality")), F.lit(1 << 20))
    chosen = marked.where(draw < limit)  # bounded by sample_rows
    rows = checkpoint(docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["id"]).select(
        F.col("label").cast("long").alias("label"), "text").mapInArrow(_rows, "label long, x array<double>"),
        cache=False).toArrow()
    y = (rows["label"].to_numpy() > 0).astype(float)
    if len(y) == 0 or y.min() == y.max():
        return None
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(y), len(FEATURES))
    order = np.lexsort((*x.T, y))  # sums don't depend on the order in which tasks end
    return fit_tables(x[order], y[order])


def score(model: Additive | None):
    """Column function: whole text to its score."""
    if model is None:
        return lambda text: F.lit(0.5)

    def make():
        def work(batch: pa.Array) -> pa.Array:
            parts = [model.scores(features(p)) for p in _parts(batch)]
            return pa.array(np.concatenate(parts) if parts else np.zeros(0))
        return work
    return text_udf(make, "double")


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row a document: ``doc_id, held_out, score, predicted``; documents of fold 1 of 3 are held out."""
    docs = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    model = fit(docs, labels, sample_rows)
    held = (fold(F.col("doc_id"), 3) == 1).alias("held_out")
    return docs.select("doc_id", held, score(model)("text").alias("score")).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
