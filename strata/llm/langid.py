"""Language identification by interpolated Kneser-Ney character models.

One model of order four a language, over lower-cased letters; a run of anything else is one boundary
symbol.  The models are fitted on a bounded sample of labelled documents (``sample_docs`` a
language, chosen by a hash of the id); a second part of the sample calibrates them.  Every n-gram of any
language has one row with the log probabilities under all languages, in arrays sorted by a hash of the
n-gram with a directory over the hash's leading bits, so that one look-up serves all languages.

A document is given the language of the lowest cross-entropy a symbol over its whole text.  ``score``
is the softmax of the cross-entropies at a temperature fitted on the calibration part.  A document is
rejected if it has no letter, or if its pieces of ``PART`` symbols, each under the language that fits it best,
exceed its language's limit, so that texts that mix learned languages stay below it.  The limit lies halfway from a high
quantile of the language's calibration texts to a low one of the other languages' texts that fall to it when their own model is
left out, at least at the former, and at most ``strictness`` of the way from the mean of its texts to that
of the same texts with their letters shuffled, which no order of letters tells apart from noise.

Defined cases: null or empty text and text without a letter get ``und``, score 0, rejected;
null languages are not learned from; equal texts get equal results; without any labelled row
every document is ``und``; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, slices, text_udf, texts_of

ORDER = 4
LETTERS = 61  # letters with a symbol of their own; the others share one
SAMPLE_DOCS = 600
STRICTNESS = 0.75
#: Symbols of a piece, and the quantiles of a language's own and of the other languages' texts.
PART, OWN_HIGH, OTHER_LOW = 128, 0.99, 0.05
UNKNOWN = "und"

RESULT = "struct<lang:string,score:double,bits:double,rejected:boolean>"
_RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("bits", pa.float64()),
                     ("rejected", pa.bool_())])
_ODD = np.uint64(0x9E3779B97F4A7C15)


class HashArray:
    """Sorted hashes with a directory; ``find`` gives a row for each code, -1 for none."""

    def __init__(self, codes: np.ndarray):
        h = (codes.astype(np.uint64) + np.uint64(1)) * _ODD
        self.order = np.argsort(h)
        h = h[self.order]
        self.bits = max(1, int(np.ceil(np.log2(max(2, len(h))))) + 1)
        self.first = np.searchsorted(h, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
                                     ).astype(np.int32)
        span = np.diff(np.append(self.first, len(h)))
        self.steps = int(span.max()) if len(span) else 0
        self.hashes = np.append(h, np.full(self.steps + 1, np.uint64(0)))

    def find(self, codes: np.ndarray) -> np.ndarray:
        h = (codes.astype(np.uint64) + np.uint64(1)) * _ODD
        at = self.first[(h >> np.uint64(64 - self.bits)).astype(np.intp)]
        row = np.where(self.hashes[at] == h, at, -1)
        for step in range(1, self.steps):
            left = np.flatnonzero(row < 0) if step == 1 else left[row[left] < 0]
            if not len(left):
                break
            there = at[left] + step
            row[left] = np.where(self.hashes[there] == h[left], there, -1)
        return row


class Alphabet:
    """Code points to symbols: 0 boundary, 1.. the letters given, the last one any other letter."""

    def __init__(self, letters: str):
        self.size = len(letters) + 2
        table = np.zeros(0x110000, dtype=np.uint8)
        other = np.fromiter((chr(c).isalpha() for c in range(0x30000)), dtype=bool, count=0x30000)
        table[:0x30000][other] = self.size - 1
        for i, c in enumerate(letters):
            table[ord(c)] = i + 1
        self.table = table

    def grams(self, texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the n-grams that end at each symbol, and where each text's begin (one more at the end)."""
        gap = "\0" * (order - 1)
        line = gap + gap.join(t.replace("\0", " ").lower() for t in texts) + gap
        points = np.frombuffer(line.encode("utf-32-le", "replace"), dtype=np.uint32)
        symbol = self.table[points]
        apart = points == 0
        keep = (symbol > 0) | apart
        keep[1:] |= symbol[:-1] > 0
        symbol, apart = symbol[keep].astype(np.int64), apart[keep]
        code = symbol.copy()
        for k in range(1, order):
            code[k:] += symbol[:-k] * self.size ** k
        # gaps are neighbours where a text is empty: count them
        ends = np.cumsum(apart)
        own = ~apart
        bounds = np.searchsorted(ends[own], (order - 1) * np.arange(1, len(texts) + 2))
        return code[own], bounds


def _shuffled(text: str) -> str:
    """The letters and signs of a text in an order that doesn't depend on them."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.random.default_rng(len(points)).permutation(points).tobytes().decode("utf-32-le")


@dataclass
class Models:
    """Kneser-Ney models of all languages over one alphabet."""

    langs: list[str]
    alphabet: Alphabet
    tables: list[tuple[HashArray, np.ndarray]]       # of orders 1..: log2 p, a row a gram
    backoffs: list[tuple[HashArray, np.ndarray]]     # of contexts of 0.. symbols: log2 of the mass left
    scale: float = 1.0
    limits: np.ndarray | None = None

    @classmethod
    def fit(cls, counts: dict[str, tuple[np.ndarray, np.ndarray]], alphabet: Alphabet, order: int = ORDER) -> Models:
        """``counts``: of each language the codes of its highest-order n-grams and their counts."""
        langs, size = sorted(counts), alphabet.size
        grams = {lang: {order: counts[lang]} for lang in langs}
        for lang in langs:
            for n in range(order - 1, 0, -1):  # lower orders count the distinct symbols before
                grams[lang][n] = np.unique(grams[lang][n + 1][0] % size ** n, return_counts=True)
        tables, backoffs = [], []
        below = np.full((size, len(langs)), 1.0 / size)
        lower_codes = np.zeros(1, dtype=np.int64)
        for n in range(1, order + 1):
            codes = np.unique(np.concatenate([grams[lang][n][0] for lang in langs]))
            if n == 1:
                codes = np.arange(size)
            contexts = np.unique(np.concatenate([grams[lang][n][0] // size for lang in langs]))
            left = np.ones((len(contexts), len(langs)))
            seen = np.zeros((len(codes), len(langs)))
            for at, lang in enumerate(langs):
                code, count = grams[lang][n]
                ones, twos = (count == 1).sum(), (count == 2).sum()
                discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
                where = np.searchsorted(contexts, code // size)
                total = np.bincount(where, count, len(contexts))
                kinds = np.bincount(where, minlength=len(contexts))
                left[:, at] = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                seen[np.searchsorted(codes, code), at] = (count - discount) / total[where]
            suffix = np.zeros(len(codes), np.int64) if n == 1 else codes % size ** (n - 1)
            rows = np.searchsorted(lower_codes, suffix) if n > 1 else np.arange(size)
            p = seen + left[np.searchsorted(contexts, codes // size)] * below[rows]
            for made, key, value in ((tables, codes, p), (backoffs, contexts, left)):
                array = HashArray(key)
                made.append((array, np.log2(value[array.order]).astype(np.float32)))
            below, lower_codes = p, codes
        return cls(langs, alphabet, tables, backoffs)

    def _log2(self, code: np.ndarray, n: int) -> np.ndarray:
        """(grams, languages): log2 probability of each gram's last symbol."""
        array, value = self.tables[n - 1]
        row = array.find(code)
        out = value[row]
        none = np.flatnonzero(row < 0)
        if len(none) and n > 1:
            missed = code[none]
            context, left = self.backoffs[n - 1]
            there = context.find(missed // self.alphabet.size)
            out[none] = np.where((there >= 0)[:, None], left[there], 0) + self._log2(
                missed % self.alphabet.size ** (n - 1), n - 1)
        return out

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy a symbol of each whole text under each language; which texts have a letter."""
        return self.pieces(texts)[:2]

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """``bits``; then of all pieces of the texts their bits under each language and their text; the texts' symbols."""
        total = np.zeros((len(texts), len(self.langs)))
        symbols = np.zeros(len(texts))
        letters = np.zeros(len(texts), dtype=bool)
        values, owners = [np.zeros((0, len(self.langs)))], [np.zeros(0, dtype=np.int64)]
        at = 0
        for part in slices(texts):
            code, bounds = self.alphabet.grams(part, ORDER)
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            if len(full):
                value = self._log2(code, ORDER)
                count = -(-n // PART)
                owner = np.repeat(np.arange(len(part)), count)
                first = bounds[owner] + PART * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
                piece = np.add.reduceat(value, first, axis=0, dtype=np.float64)
                total[at + full] = np.add.reduceat(piece, np.searchsorted(owner, full), axis=0)
                letters[at + full] = np.add.reduceat(code % self.alphabet.size > 0, bounds[full])
                values.append(-piece)
                owners.append(owner + at)
            symbols[at:at + len(part)] = n
            at += len(part)
        symbols = np.maximum(symbols, 1)
        return -total / symbols[:, None], letters, np.concatenate(values), np.concatenate(owners), symbols

    def calibrate(self, texts: list[str], langs: list[str], strictness: float = STRICTNESS) -> None:
        """Temperature of the score and each language's limit."""
        bits, letters, piece, owner, symbols = self.pieces(texts)
        truth = np.array([self.langs.index(x) if x in self.langs else -1 for x in langs], dtype=np.int64)
        use = letters & (truth >= 0)
        mixed = np.bincount(owner, piece.min(axis=1), len(bits)) / symbols
        # as if the text's own language had not been learned
        np.put_along_axis(piece, np.maximum(truth[owner], 0)[:, None], np.inf, axis=1)
        without = np.bincount(owner, piece.min(axis=1), len(bits)) / symbols
        other = np.where(np.arange(len(self.langs)) == truth[:, None], np.inf, bits).argmin(axis=1)
        bits, truth, mixed, without, other = bits[use], truth[use], mixed[use], without[use], other[use]
        self.limits = np.full(len(self.langs), np.log2(self.alphabet.size))
        if not len(bits):
            return
        losses = {}
        for scale in 2.0 ** np.arange(-2, 7):
            z = -bits * scale
            z -= z.max(axis=1, keepdims=True)
            losses[scale] = np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth])
        self.scale = float(min(losses, key=losses.get))
        noise, _ = self.bits([_shuffled(t) for t, u in zip(texts, use) if u])
        for at in range(len(self.langs)):
            own = truth == at
            if own.any():
                low, high = bits[own, at].mean(), noise[own, at].mean()
                own_high, limit = np.quantile(mixed[own], OWN_HIGH), low + strictness * max(0.0, high - low)
                if not own.all():
                    near = ~own & (other == at)
                    strange = np.quantile(without[near if near.any() else ~own], OTHER_LOW)
                    limit = min(limit, own_high + 0.5 * max(0.0, strange - own_high))
                self.limits[at] = max(limit, own_high)

    def predict(self, texts: list[str]) -> pa.Array:
        bits, letters, piece, owner, symbols = self.pieces(texts)
        mixed = np.bincount(owner, piece.min(axis=1), len(texts)) / symbols
        best = bits.argmin(axis=1)
        low = bits[np.arange(len(bits)), best]
        share = 1.0 / np.exp((low[:, None] - bits) * self.scale).sum(axis=1)
        names = np.array([*self.langs, UNKNOWN], dtype=object)
        arrays = [pa.array(names[np.where(letters, best, len(self.langs))], pa.string()),
                  pa.array(np.where(letters, np.clip(share, 0.0, 1.0), 0.0)), pa.array(low),
                  pa.array(~letters | (mixed > self.limits[best]))]
        return pa.StructArray.from_arrays(arrays, fields=list(_RESULT))


def _count(alphabet: Alphabet, order: int):
    def run(batches):
        counts: dict[str, list] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for part in slices(texts):
                    counts.setdefault(lang, []).append(
                        np.unique(alphabet.grams(part, order)[0], return_counts=True))
            for lang, parts in counts.items():
                code, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                counts[lang] = [(code, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64))]
        for lang, [(code, n)] in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n)],
                                             ["lang", "code", "n"])
    return run


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
        sample_docs: int = SAMPLE_DOCS, strictness: float = STRICTNESS) -> Models | None:
    """Models from rows with a text and a language; None without any.

    ``sample_docs`` bounds the rows a language (in the mean, chosen by a hash of the key); three
    quarters train, the rest calibrates.  Only letters' and n-grams' counts and the bounded calibration part reach
    the driver."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                           F.pmod(F.xxhash64(F.col(key_col).cast("string"), F.lit("language")), F.lit(1 << 20))
                           .alias("draw")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    limit = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, int(min(1.0, sample_docs / n) * (1 << 20)))])
    sample = checkpoint(rows.where(F.col("draw") < F.element_at(limit, F.col("lang"))), cache=False)
    train, rest = sample.where("draw % 4 > 0"), sample.where("draw % 4 = 0")
    if train.select("lang").distinct().count() < len(sizes):  # too few rows to hold any back
        train = sample
    letters = train.mapInArrow(_letters, "letter string, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    top = letters.orderBy(F.desc("n"), "letter").limit(LETTERS).collect()
    alphabet = Alphabet("".join(r["letter"] for r in top))
    table = train.select("lang", "text").mapInArrow(_count(alphabet, ORDER), "lang string, code long, n long")
    got = table.groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    counts = {}
    for lang, part in got.groupby("lang"):
        part = part.sort_values("code")
        counts[lang] = (part["code"].to_numpy(np.int64), part["n"].to_numpy(np.int64))
    if not counts:
        return None
    models = Models.fit(counts, alphabet)
    held = rest.select("text", "lang").collect()
    models.calibrate([r["text"] for r in held], [r["lang"] for r in held], strictness)
    return models


def _letters(batches):
    counts: dict[str, int] = {}
    for batch in batches:
        for part in slices(texts_of(batch.column(1))):
            points, n = np.unique(np.frombuffer("".join(part).lower().encode("utf-32-le", "replace"),
                                                dtype=np.uint32), return_counts=True)
            for p, c in zip(points.tolist(), n.tolist()):
                if chr(p).isalpha():
                    counts[chr(p)] = counts.get(chr(p), 0) + c
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                     ["letter", "n"])


def identify(models: Models | None):
    """Column function: whole text to ``struct<lang, score, bits, rejected>``."""
    if models is None:
        return lambda text: F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"),
                                     F.lit(0.0).alias("bits"), F.lit(True).alias("rejected"))

    def make():
        return lambda batch: models.predict(texts_of(batch))
    return text_udf(make, RESULT)


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text modulo ``folds``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row a document: ``doc_id, held_out, lang_pred, score, bits, rejected``; documents of fold 0 of 5
    are held out of the learning."""
    docs = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"), df[lang_col].alias("lang"))
    held = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    models = fit(docs.where(fold(F.col("doc_id"), 5) != 0), sample_docs=sample_docs)
    return docs.select("doc_id", held, identify(models)("text").alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.bits", "p.rejected")
