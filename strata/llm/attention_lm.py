"""Language-model scores: a smoothed word model and a causal self-attention model over subword ids.

Base score: every word, and one end a document, by its count in all training documents.  The counts come from one
aggregation over the words of the whole training part.  Words at or above a count that at most ``TABLE_WORDS`` words
reach are scored from a table of that bounded size in every task; all others are joined with the counts by the
64-bit hash of the word, one row an occurrence with its spelled probability, so that both scores have its exact count.

Model: ids of ``word_bpe_49k.json``.  The ``SYMBOLS - 2`` most frequent ids of all training documents are symbols, beside one for
the end and one that escapes to any other id, which then follows its smoothed count, so that every id sequence has
a probability.  One causal attention layer (queries, keys and values by symbol and place, and a bias by
distance) and one hidden layer that also reads the last two symbols
predict the next symbol in two steps, a class of 32 and one of its 32 members.  Windows of ``WINDOW`` places overlap by ``OVERLAP``: a
window's first places only give context, so each id is scored once; the windows of many documents are
multiplied together under one causal mask.  The weights are trained in numpy on every window of all training documents:
they start from a few passes over some of them (``TRAIN_DOCS`` in the mean, at most about ``TRAIN_WINDOWS`` windows); unless
those were all, every task then trains a copy on all windows of its documents, each id predicted once, and the copies' mean by
windows is the model.
Texts are cut into ids once; the training passes and the scores read them from a table below ``spark.checkpoint.dir``.
Order is also counted: the pairs of neighbouring ids of all training
documents, starts and ends included, give a Witten-Bell estimate of the next symbol that is mixed with the model's by
``PAIRED``.  All counts cover all training documents.  A word's probability mixes its
share of all training tokens with the product of its ids' probabilities.

Defined cases: null or empty text has the end alone; without training documents every base term is
log10(0.5 / 0.5) = 0 and the model is uniform; repeated rows give repeated rows; a null ``doc_id`` falls
into fold 0; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, documents
from strata.llm.langid import HashArray, fold
from strata.llm.toxicity import _parts
from strata.llm.wordbpe import WordBpe, default_path, encoder, values

TABLE_WORDS = 1_000_000
GROUPS = 32
SYMBOLS = GROUPS * GROUPS
END, ESCAPE, START = 0, 1, SYMBOLS
WINDOW, OVERLAP = 16, 4
WIDTH, HIDDEN = 16, 48
TRAIN_DOCS, TRAIN_WINDOWS, EPOCHS, BATCH, RATE = 1200, 80_000, 3, 256, 1e-2
#: Rate and batch of the pass over all training documents, from the weights that the first ones gave.
WHOLE_RATE, WHOLE_BATCH = 4e-3, 256
#: Numbers of a row of weights.
WEIGHTS = 4096
#: Weight of the attention model in the mixture with the corpus's word shares.
SPELLED = 0.5
#: Weight of the corpus's symbol pairs in the mixture with the attention model.
PAIRED = 0.5
#: Windows that are multiplied together while scoring.
CHUNK = 2048
#: Keys of counts that a task adds up before it gives them away.
HELD = 500_000
#: Ids of whole documents whose windows are dealt to batches together.
PART_IDS = 180_000
#: Windows of one block.
BLOCK = 128
#: Weights that Adam moves together, and rows of a name that are added one by one.
CACHED, FEW = 8192, 12
HASH_SEED = 42

_LOG10 = np.log(10.0)


class Attention:
    """Weights and their passes forward and backward."""

    def __init__(self, frequency: np.ndarray, seed: int = 11):
        """``frequency``: counts of the symbols in all training documents, the start of the output biases."""
        draw = np.random.default_rng(seed)

        def normal(*shape, scale=0.1):
            return (draw.standard_normal(shape) * scale).astype(np.float32)
        smooth = np.log((frequency.astype(np.float64) + 0.5).reshape(GROUPS, GROUPS))
        group = np.log(np.exp(smooth).sum(axis=1))
        start = {
            # query, key and value of a symbol, and what it adds to the hidden layer as the last one read and the one before
            "table": normal(SYMBOLS + 1, 3 * WIDTH + 2 * HIDDEN),
            "place": normal(WINDOW, 3 * WIDTH, scale=0.02),
            "near": -0.2 * np.arange(WINDOW, dtype=np.float32),
            "mix": normal(WIDTH, HIDDEN, scale=0.2),
            # the last row is the bias
            "group": np.append(normal(HIDDEN, GROUPS, scale=0.05), (group - group.mean())[None], axis=0),
            "member": np.append(normal(GROUPS, HIDDEN, GROUPS, scale=0.05),
                                (smooth - smooth.mean(axis=1, keepdims=True))[:, None], axis=1)}
        self.shapes = {k: x.shape for k, x in start.items()}
        self.all = np.concatenate([x.ravel() for x in start.values()]).astype(np.float32)
        self.w = self.named(self.all)
        self.back = np.maximum(0, np.arange(WINDOW)[:, None] - np.arange(WINDOW))  # how far back a place looks
        self.mask = np.triu(np.full((WINDOW, WINDOW), -1e9, dtype=np.float32), 1)

    def named(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parts of a row of all weights, or of their gradients."""
        stops = np.cumsum([math.prod(s) for s in self.shapes.values()])
        return {k: flat[stop - math.prod(s):stop].reshape(s) for (k, s), stop in zip(self.shapes.items(), stops)}

    def hidden(self, ids: np.ndarray, keep: bool = False):
        """(windows, places, hidden) of symbols read at the places of windows."""
        w, n = self.w, ids.shape[1]
        table = w["table"]
        qkv = table[:, :3 * WIDTH].take(ids, axis=0)
        qkv += w["place"][:n]
        v = np.ones((*ids.shape, WIDTH + 1), dtype=np.float32)  # the last column adds up the weights
        v[..., :WIDTH] = qkv[..., 2 * WIDTH:]
        q, k = qkv[..., :WIDTH], qkv[..., WIDTH:2 * WIDTH]
        a = np.matmul(q * np.float32(WIDTH ** -0.5), k.transpose(0, 2, 1))
        a += w["near"][self.back[:n, :n]] + self.mask[:n, :n]
        np.minimum(a, 60, out=a)
        np.exp(a, out=a)
        o = np.matmul(a, v)
        total = o[..., WIDTH:]
        o = o[..., :WIDTH] / total
        h = np.matmul(o.reshape(-1, WIDTH), w["mix"]).reshape(*ids.shape, HIDDEN)
        h += table[:, 3 * WIDTH:3 * WIDTH + HIDDEN].take(ids, axis=0)
        h[:, 1:] += table[:, 3 * WIDTH + HIDDEN:].take(ids[:, :-1], axis=0)
        np.maximum(h, 0, out=h)
        if not keep:
            return h
        a /= total
        return h, (q, k, v[..., :WIDTH], a, o)

    def frozen(self) -> Frozen:
        """The weights laid out for scoring."""
        return Frozen(self)

    def log_p(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each row's target symbol."""
        w = self.w
        group = target // GROUPS
        order = np.argsort(group.astype(np.uint8), kind="stable")
        rows, target = h.take(order, axis=0), target.take(order)
        bounds = np.append(0, np.cumsum(np.bincount(group, minlength=GROUPS)))
        logits = rows @ w["group"][:-1]
        logits += w["group"][-1]
        got = _picked(logits, target // GROUPS)
        for g, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a < b:
                part = logits[a:b]
                np.matmul(rows[a:b], w["member"][g, :-1], out=part)
                part += w["member"][g, -1]
        got += _picked(logits, target % GROUPS)
        out = np.empty_like(got)
        out[order] = got
        return out

    def step(self, ids: np.ndarray, target: np.ndarray, use: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss and gradients over the used places."""
        w = self.w
        grad = self.named(np.zeros_like(self.all))
        blocks = [slice(at, at + BLOCK) for at in range(0, len(ids), BLOCK)]
        seen = [self.hidden(ids[block], keep=True) for block in blocks]
        h = np.concatenate([h for h, _ in seen]).reshape(-1, HIDDEN)

        used = np.flatnonzero(use)
        t = target.ravel()[used]
        group = t // GROUPS
        order = np.argsort(group.astype(np.uint8), kind="stable")  # the members of a group stand together
        used, t, n = used[order], t[order], len(t)
        bounds = np.append(0, np.cumsum(np.bincount(group, minlength=GROUPS))).tolist()
        rows = np.ones((n, HIDDEN + 1), dtype=np.float32)
        rows[:, :HIDDEN] = h.take(used, axis=0)
        off = rows @ w["group"]
        loss = _softmax_off(off, t // GROUPS)
        np.matmul(rows.T, off, out=grad["group"])
        back = off @ w["group"][:-1].T
        spans = [(rows[a:b], off[a:b], back[a:b], w["member"][g], grad["member"][g])
                 for g, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if a < b]
        for row, part, _, member, _ in spans:
            np.matmul(row, member, out=part)
        loss += _softmax_off(off, t % GROUPS)
        for row, part, to, member, slope in spans:
            np.matmul(row.T, part, out=slope)
            to += part @ member[:-1].T
        back *= rows[:, :HIDDEN] > 0
        dh = np.zeros((len(h) + 1, HIDDEN), dtype=np.float32)  # the last row: no place behind
        dh[used] = back

        dx = np.empty((len(h), 3 * WIDTH), dtype=np.float32)
        for block, (_, kept) in zip(blocks, seen):
            at = slice(block.start * WINDOW, block.stop * WINDOW)
            self._back(dh[:-1][at], kept, dx[at], grad)
        grad["place"][:] = (np.ones(len(ids), dtype=np.float32) @ dx.reshape(len(ids), -1)).reshape(WINDOW, -1)
        _add_rows(grad["table"], ids, dx, dh)
        slope = grad["table"].base
        slope /= n
        return loss / n, grad

    def _back(self, dh: np.ndarray, kept: tuple, dx: np.ndarray, grad: dict[str, np.ndarray]) -> None:
        """Slopes of the queries, keys and values, and what windows add to those of ``mix`` and ``near``."""
        q, k, v, a, o = kept
        dx = dx.reshape(*a.shape[:2], 3 * WIDTH)
        grad["mix"] += o.reshape(-1, WIDTH).T @ dh
        do = (dh @ self.w["mix"].T).reshape(o.shape)
        da = np.matmul(do, v.transpose(0, 2, 1))
        ds = a * da
        da -= (ds.reshape(-1, WINDOW) @ np.ones(WINDOW, dtype=np.float32)).reshape(*a.shape[:2], 1)
        np.multiply(a, da, out=ds)
        grad["near"] += np.bincount(self.back.ravel(), np.ones(len(ds), dtype=np.float32) @ ds.reshape(len(ds), -1),
                                    WINDOW).astype(np.float32)
        ds *= np.float32(WIDTH ** -0.5)
        dx[..., :WIDTH] = np.matmul(ds, k)
        dx[..., WIDTH:2 * WIDTH] = np.matmul(ds.transpose(0, 2, 1), q)
        dx[..., 2 * WIDTH:] = np.matmul(a.transpose(0, 2, 1), do)

    def train(self, ids: np.ndarray, target: np.ndarray, use: np.ndarray, epochs: int = EPOCHS,
              seed: int = 5) -> list[float]:
        """Adam over shuffled batches of windows; the rate falls to zero."""
        draw, adam = np.random.default_rng(seed), Adam(self)
        batches = max(1, -(-len(ids) // BATCH))
        losses = []
        for _ in range(epochs):
            for part in np.array_split(draw.permutation(len(ids)), batches):
                losses.append(adam.step(ids[part], target[part], use[part],
                                        RATE * (1 - (adam.at + 1) / (epochs * batches + 1))))
        return losses

    def flat(self) -> np.ndarray:
        """All weights in one row."""
        return self.all.copy()

    def load(self, flat: np.ndarray) -> None:
        """Take the weights that ``flat`` gave."""
        self.all[:] = flat


class Adam:
    """Steps of a model down its loss."""

    def __init__(self, model: Attention):
        self.model, self.at = model, 0
        self.mean, self.square = np.zeros_like(model.all), np.zeros_like(model.all)

    def step(self, ids: np.ndarray, target: np.ndarray, use: np.ndarray, rate: float) -> float:
        self.at += 1
        loss, grad = self.model.step(ids, target, use)
        slope = grad["table"].base
        by, root = np.float32(rate / (1 - 0.9 ** self.at)), np.float32((1 - 0.99 ** self.at) ** -0.5)
        for at in range(0, len(slope), CACHED):
            g, x, mean, square = (y[at:at + CACHED] for y in (slope, self.model.all, self.mean, self.square))
            part = g - mean
            part *= np.float32(0.1)
            mean += part
            g *= g
            g -= square
            g *= np.float32(0.01)
            square += g
            np.sqrt(square, out=part)
            part *= root
            part += np.float32(1e-7)
            np.divide(mean, part, out=part)
            part *= by
            x -= part
        return loss


class Frozen:
    """The forward pass over tables that need no scaling or slicing, in blocks that stay in a core's cache."""

    def __init__(self, model: Attention):
        w = model.w
        table, place = w["table"], w["place"]
        scale = np.ones(3 * WIDTH + 1, dtype=np.float32)
        scale[:WIDTH] = WIDTH ** -0.5
        # query, key, value; a last column of the values adds up the weights
        self.symbol = np.concatenate([table[:, :3 * WIDTH], np.ones((len(table), 1), np.float32)], axis=1) * scale
        self.place = np.concatenate([place, np.zeros((WINDOW, 1), np.float32)], axis=1) * scale
        self.last = np.ascontiguousarray(table[:, 3 * WIDTH:3 * WIDTH + HIDDEN])
        # a window's first place has no symbol before: row of zeros
        self.before = np.concatenate([table[:, 3 * WIDTH + HIDDEN:], np.zeros((1, HIDDEN), np.float32)])
        self.mix = w["mix"]
        self.bias = w["near"][model.back] + model.mask
        self.log_p = model.log_p

    def hidden(self, ids: np.ndarray, start: int = 0) -> np.ndarray:
        """(windows, places from ``start`` on, hidden), as ``Attention.hidden``; the places before only give context."""
        out = np.empty((len(ids), ids.shape[1] - start, HIDDEN), dtype=np.float32)
        for at in range(0, len(ids), BLOCK):
            self._block(ids[at:at + BLOCK], out[at:at + BLOCK], start)
        return out

    def _block(self, ids: np.ndarray, h: np.ndarray, start: int) -> None:
        x = self.symbol.take(ids, axis=0, mode="clip")
        x += self.place
        a = np.matmul(x[:, start:, :WIDTH], x[..., WIDTH:2 * WIDTH].transpose(0, 2, 1))
        a += self.bias[start:]
        np.minimum(a, 60, out=a)
        np.exp(a, out=a)
        o = np.matmul(a, x[..., 2 * WIDTH:]).reshape(-1, WIDTH + 1)
        np.matmul(o[:, :WIDTH] / o[:, WIDTH:], self.mix, out=h.reshape(-1, HIDDEN))
        h += self.last.take(ids[:, start:], axis=0, mode="clip")
        if start:
            before = ids[:, start - 1:-1]
        else:
            before = np.full(ids.shape, len(self.before) - 1)
            before[:, 1:] = ids[:, :-1]
        h += self.before.take(before, axis=0, mode="clip")
        np.maximum(h, 0, out=h)


def _picked(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    if len(logits) and logits.max() > 80:
        np.minimum(logits, 80, out=logits)
    chosen = logits.ravel().take(np.arange(0, logits.size, logits.shape[1]) + target)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], dtype=np.float32)
    return chosen - np.log(np.maximum(total, 1e-30, out=total), out=total)


def _softmax_off(logits: np.ndarray, target: np.ndarray) -> float:
    """The summed loss; the logits become what they add to its slope."""
    if len(logits) and max(logits.max(), -logits.min()) > 60:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= 1 / (logits @ np.ones(logits.shape[1], dtype=np.float32))[:, None]
    at = np.arange(0, logits.size, logits.shape[1])
    at += target
    flat = logits.ravel()
    chosen = flat.take(at)
    flat[at] = chosen - 1
    return -float(np.log(np.maximum(chosen, 1e-30)).sum())


def _add_rows(out: np.ndarray, ids: np.ndarray, dx: np.ndarray, dh: np.ndarray) -> None:
    """Adds to the row of each symbol read what its place and, by its hidden layer, the next place give."""
    names = ids.ravel()
    order = np.argsort(names.astype(np.uint16), kind="stable")
    behind = np.arange(1, len(names) + 1).reshape(ids.shape)
    behind[:, -1] = len(names)
    rows = np.concatenate([dx.take(order, axis=0), dh.take(order, axis=0), dh.take(behind.ravel()[order], axis=0)], axis=1)
    n = np.bincount(names, minlength=len(out))
    first = np.cumsum(n) - n
    for i in np.flatnonzero(n > FEW).tolist():
        np.add.reduce(rows[first[i]:first[i] + n[i]], axis=0, out=out[i])
    some = np.flatnonzero((n > 0) & (n <= FEW))
    for k in range(FEW):  # the k-th row of each name
        some = some[n[some] > k]
        out[some] += rows.take(first[some] + k, axis=0)


def windows(symbols: np.ndarray, stops: np.ndarray, overlap: int = OVERLAP) -> tuple[np.ndarray, ...]:
    """Windows over the documents' symbols: ``(read, target, use, owner)`` with places after a document's end unused.

    A document reads START and its symbols and predicts its symbols and END."""
    size = np.diff(stops)
    n_windows = 1 + np.maximum(0, -(-(size + 1 - WINDOW) // (WINDOW - overlap)))
    owner = np.repeat(np.arange(len(size)), n_windows)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    place = (number * (WINDOW - overlap))[:, None] + np.arange(WINDOW)
    length = size[owner][:, None]
    base = stops[:-1][owner][:, None]
    padded = np.concatenate([symbols, [END]])
    last = len(symbols)
    read = np.where(place == 0, START, padded[np.minimum(base + np.maximum(place - 1, 0), last)])
    read[place > length] = END
    target = np.where(place < length, padded[np.minimum(base + place, last)], END)
    use = place <= length
    use[number > 0, :overlap] = False
    return read, target, use, owner


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word, HASH_SEED)


class Scorer:
    """What every task needs to score whole texts."""

    def __init__(self, path: str, symbol_of: np.ndarray, escape_log: np.ndarray, model: Attention,
                 table: HashArray, table_count: np.ndarray, tokens: int, distinct: int, n_docs: int, pairs: np.ndarray):
        self.path, self.symbol_of, self.escape_log, self.model = path, symbol_of, escape_log, model.frozen()
        self.table, self.table_count = table, table_count
        self.pair_log = np.log(PAIRED * pairs).astype(np.float32).ravel()
        self.tokens, self.divisor, self.n_docs = tokens, tokens + 0.5 * (distinct + 1), n_docs

    def read(self, part: pa.Array) -> tuple:
        """Words of texts: hashes, table rows, word numbers, where a text's begin, table counts."""
        bounds, index, distinct = _words(encoder(self.path), part)
        hashes = np.fromiter(map(_hash, values(distinct)), np.uint64, len(distinct))
        found = self.table.find(hashes)
        count = np.where(found >= 0, self.table_count[found], 0)
        return hashes, found, index, bounds, count

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of tokens with a count."""
        return np.log10((count + 0.5) / self.divisor)

    def ids_log_p(self, ids: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Natural log probability of every id and of each document's end, in order."""
        symbols = self.symbol_of[ids]
        read, target, use, owner = windows(symbols, stops)
        used = use.sum(axis=1)
        place = np.cumsum(used) - used
        later = np.append(False, owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, dtype=bool)
        out = np.empty(int(used.sum()))
        for kind, start in ((~later, 0), (later, OVERLAP)):
            kind = np.flatnonzero(kind)
            for at in range(0, len(kind), CHUNK):
                part = kind[at:at + CHUNK]
                seen = read[part]
                keep = np.flatnonzero(use[part, start:])
                size = used[part]
                to = np.arange(len(keep)) + np.repeat(place[part] - np.cumsum(size) + size, size)
                aim = target[part, start:].ravel()[keep]
                log_p = self.model.log_p(self.model.hidden(seen, start).reshape(-1, HIDDEN).take(keep, axis=0), aim)
                log_p += np.float32(np.log(1 - PAIRED))
                out[to] = np.logaddexp(log_p, self.pair_log.take(seen[:, start:].ravel()[keep] * SYMBOLS + aim))
        other = np.flatnonzero(symbols == ESCAPE)
        owner = np.searchsorted(stops, other, side="right") - 1
        out[other + owner] += self.escape_log[ids[other]]  # one end stands after each document before
        return out

    def words_log_p(self, ids: np.ndarray, word_stops: np.ndarray, bounds: np.ndarray, count: np.ndarray,
                    known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each document: its known words and its end, each by the mixture of the corpus's word
        shares and the attention model; and the natural log of the model's probability of every word."""
        log_p = self.ids_log_p(ids, word_stops[bounds])
        shift = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        total = np.concatenate([[0.0], np.cumsum(log_p)])
        spelled = total[word_stops[1:] + shift] - total[word_stops[:-1] + shift]
        end_at = word_stops[bounds[1:]] + np.arange(len(bounds) - 1)
        mixed = np.bincount(shift[known], self._mixed(spelled[known], count[known]), len(bounds) - 1)
        return (mixed + self._mixed(log_p[end_at], np.full(len(end_at), self.n_docs))) / _LOG10, spelled

    def _mixed(self, log_p: np.ndarray, count: np.ndarray) -> np.ndarray:
        share = (1 - SPELLED) * count / max(1, self.tokens)
        low = np.minimum(0.0, log_p + 650.0)  # below what a double can hold
        return np.log(share + SPELLED * np.exp(log_p - low)) + np.where(share == 0, low, 0.0)

    def mixed(self, log_p: Column, count: Column) -> Column:
        """``_mixed`` of columns."""
        share = (1 - SPELLED) * count / F.lit(float(max(1, self.tokens)))
        low = F.when(share == 0, F.least(F.lit(0.0), log_p + 650.0)).otherwise(F.lit(0.0))
        return F.log(share + SPELLED * F.exp(log_p - low)) + low


def neighbours(ids: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Codes ``before * (size + 2) + next`` of all neighbouring ids; a document starts with ``size`` and ends with ``size + 1``."""
    n = len(stops) - 1
    at = np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(stops))
    before = np.full(len(ids) + n, size, dtype=np.int64)
    after = np.full(len(ids) + n, size + 1, dtype=np.int64)
    before[at + 1] = ids
    after[at] = ids
    return before * (size + 2) + after


class _Sums:
    """Counts by key that a task holds until there are too many; ``merge`` adds up equal keys of two arrays."""

    def __init__(self, merge):
        self.merge, self.parts, self.size = merge, [], 0

    def add(self, keys, n: np.ndarray) -> list[tuple]:
        """What has to be given away to stay within ``HELD`` keys."""
        self.parts.append((keys, n))
        self.size += len(n)
        if self.size <= HELD:
            return []
        merged = self.rest()
        if len(merged[0][1]) <= HELD // 2:
            self.parts, self.size = merged, len(merged[0][1])
            return []
        return merged

    def rest(self) -> list[tuple]:
        out = [self.merge(self.parts)] if self.parts else []
        self.parts, self.size = [], 0
        return out


def _equal_words(parts: list[tuple]) -> tuple[pa.Array, np.ndarray]:
    both = pa.table([pa.chunked_array([w.cast(pa.string()) for w, _ in parts]),
                     pa.chunked_array([pa.array(n) for _, n in parts])], ["word", "n"])
    sums = both.group_by("word").aggregate([("n", "sum")])
    return sums["word"].combine_chunks(), sums["n_sum"].to_numpy()


def _equal_pairs(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    pair, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return pair, np.bincount(at, np.concatenate([n for _, n in parts]), len(pair)).astype(np.int64)


def _words(tok: WordBpe, part: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``split`` without the empty word that blanks at an end leave."""
    bounds, index, distinct = tok.split(part)
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
    if empty >= 0:
        real = index != empty
        bounds, index = np.append(0, np.cumsum(real))[bounds], index[real]
    return bounds, index, distinct


def _kind(tok: WordBpe) -> type:
    return np.uint16 if tok.size <= 1 << 16 else np.uint32


def _packed(numbers: np.ndarray, stops: np.ndarray) -> pa.Array:
    """A binary value for each stretch of numbers."""
    return pa.Array.from_buffers(pa.binary(), len(stops) - 1, [
        None, pa.py_buffer((stops * numbers.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``_packed`` was given."""
    column = column.cast(pa.large_binary())
    _, stops, data = column.buffers()
    stops = np.frombuffer(stops, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", np.uint8)[stops[0]:stops[-1]]
    return data.view(kind), (stops - stops[0]) // np.dtype(kind).itemsize


def _small(sizes: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes as bytes, each as so many of 255 and one below that add up to it; where each stretch of them begins."""
    ends = np.append(0, np.cumsum(sizes // 255 + 1))
    out = np.full(ends[-1], 255, dtype=np.uint8)
    out[ends[1:] - 1] = sizes % 255
    return out, ends[stops]


def _ends(small: np.ndarray) -> np.ndarray:
    """0 and the running total of the sizes that ``_small`` was given."""
    return np.append(0, np.cumsum(small, dtype=np.int64)[small < 255])


def _slices(column: pa.Array, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of consecutive whole documents and where each document's begin, some ``PART_IDS`` at a time."""
    ids, stops = _unpacked(column, kind)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(stops, stops[at] + PART_IDS, side="right")) - 1)
        yield ids[stops[at]:stops[to]], stops[at:to + 1] - stops[at]
        at = to


ENCODED = "doc_id long, text string, ids binary, sizes binary, word string, pair long, n long"
_FIELDS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("ids", pa.binary()), ("sizes", pa.binary()),
                     ("word", pa.string()), ("pair", pa.int64()), ("n", pa.int64())])


def _encode(path: str):
    """Of rows ``doc_id, text, train``: each with its ids and how many every word has (no row for an empty word), and
    the counts of words, and of pairs of neighbouring ids, of the rows to train on, added up within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = encoder(path)
        words, pairs = _Sums(_equal_words), _Sums(_equal_pairs)

        def given(size: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(size, f.type)
                                               for f in _FIELDS], schema=_FIELDS)

        def counts(of_words: list[tuple], of_pairs: list[tuple]) -> Iterator[pa.RecordBatch]:
            for keys, n in of_words:
                yield given(len(n), word=keys, n=pa.array(n))
            for keys, n in of_pairs:
                yield given(len(n), pair=pa.array(keys), n=pa.array(n))

        for batch in batches:
            at = 0
            for part in _parts(batch.column(1)):
                train = batch.column(2).slice(at, len(part)).to_numpy(zero_copy_only=False)
                bounds, index, distinct = _words(tok, part)
                ids, stops = tok.join(np.arange(len(index) + 1), index, distinct)
                ends = stops[bounds]
                yield given(len(part), doc_id=batch.column(0).slice(at, len(part)), text=part,
                            ids=_packed(ids.astype(_kind(tok)), ends), sizes=_packed(*_small(np.diff(stops), bounds)))
                at += len(part)
                n = np.bincount(index[np.repeat(train, np.diff(bounds))], minlength=len(distinct)).astype(np.int64)
                some = np.flatnonzero(n)
                size = np.diff(ends)
                pair, times = np.unique(neighbours(ids[np.repeat(train, size)], np.append(0, np.cumsum(size[train])),
                                                   tok.size), return_counts=True)
                yield from counts(words.add(distinct.take(pa.array(some)), n[some]), pairs.add(pair, times.astype(np.int64)))
        yield from counts(words.rest(), pairs.rest())
    return run


def encoded(docs: DataFrame, path: str, train: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents ``(doc_id, text)`` cut into ids once, ``(doc_id, text, ids, sizes)``, and the counts ``(word, pair, n)`` of
    those to train on."""
    flag = F.lit(True) if train is None else train
    table = checkpoint(docs.select("doc_id", "text", flag.alias("train")).mapInArrow(_encode(path), ENCODED), cache=False,
                       codec="zstd")
    counts = checkpoint(table.where("n is not null").groupBy("word", "pair").agg(F.sum("n").alias("n")), cache=False)
    return table.where("ids is not null").select("doc_id", "text", "ids", "sizes"), counts


def _symbol_pairs(symbol_of: np.ndarray):
    """Counts of pairs of symbols from counts of pairs of ids."""
    size = len(symbol_of)
    before, after = np.append(symbol_of, [START, END]), np.append(symbol_of, [END, END])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((SYMBOLS + 1) * SYMBOLS, dtype=np.int64)
        for batch in batches:
            pair, n = (batch.column(c).to_numpy() for c in (0, 1))
            np.add.at(counts, before[pair // (size + 2)] * SYMBOLS + after[pair % (size + 2)], n)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["pair", "n"])
    return run


def witten_bell(counts: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """(before, symbols): probability of the next symbol; ``counts``: of the pairs."""
    share = (frequency + 0.5) / (frequency + 0.5).sum()
    kinds = np.maximum(1, (counts > 0).sum(axis=1, keepdims=True))
    return (counts + kinds * share) / (counts.sum(axis=1, keepdims=True) + kinds)


def _ids_of_words(path: str):
    """Counts of ids from counts of words: a word's ids are the same wherever it stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = encoder(path)
        counts = np.zeros(tok.size, dtype=np.int64)
        for batch in batches:
            words = batch.column(0)
            ids, stops = tok.join(np.arange(len(words) + 1), np.arange(len(words)), words)
            n = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(stops))
            counts += np.bincount(ids, n, tok.size).astype(np.int64)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["id", "n"])
    return run


def _sample_symbols(path: str, symbol_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _kind(encoder(path))
        for batch in batches:
            for ids, stops in _slices(batch.column(0), kind):
                read, target, use, _ = windows(symbol_of[ids], stops)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.astype(np.int16).tolist(), pa.list_(pa.int16())) for x in (read, target, use)],
                    ["read", "target", "use"])
    return run


def _train_part(path: str, symbol_of: np.ndarray, frequency: np.ndarray, start: np.ndarray):
    """Rows ``block, windows, weights`` of the copy that has learned from every window of a task's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, model, n = _kind(encoder(path)), Attention(frequency), 0
        model.load(start)
        adam, draw = Adam(model), np.random.default_rng(7)
        for batch in batches:
            for ids, stops in _slices(batch.column(0), kind):
                read, target, use, _ = windows(symbol_of[ids], stops, 0)
                n += len(read)
                for some in np.array_split(draw.permutation(len(read)), -(-len(read) // WHOLE_BATCH)):
                    adam.step(read[some], target[some], use[some], WHOLE_RATE)
        if n:
            flat = model.flat()
            bounds = np.append(np.arange(0, len(flat), WEIGHTS), len(flat)).astype(np.int32)
            blocks = np.arange(len(bounds) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(np.full(len(blocks), n)), pa.ListArray.from_arrays(
                pa.array(bounds), pa.array(flat))], ["block", "windows", "weights"])
    return run


def _mean_weights(copies: pa.Table) -> pa.Table:
    """A block's weights: the mean of its copies by their windows."""
    n = copies["windows"].to_numpy()
    rows = pc.list_flatten(copies["weights"]).to_numpy().reshape(len(n), -1)
    mean = (rows.astype(np.float64) * (n / n.sum())[:, None]).sum(axis=0)
    return pa.table({"block": copies["block"].slice(0, 1), "windows": pa.array([n.sum()]),
                     "weights": pa.array([mean.astype(np.float32)], pa.list_(pa.float32()))})


def train_on_all(docs: DataFrame, path: str, symbol_of: np.ndarray, frequency: np.ndarray, model: Attention) -> int:
    """One pass over every window of all documents, ``(doc_id, text)`` or as ``encoded`` gives them, split over tasks; the
    windows read."""
    kind = "block long, windows long, weights array<float>"
    docs = docs if "ids" in docs.columns else encoded(docs, path)[0]
    copies = checkpoint(docs.select("ids").mapInArrow(_train_part(path, symbol_of, frequency, model.flat()), kind),
                        cache=False)
    got = copies.groupBy("block").applyInArrow(_mean_weights, kind).orderBy("block").collect()  # the weights once
    if not got:
        return 0
    model.load(np.concatenate([np.asarray(r["weights"], dtype=np.float32) for r in got]))
    return got[0]["windows"]


def _score_rows(scorer: Scorer):
    """Rows ``row, doc_id, n_tokens, n_known, base, score`` and the words that the table lacks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, kind = TaskContext.get().partitionId() << 40, _kind(encoder(scorer.path))
        for batch in batches:
            at = 0
            for part in _parts(batch.column(1)):
                n = len(part)
                hashes, found, index, bounds, count = scorer.read(part)
                ids, _ = _unpacked(batch.column(2).slice(at, n), kind)
                stops = _ends(_unpacked(batch.column(3).slice(at, n), np.uint8)[0])
                owner = np.repeat(np.arange(n), np.diff(bounds))
                known = found[index] >= 0
                score, spelled = scorer.words_log_p(ids, stops, bounds, count[index], known)
                base = (np.bincount(owner, np.where(known, scorer.base(count)[index], 0.0), n)
                        + scorer.base(np.array(scorer.n_docs)))
                rare = np.flatnonzero(~known)
                at_row = pa.array(np.searchsorted(owner[rare], np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(n)), batch.column(0).slice(at, n),
                    pa.array(np.diff(bounds).astype(np.int64) + 1),
                    pa.array(np.bincount(owner[known], minlength=n) + (scorer.n_docs > 0)), pa.array(base),
                    pa.array(score),
                    pa.ListArray.from_arrays(at_row, pa.array(hashes[index[rare]].view(np.int64))),
                    pa.ListArray.from_arrays(at_row, pa.array(spelled[rare]))],
                    ["row", "doc_id", "n_tokens", "n_known", "base", "score", "rare", "spelled"])
                row += n
                at += n
    return run


ROWS = ("row long, doc_id long, n_tokens long, n_known long, base double, score double, "
        "rare array<long>, spelled array<double>")


def _table_count(words: DataFrame, most: int) -> int:
    """The lowest count that at most ``most`` words reach: exact up to 64, then powers of two."""
    step = F.when(F.col("n") < 64, F.col("n")).otherwise(
        F.pow(F.lit(2.0), F.floor(F.log2(F.col("n").cast("double")))).cast("long"))
    sizes = sorted(((r["step"], r["words"]) for r in words.groupBy(step.alias("step")).agg(
        F.count("*").alias("words")).collect()), reverse=True)
    total, least = 0, (sizes[0][0] * 2 if sizes else 1)
    for count, n in sizes:
        total += n
        if total > most:
            break
        least = count
    return least


def fit(docs: DataFrame, path: str, table_words: int = TABLE_WORDS, train_docs: int = TRAIN_DOCS,
        counted: DataFrame | None = None) -> tuple[Scorer, DataFrame, int]:
    """From training documents ``(doc_id, text)``, or as ``encoded`` gives them with its counts: the scorer, the word counts
    ``(word, n)`` and the lowest count in the scorer's table."""
    if counted is None:
        docs, counted = encoded(docs, path)
    words = counted.where("pair is null").select("word", "n")
    n_docs = docs.count()
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = size["n"] + n_docs, size["v"] + (n_docs > 0)
    least = _table_count(words, table_words)
    top = words.where(F.col("n") >= least).select(F.xxhash64("word").alias("h"), "n").toArrow()
    table = HashArray(top["h"].to_numpy().view(np.uint64))
    table_count = top["n"].to_numpy()[table.order] if len(top) else np.zeros(1, dtype=np.int64)

    counts = words.mapInArrow(_ids_of_words(path), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    every = np.zeros(encoder(path).size, dtype=np.int64)  # one number an id of the vocabulary
    every[counts["id"].to_numpy()] = counts["n"].to_numpy()
    order = np.lexsort((np.arange(len(every)), -every))[:SYMBOLS - 2]
    symbol_of = np.full(len(every), ESCAPE, dtype=np.int64)
    symbol_of[order] = np.arange(2, 2 + len(order))
    other = symbol_of == ESCAPE
    escape_log = np.log((every + 0.5) / max(0.5, (every[other] + 0.5).sum()))
    frequency = np.zeros(SYMBOLS, dtype=np.int64)
    frequency[END], frequency[ESCAPE] = n_docs, every[other].sum()
    frequency[2:2 + len(order)] = every[order]

    got = counted.where("pair is not null").select("pair", "n").mapInArrow(
        _symbol_pairs(symbol_of), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros((SYMBOLS + 1) * SYMBOLS)  # one number a pair of symbols
    pairs[got["pair"].to_numpy()] = got["n"].to_numpy()
    pairs = witten_bell(pairs.reshape(-1, SYMBOLS), frequency)

    model = Attention(frequency)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("attention")), F.lit(1 << 20))
    limit = int(min(1.0, train_docs / max(1, n_docs)) * (1 << 20))
    rows = checkpoint(docs.where(draw < limit).select("ids").mapInArrow(
        _sample_symbols(path, symbol_of), "read array<short>, target array<short>, use array<short>"), cache=False)
    n_windows = rows.count()
    if n_windows:
        share = min(1.0, TRAIN_WINDOWS / n_windows)
        got = rows.where(F.pmod(F.xxhash64("read", "target"), F.lit(1 << 20)) < int(share * (1 << 20))).toArrow()
        read, target, use = (got[c].combine_chunks().flatten().to_numpy().reshape(-1, WINDOW).astype(np.int64)
                             for c in ("read", "target", "use"))
        order = np.lexsort(read.T)  # the same windows in the same order, however tasks end
        model.train(read[order], target[order], use[order] > 0)
        if share < 1 or limit < 1 << 20:  # else these were all windows
            train_on_all(docs, path, symbol_of, frequency, model)
    return Scorer(path, symbol_of, escape_log, model, table, table_count, tokens, distinct, n_docs, pairs), words, least


def scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
           table_words: int = TABLE_WORDS, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """One row a document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; fold 1 of 5
    is held out."""
    path = tokenizer or default_path()
    docs = documents(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    train = fold(F.col("doc_id"), 5) != 1
    docs, counted = encoded(docs, path, train)
    scorer, words, least = fit(docs.where(train), path, table_words, train_docs, counted)
    rows = checkpoint(docs.mapInArrow(_score_rows(scorer), ROWS), cache=False)
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "spelled")).alias("w")).select(
        "row", F.col("w.rare").alias("h"), F.col("w.spelled").alias("spelled"))
    counted = words.where(F.col("n") < least).select(F.xxhash64("word").alias("h"), "n").groupBy("h").agg(
        F.sum("n").alias("n"))
    joined = rare.join(counted, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    added = joined.groupBy("row").agg(
        F.sum(F.log10(F.col("n") + 0.5) - F.lit(float(np.log10(scorer.divisor)))).alias("more"),
        F.sum(scorer.mixed(F.col("spelled"), F.col("n"))).alias("mixed"), F.count_if(F.col("n") > 0).alias("seen"))
    return rows.drop("rare", "spelled").join(added, "row", "left").select(
        "doc_id", (fold(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(scorer.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("mixed", F.lit(0.0)) / F.lit(float(_LOG10))).alias("score"))
