"""Removal of long passages that documents share, with a count-min sketch as a filter.

A window is ``WINDOW`` consecutive words.  Most windows stand in one document alone, so a first pass
over the texts only finds those that may be repeated.  Of the runs of ``RUN`` words within a window
the one with the smallest hash is its anchor: equal windows have equal anchors, and neighbouring
windows mostly share theirs, so that about one hash in 18 words is counted.  Each slice of a partition
sketches its anchors (``DEPTH`` rows of ``CELLS`` counters, only the touched ones); the partial sketches
are merged by Spark's sums.  A cell never counts less than the documents with a window that falls
there, so a window can only be repeated where all its cells have counted two or more.  That is one bit a cell:
``DEPTH * CELLS`` bits, 16 MB at any input, are what the second pass gets.

The second pass gives the windows that are estimated repeated with their place and a key of 128 bits
of the word sequence.  They are grouped exactly: the smallest document of each window is found by an
aggregate that combines before the shuffle, and joined back to the windows of later documents.  The sketch
only ever lets too many windows pass, so none is lost; over some 150 million anchors, 2.5 billion words, it lets
most pass, and the exact part moves nearly all windows; a larger ``cells`` puts that off.

A window of very many documents would send all their rows to one task of that join.  The sketch shows where such
windows can be: cells that have counted at least a ``HOT``-th of the documents.  Windows there are grouped in a job of their
own, and those that really stand so often, at most ``HOT`` times the windows of a mean document, are sent to all
tasks with their smallest document, so their rows are decided where they are read.

Defined cases: a null or empty text has no words; a document without ``doc_id`` has no order, so it loses no words and
takes none from others; rows with one ``doc_id`` take no words from each other, repeated rows get equal
results; a long text is scanned whole, alone in its slice; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, documents

WINDOW = 50
#: Words of the runs among which a window's anchor is chosen.
RUN = 16
DEPTH = 2
#: Counters in a row of the sketch.
CELLS = 1 << 26
#: Bytes of text handed to numpy at a time; whole texts, a longer one goes alone.
SLICE_BYTES = 1 << 18
#: Longer words are hashed one by one: sums of powers of two to the 64th are no good hash of very long strings.
LONG_WORD = 1024

#: A window that stands as often as a HOT-th of the documents is decided without a shuffle.
HOT = 100
#: Windows that stand less often are never treated so.
HOT_LEAST = 100

#: Bits that say which rows may lose words.
CHANGED = 1 << 26

FOUND = "doc_id long, mark long, at int, k1 long, k2 long"
RESULT = "n_words long, n_removed long, kept_sha256 string"


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo two to the 64th, as many as asked for."""

    def __init__(self, base: int):
        self.pair = (np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
        self.tables = (np.ones(1, np.uint64),) * 2

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.tables[0]) < n:
            more = max(n, SLICE_BYTES) + 1
            self.tables = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(more, b, np.uint64)]),
                                           dtype=np.uint64) for b in self.pair)
        return self.tables[0][:n], self.tables[1][:n]


class _Hash:
    """One family of hashes of words and of runs of words."""

    def __init__(self, seed: int):
        draw = np.random.default_rng(seed)
        self.seed = seed
        self.bytes = draw.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.in_word, self.in_run = (_Powers(int(b) | 1) for b in draw.integers(1 << 60, 1 << 63, 2, dtype=np.uint64))

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        power, inverse = self.in_word.upto(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.bytes[data] * power[:-1], out=sums[1:])
        out = _mix((sums[ends] - sums[starts]) * inverse[starts])
        for i in np.flatnonzero(ends - starts > LONG_WORD):
            name = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8, salt=bytes([self.seed]))
            out[i] = int.from_bytes(name.digest(), "little")
        return out

    def runs(self, words: np.ndarray, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on that has so many."""
        power, inverse = self.in_run.upto(len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * power[:-1], out=sums[1:])
        return _mix((sums[length:] - sums[:-length]) * inverse[:len(words) - length + 1])


@lru_cache(maxsize=None)
def _family(seed: int) -> _Hash:
    return _Hash(seed)


class _Slice:
    """Words of some texts, and the places where a window starts."""

    def __init__(self, texts: list[bytes], window: int):
        self.data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        blank = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        edges = np.diff(np.concatenate([[True], blank]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        first = np.searchsorted(self.starts, begin)  # of the words of each text
        self.first = first[:-1]
        self.text = np.repeat(np.arange(len(texts)), np.diff(first))
        n = len(self.starts)
        self.windows = np.flatnonzero(np.arange(n) + window <= np.repeat(first[1:], np.diff(first)))

    def hashes(self, seed: int) -> np.ndarray:
        return _family(seed).words(self.data, self.starts, self.ends)


def _anchors(words: np.ndarray, windows: np.ndarray, window: int, run: int) -> np.ndarray:
    """The smallest hash of a run within each window."""
    low, width, runs = _family(1).runs(words, run), 1, window - run + 1
    while 2 * width <= runs:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    return _mix(np.minimum(low[windows], low[windows + runs - width]))  # smallest ones are not spread evenly


def _cells(anchors: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each anchor in every row of the sketch, numbered over all rows."""
    return [((_mix(anchors + np.uint64(row)) % np.uint64(cells)) + np.uint64(row * cells)).astype(np.int64)
            for row in range(DEPTH)]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Position of the first one, and about ``SLICE_BYTES`` of whole texts."""
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
    part, size, at = [], 0, 0
    for i, value in enumerate(column):
        text = value.as_py()
        if part and size + len(text) > SLICE_BYTES:
            yield at, part
            part, size, at = [], 0, i
        part.append(text)
        size += len(text)
    if part:
        yield at, part


def _sketch(window: int, run: int, cells: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _slices(batch):
                part = _Slice(texts, window)
                if not len(part.windows):
                    continue
                found = _anchors(part.hashes(1), part.windows, window, run)
                owner = part.text[part.windows]
                new = np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])
                found, owner = found[new], owner[new]
                order = np.lexsort((found, owner))  # a document counts once
                found, owner = found[order], owner[order]
                new = np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])
                touched, counts = np.unique(np.concatenate(_cells(found[new], cells)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(touched), pa.array(counts.astype(np.int64))], ["cell", "n"])
    return work


@dataclass(frozen=True)
class Sketch:
    """What the second pass needs: bits of the cells that have counted two or more documents, and the cells of hot windows."""

    repeated: np.ndarray
    hot: np.ndarray

    def passing(self, anchors: np.ndarray, cells: int, hot: bool) -> np.ndarray:
        out = np.ones(len(anchors), bool)
        for cell in _cells(anchors, cells):
            out &= np.isin(cell, self.hot) if hot else (
                (self.repeated[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1)
        return out


@dataclass(frozen=True)
class HotWindows:
    """Keys of hot windows, ordered by the first half, and their smallest documents."""

    k1: np.ndarray
    k2: np.ndarray
    owner: np.ndarray

    def owners(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the windows are hot, and the smallest document of each that is."""
        if not len(self.k1):
            return np.zeros(len(k1), bool), np.zeros(len(k1), np.int64)
        at = np.minimum(np.searchsorted(self.k1, k1), len(self.k1) - 1)
        return (self.k1[at] == k1) & (self.k2[at] == k2), self.owner[at]


def _candidates(sketch_sent: Broadcast, hot_sent: Broadcast | None, window: int, run: int, cells: int, want: str):
    """Rows of FOUND.  ``want``: windows in ``hot`` cells; of those estimated repeated the ``open`` ones, or the hot ones of
    later documents, ``decided``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, hot = sketch_sent.value, hot_sent and hot_sent.value
        for batch in batches:
            ids, marks = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("doc_id", "mark"))
            for at, texts in _slices(batch):
                part = _Slice(texts, window)
                if not len(part.windows):
                    continue
                words = part.hashes(1)
                anchors = _anchors(words, part.windows, window, run)
                windows = part.windows[sketch.passing(anchors, cells, want != "open")]
                if not len(windows):
                    continue
                text = part.text[windows]
                k1, k2 = (_family(s).runs(words if s == 1 else part.hashes(s), window)[windows].view(np.int64)
                          for s in (1, 2))
                columns = [ids[at + text], marks[at + text], (windows - part.first[text]).astype(np.int32), k1, k2]
                if want != "hot":
                    is_hot, owner = hot.owners(k1, k2)
                    take = ~is_hot if want == "open" else is_hot & (columns[0] > owner)
                    columns = [c[take] for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in FOUND.split(", ")])
    return work


def _kept(window: int):
    def work(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, places in batches:
            out = []
            for text, at in zip(texts, places):
                words, at = text.as_py().encode().split(), at.values
                total = len(words)
                if at is not None and len(at):
                    edge = np.zeros(total + 1, np.int64)
                    at = at.to_numpy()
                    np.add.at(edge, at, 1)
                    np.subtract.at(edge, at + window, 1)
                    words = list(compress(words, np.cumsum(edge[:-1]) == 0))
                out.append((total, total - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
            yield pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []),
                                                (pa.int64(), pa.int64(), pa.string()))],
                [c.split()[0] for c in RESULT.split(", ")])
    work.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(work, f"struct<{', '.join(c.replace(' ', ':') for c in RESULT.split(', '))}>").asNondeterministic()


def sketched(docs: DataFrame, often: int, window: int = WINDOW, run: int = RUN, cells: int = CELLS) -> Sketch:
    """The merged sketch; ``often``: count from which a cell is hot."""
    counted = docs.select("text").mapInArrow(_sketch(window, run, cells), "cell long, n long")
    several = counted.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").select(
        (F.col("cell") + 1).alias("c"), F.when(F.col("n") >= often, F.col("cell")).alias("hot"))
    bits, hot = _bits(several, DEPTH * cells, F.collect_list("hot"))
    return Sketch(bits, np.array(sorted(c for part in hot for c in part), np.int64))


def _bits(numbers: DataFrame, size: int, *more: Column) -> tuple[np.ndarray, list]:
    """The numbers ``c`` from 1 to ``size`` as bits, block by block, and what ``more`` gives for each block."""
    blocks = numbers.groupBy(F.bitmap_bucket_number("c").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("c")), *more)
    out, rest = np.zeros((-(-size // 32768), 4096), np.uint8), []
    for block, bits, *others in blocks.toLocalIterator():  # at most ``size`` bits
        out[block - 1] = np.frombuffer(bits, np.uint8)
        rest += others
    return out.ravel(), rest


def _row() -> Column:
    return F.xxhash64("doc_id", "mark")


def _in_bits(sent: Broadcast):
    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            at = batch.to_numpy(zero_copy_only=False)
            yield pa.array((sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)
    work.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(work, "boolean")


def repeated_windows(docs: DataFrame, window: int = WINDOW, run: int = RUN, cells: int = CELLS,
                     hot: int = HOT) -> DataFrame:
    """``(doc_id, mark, places)``: words from which a window starts that a smaller ``doc_id`` has too; a written table.

    ``docs``: doc_id, text and ``mark``, which tells rows of one id apart."""
    named = docs.where("doc_id is not null")
    often = max(HOT_LEAST, -(-named.count() // hot))
    sketch = sketched(named, often, window, run, cells)
    send = docs.sparkSession.sparkContext.broadcast
    sketch_sent = send(sketch)

    def found(want: str, hot_sent: Broadcast | None = None) -> DataFrame:
        return named.mapInArrow(_candidates(sketch_sent, hot_sent, window, run, cells, want), FOUND)

    rows = []
    if len(sketch.hot):
        rows = (found("hot").groupBy("k1", "k2").agg(F.min("doc_id"), F.count("*").alias("n"))
                .where(F.col("n") >= often).orderBy("k1", "k2").drop("n").collect())
    hot_sent = send(HotWindows(*np.array(rows, np.int64).reshape(-1, 3).T))
    there = found("open", hot_sent)
    owners = (there.groupBy("k1", "k2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
              .where("owner < last").drop("last"))
    out = there.join(owners, ["k1", "k2"]).where("doc_id > owner").select("doc_id", "mark", "at")
    if rows:
        out = out.union(found("decided", hot_sent).select("doc_id", "mark", "at"))
    out = checkpoint(out.groupBy("doc_id", "mark").agg(F.collect_set("at").alias("places")), cache=False)
    sketch_sent.unpersist()
    return out


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 run: int = RUN, cells: int = CELLS, hot: int = HOT) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row.

    Kept are the words outside all windows that start in a document with a smaller id too."""
    if not 0 < run <= window:
        raise ValueError("an anchor's run is a part of the window")
    docs = documents(df, id_col, text_col)
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    docs = docs.withColumn("mark", F.xxhash64("text") if again else F.lit(0).cast("long"))
    places = repeated_windows(docs, window, run, cells, hot)
    bits = docs.sparkSession.sparkContext.broadcast(_bits(
        places.select((F.pmod(_row(), F.lit(CHANGED)) + 1).alias("c")), CHANGED)[0])
    flagged = docs.withColumn("changed", _in_bits(bits)(F.pmod(_row(), F.lit(CHANGED))))
    none = F.array().cast("array<int>")
    # texts that lose nothing stay where they are
    same = flagged.where(~F.col("changed")).select("doc_id", _kept(window)("text", none).alias("r"))
    other = flagged.where("changed").join(places, ["doc_id", "mark"], "left").select(
        "doc_id", _kept(window)("text", F.coalesce("places", none)).alias("r"))
    return same.union(other).select("doc_id", "r.*")
