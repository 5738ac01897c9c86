"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprint: 64 bits over the 3-word shingles of the whole text, repeats counted.

Search: the fingerprint falls into three segments of at most 22 bits.  Two fingerprints
that differ in at most two bits agree in at least one segment and differ in at most two
bits in the next one.  The next segment is read as a 23-bit word of the perfect binary
Golay code: every word within four bits of a codeword gets that codeword's 12-bit index.
A word has one or six such indices, and two words that differ in at most two bits share
one (the codeword nearest to a word between them is within four bits of both).  A key is
(segment number, exact segment, index): three to eighteen keys a fingerprint.

Join: only distinct fingerprints take part.  Keys with few fingerprints are compared pair
by pair.  Fingerprints of a crowded key go another exact way with work in proportion to
their number: two words differ in at most two bits if and only if some word is within one
bit of both, so each gives the 65 words around it, and those that share one are linked;
no word has more than 65.  Links become components in ``components``.

Defined cases: a null, empty or blank text has fingerprint zero, linked like any other; repeated
rows give repeated rows; a null ``doc_id`` counts for no ``component_id`` (null if the whole component
has none); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import boxed, checkpoint, documents, text_udf, texts_of
from strata.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Low bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Keys with more fingerprints than this take the second way.
CROWDED = 48

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = (np.arange(8) * 256)[None, :]


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and blanks alone
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    first = (end - size)[:n].tolist()
    last = end[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(first, last)), dtype="<u8", count=n)
    ones = np.zeros((8, 256), dtype=np.int64)
    for part in range(0, n, 1 << 17):
        cells = hashes[part:part + (1 << 17)].view(np.uint8).reshape(-1, 8) + _COLUMN
        ones += np.bincount(cells.ravel(), minlength=2048).reshape(8, 256)
    bits = (ones @ _BITS).ravel() * 2 > n
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(shingle: int = SHINGLE):
    """Column function: text to fingerprint (long, the 64 bits as they are)."""

    def make():
        def work(batch: pa.Array) -> pa.Array:
            got = [fingerprint(t, shingle) for t in texts_of(batch)]
            return pa.array(np.array(got, dtype=np.uint64).view(np.int64))
        return work
    return text_udf(make, "long")


class Golay:
    """The perfect binary Golay code of 23 bits, by its generator polynomial."""

    GENERATOR = 0b101011100011
    SIZE, CHECK = 23, 11

    def __init__(self) -> None:
        self.of_high = np.array([self._remainder(m << self.CHECK) for m in range(1 << 12)], dtype=np.int64)
        patterns: list[list[int]] = [[] for _ in range(1 << self.CHECK)]
        for weight in range(5):
            for bits in itertools.combinations(range(self.SIZE), weight):
                word = sum(1 << b for b in bits)
                patterns[self._remainder(word)].append(word)
        # one error pattern of up to three bits each; beside those of three, five of four bits
        self.errors = np.array([(p + p[:1] * 6)[:6] for p in patterns], dtype=np.int64)

    def _remainder(self, word: int) -> int:
        for bit in range(self.SIZE - 1, self.CHECK - 1, -1):
            if word >> bit & 1:
                word ^= self.GENERATOR << (bit - self.CHECK)
        return word

    def indices(self, words: np.ndarray) -> np.ndarray:
        """(n, 6): indices of the codewords within four bits; a lone one is repeated."""
        syndrome = self.of_high[words >> self.CHECK] ^ (words & (1 << self.CHECK) - 1)
        return (words[:, None] ^ self.errors[syndrome]) >> self.CHECK


_golay: list[Golay] = []


def keys(prints: np.ndarray) -> np.ndarray:
    """(n, 18) search keys of fingerprints (uint64); repeats of a key fill up a row."""
    if not _golay:
        _golay.append(Golay())
    segment = [((prints >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
               for low, width in SEGMENTS]
    out = []
    for i, exact in enumerate(segment):
        near = _golay[0].indices(segment[(i + 1) % 3])
        out.append((i << 34) | (exact[:, None] << 12) | near)
    return np.concatenate(out, axis=1)


def _key_rows(batches):
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 1 << 15):
            part = prints[at:at + (1 << 15)]
            k = np.sort(keys(part.view(np.uint64)), axis=1)
            new = np.ones(k.shape, dtype=bool)
            new[:, 1:] = k[:, 1:] != k[:, :-1]
            yield pa.RecordBatch.from_arrays([pa.array(k[new]), pa.array(np.repeat(part, new.sum(axis=1)))],
                                             ["key", "fp"])


def _around(batches):
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 1 << 13):
            part = prints[at:at + (1 << 13)]
            words = (part.view(np.uint64)[:, None] ^ flips).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.repeat(part, 65))], ["word", "fp"])


def _close_pairs(distance: int):
    """Links of one key's fingerprints (at most ``CROWDED``)."""

    def run(batches):
        for batch in batches:
            a, b = [], []
            groups = batch.column(0)
            values = groups.values.to_numpy(zero_copy_only=False)
            bounds = groups.offsets.to_numpy()
            for low, high in zip(bounds[:-1], bounds[1:]):
                part = values[low:high]
                if len(part) == 2:
                    if (int(part[0]) ^ int(part[1])).__and__((1 << 64) - 1).bit_count() <= distance:
                        a.append(int(part[0]))
                        b.append(int(part[1]))
                    continue
                word = part.view(np.uint64)
                x, y = np.nonzero(np.triu(np.bitwise_count(word[:, None] ^ word[None, :]) <= distance, 1))
                a += part[x].tolist()
                b += part[y].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])
    return run


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints (column ``fp``) that hold every pair within
    ``distance`` (at most two) bits together, and none that is farther apart."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("three segments and Golay indices bear at most two differing bits")
    keyed = prints.mapInArrow(_key_rows, "key long, fp long")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = checkpoint(keyed.join(shared, "key"), cache=False)
    few = (rows.where(F.col("n") <= CROWDED).groupBy("key").agg(F.collect_list("fp").alias("fps"))
           .select("fps").mapInArrow(_close_pairs(distance), "u long, v long"))
    many = rows.where(F.col("n") > CROWDED).select("fp").distinct()
    if distance < DISTANCE:
        around = _narrow(many, distance)
    else:
        around = many.mapInArrow(_around, "word long, fp long")
    met = around.groupBy("word").agg(F.collect_list("fp").alias("fps"), F.min("fp").alias("v")).where("size(fps) > 1")
    return few.union(met.select(F.explode("fps").alias("u"), "v").where("u <> v"))


def _narrow(many: DataFrame, distance: int) -> DataFrame:
    """At distance one, words meet along one edge of the cube: both ends give the edge's name."""
    if distance == 0:
        return many.select(F.col("fp").alias("word"), "fp")
    split = many.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    cleared = F.expr("fp & ~shiftleft(1L, bit)")
    return split.select(F.struct(cleared.alias("rest"), "bit").alias("word"), "fp")


def simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            distance: int = DISTANCE) -> DataFrame:
    """One row a document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``."""
    docs = documents(df, id_col, text_col).select("doc_id", fingerprints(shingle)("text").alias("fp"))
    return classes(checkpoint(docs, cache=False), distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _roots(prints: DataFrame, distance: int) -> DataFrame:
    """``fp, root`` for the distinct fingerprints that are linked to another."""
    found = components(links(prints, distance))
    return checkpoint(found.select(F.col("node").alias("fp"), "root"), cache=False)


def classes(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Adds ``component_id`` to rows with ``doc_id`` and ``fp``."""
    first = checkpoint(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), cache=False)
    member = _roots(first.select("fp"), distance).join(first, "fp")
    lowest = member.groupBy("root").agg(F.min("first").alias("lowest"))
    linked = member.join(lowest, "root").select(F.col("fp").alias("own"), "lowest")
    named = first.join(linked, F.col("fp") == F.col("own"), "left").select(
        "fp", F.coalesce("lowest", "first").alias("component_id"))
    return docs.join(named, "fp")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 distance: int = DISTANCE) -> DataFrame:
    """The same columns; of each component only the row with the smallest ``doc_id`` (nulls last), of rows
    that share it the first one.

    Rows are numbered in the order in which ``df`` gives them: it must be a table, or a frame that
    gives the same rows in the same order whenever it is read."""
    numbered = df.select(boxed(df).alias("doc"), F.monotonically_increasing_id().alias("row"))
    text = F.col("doc").getField(text_col)
    rows = checkpoint(numbered.select(
        "row", F.col("doc").getField(id_col).alias("doc_id"),
        fingerprints(shingle)(F.coalesce(text, F.lit(""))).alias("fp")), cache=False)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = checkpoint(rows.groupBy("fp").agg(F.min(place).alias("place")), cache=False)
    roots = _roots(first.select("fp"), distance)
    stay = first.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min("place").alias("place")).select(F.col("place.row").alias("row"))
    return numbered.join(stay, "row", "left_semi").select("doc.*")
