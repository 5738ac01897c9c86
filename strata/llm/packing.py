"""Packing of token ids into sequences by reciprocal classes (harmonic packing).

A piece of ``length`` ids belongs to class ``k = capacity // length``: ``k`` such pieces
always fit into one sequence, so that a class fills its sequences with ``k`` pieces each,
without looking at any other piece.  Every worker numbers the pieces of a class as it
cuts them; a small table of counts per (class, worker) turns these numbers into places
of the whole class.  Of each class only the last, unfinished sequence is left.  These
leftovers (fewer than ``k`` pieces a class, under 10,000 pieces in all whatever the
input) are put together by decreasing size.

Little padding: documents may be cut.  A document gives whole sequences first; its rest
is cut at ``capacity // (k + 1)`` ids while its class would waste more than ``waste``
of a sequence, so that nearly every piece has nearly the size of its class.

Defined cases: a null or empty text is the closing id alone; repeated rows and repeated or null
``doc_id`` are packed like any others; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, documents
from strata.llm.wordbpe import default_path, encoder

CAPACITY = 2048
CLOSING_ID = 1
#: Share of a sequence that a class may waste before its piece is cut again.
WASTE = 1 / 64

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "worker int, class int, place long")
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@lru_cache(maxsize=None)
def cuts(rest: int, capacity: int, waste: float) -> tuple[int, ...]:
    """Lengths of the pieces of a rest shorter than a sequence."""
    if rest == 0:
        return ()
    k = capacity // rest
    if capacity - k * rest <= waste * capacity:
        return (rest,)
    first = capacity // (k + 1)
    return (first, *cuts(rest - first, capacity, waste))


def lengths(tokens: int, capacity: int = CAPACITY, waste: float = WASTE) -> list[int]:
    """Lengths of all pieces of a document."""
    return [capacity] * (tokens // capacity) + list(cuts(tokens % capacity, capacity, waste))


def _pieces(path: str, capacity: int, waste: float):
    closing = CLOSING_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        tok = encoder(path)
        seen: dict[int, int] = {}
        for batch in batches:
            names = iter(batch.column(0).to_pylist())
            out: list[list] = [[] for _ in range(8)]
            for ids, bounds in tok.encode(batch.column(1)):
                for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    data, doc_id = ids[low:high].tobytes() + closing, next(names)
                    tokens, start = high - low + 1, 0
                    for n in lengths(tokens, capacity, waste):
                        k = capacity // n
                        place = seen.get(k, 0)
                        seen[k] = place + 1
                        row = (doc_id, start, n, zlib.crc32(data[4 * start:4 * (start + n)]), tokens,
                               worker, k, place)
                        for column, value in zip(out, row):
                            column.append(value)
                        start += n
            types = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)],
                                             [c.split()[0] for c in PIECES.split(", ")])
    return run


def _leftovers(capacity: int):
    """Place the leftovers of all classes by decreasing length, first fit."""

    def run(table: pa.Table) -> pa.Table:
        order = sorted(range(table.num_rows), key=lambda i: (
            -table["length"][i].as_py(), table["class"][i].as_py(), table["rank"][i].as_py()))
        sizes = table["length"].to_pylist()
        free: list[int] = []
        sequence, offset = [0] * len(sizes), [0] * len(sizes)
        for i in order:
            at = next((b for b, room in enumerate(free) if room >= sizes[i]), len(free))
            if at == len(free):
                free.append(capacity)
            sequence[i], offset[i] = at, capacity - free[at]
            free[at] -= sizes[i]
        keep = table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "base"])
        return (keep.append_column("sequence", pa.array(sequence, pa.int64()))
                    .append_column("offset", pa.array(offset, pa.int64())))
    return run


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, waste: float = WASTE) -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    path = tokenizer or default_path()
    cut = documents(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    # the numbering of a worker must be the one that its counts are of: write it once
    pieces = checkpoint(cut.mapInArrow(_pieces(path, capacity, waste), PIECES), cache=False)

    counts = pieces.groupBy("class", "worker").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("class")
    counts = counts.select("class", "worker", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"),
                           F.sum("n").over(whole).alias("total"))
    # at most one row a class: 90 classes for 2,048 ids
    sums = pieces.groupBy("class").agg(F.count("*").alias("n"))
    ahead = Window.orderBy(F.col("class")).rowsBetween(Window.unboundedPreceding, -1)
    bins = F.floor(F.col("n") / F.col("class"))
    base = sums.select("class", F.coalesce(F.sum(bins).over(ahead), F.lit(0)).alias("base"))
    end = sums.agg(F.coalesce(F.sum(bins), F.lit(0)).alias("base"))

    ranked = (pieces.join(counts, ["class", "worker"])
              .withColumn("rank", F.col("ahead") + F.col("place"))
              .withColumn("full", F.floor(F.col("total") / F.col("class")) * F.col("class")))
    in_order = (Window.partitionBy("sequence_id").orderBy("rank")
                .rowsBetween(Window.unboundedPreceding, -1))
    filled = (ranked.where("rank < full").join(F.broadcast(base), "class")
              .withColumn("sequence_id", (F.col("base") + F.floor(F.col("rank") / F.col("class"))).cast("long"))
              .withColumn("offset", F.coalesce(F.sum("length").over(in_order), F.lit(0)).cast("long"))
              .select(*COLUMNS))
    left = (ranked.where("rank >= full").crossJoin(F.broadcast(end))  # one row
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "rank", "base"))
    left = left.groupBy(F.lit(0).alias("all")).applyInArrow(
        _leftovers(capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                              "base long, sequence long, offset long")
    left = left.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                       (F.col("base") + F.col("sequence")).cast("long").alias("sequence_id"), "offset")
    return filled.unionByName(left)
