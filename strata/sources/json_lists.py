"""A1/A2: the elements of one large JSON list, read by many tasks.

A JSON document has no line ends to split at, so Spark's JSON reader gives a file to one task.  Here it is read as text
records that end at a comma, whatever that is part of, as some comma stands between any two elements: Spark's text source
splits such a file into byte ranges as any other, and ``_metadata.file_block_start`` orders the ranges.  Whether a range starts within a string, and how deep, follows from
those before it, in three passes over the text, each one row a range or less at the driver:

1. every range counts its quotes and its opening and closing brackets, once for each of the two possible starts;
2. for a list under a key: every range tells whether the list opened or closed in it last;
3. every range gives the whole elements it holds, and the pieces of those that cross its ends.  Pieces are joined by
   one small shuffle.

Only places outside strings at the list's own depth separate elements; their text is given as it stands.

Defined cases: an empty list gives no rows; blank elements (``[1,,2]``), text around an array, a file without the
key, and documents that end within a string or bracket raise; an element of any length is kept whole; damage within an
element shows when it is parsed; a file without a comma is one record; a comma after the document raises.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import checkpoint

SEPARATOR = ","
_ESCAPE = re.compile(r"\\.", re.S)
_TOKEN = re.compile(r'\\.|["\[\]{},]', re.S)
PIECES = "file string, block long, seq long, kind string, opens boolean, closes boolean, text string"
COUNTS = "file string, block long, odd long, outside long, inside long, bytes long, ends long, bare long, size long"
#: Kinds of pieces: a whole element, the end of one, what neither starts nor ends here, the start of one.
WHOLE, END, MIDDLE, START = "whole", "end", "middle", "start"


def _records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", SEPARATOR).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str]]:
    """``(file, block, size of the file, text)`` of the records of a batch that belong to one range, with their separators."""
    for batch in batches:
        values, files, blocks, sizes = batch.columns
        n = max(0, len(values) - 1)
        other = pc.or_(pc.not_equal(files.slice(1), files.slice(0, n)), pc.not_equal(blocks.slice(1), blocks.slice(0, n)))
        cuts = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), len(values)]
        for start, stop in zip(cuts, cuts[1:]):
            if start < stop:
                part = pa.ListArray.from_arrays([0, stop - start], values.slice(start, stop - start))
                yield *(c[start].as_py() for c in (files, blocks, sizes)), pc.binary_join(part, SEPARATOR)[0].as_py() + SEPARATOR


def _balance(segments: list[str]) -> int:
    text = "".join(segments)
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: whether its quotes are odd, its depth if it starts outside or inside a string, its bytes, and
    the separators at its end (all of it if ``bare``)."""
    found: dict[tuple, list[int]] = {}
    for file, block, whole, text in _ranges(batches):
        parts = _ESCAPE.sub("", text).split('"')
        odd, outside, inside, size, ends, bare, _ = found.get((file, block), [0, 0, 0, 0, 0, 1, 0])
        depth = [outside, inside]
        for start in (0, 1):  # the batch starts inside if the range does, or an odd number of quotes came before
            depth[start] += _balance(parts[start ^ odd::2])
        kept = text.rstrip(SEPARATOR + " \t\r\n")
        more = text.count(SEPARATOR, len(kept))
        found[file, block] = [odd ^ (len(parts) - 1) % 2, *depth, size + len(text.encode()), more if kept else ends + more,
                              int(bare and not kept), whole]
    rows = [(*at, *state) for at, state in found.items()]
    columns = list(zip(*rows)) if rows else [()] * 9
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(columns)],
                                     [c.split()[0] for c in COUNTS.split(", ")])


@dataclass
class _Scan:
    """Walks through a range; ``quoted``, ``depth`` and ``listed`` say where it starts."""

    key: str | None
    quoted: bool
    depth: int
    listed: bool = False
    first: bool = False  # the range is its file's first one
    event: str | None = None  # what the list did last
    opened: int = 0
    seq: int = 0
    open_piece: str = MIDDLE
    opens: bool = False
    parts: list[str] = field(default_factory=list)

    @property
    def level(self) -> int:
        return 1 if self.key is None else 2

    def _starts_list(self, text: str, at: int) -> bool:
        if self.depth != self.level:
            return False
        if self.key is None:
            return True
        before = text[:at].rstrip()
        return before.endswith(":") and before[:-1].rstrip().endswith(f'"{self.key}"')

    def walk(self, text: str) -> Iterator[tuple[int, str, bool, bool, str]]:
        """Pieces ``(seq, kind, opens, closes, text)`` that end in this text."""
        start = 0
        for m in _TOKEN.finditer(text):
            c = m.group()
            if c == '"':
                self.quoted = not self.quoted
            elif self.quoted or len(c) > 1:
                continue
            elif c in "[{":
                self.depth += 1
                if c == "[" and not self.listed and self._starts_list(text, m.start()):
                    if self.key is None and (text[start:m.start()].strip() or not self.first or self.opened):
                        raise ValueError("text before a JSON array")
                    self.listed, self.event, self.open_piece, self.opens = True, "open", START, True
                    self.opened, start = self.opened + 1, m.end()
            elif c == ",":
                if self.listed and self.depth == self.level:
                    yield self._piece(text[start:m.start()], closes=False)
                    self.open_piece, self.opens, start = START, False, m.end()
            else:
                self.depth -= 1
                if self.depth == self.level - 1 and (c == "]" or self.key is not None):
                    if self.listed:
                        yield self._piece(text[start:m.start()], closes=True)
                        start = m.end()
                    self.listed, self.event = False, "close"
        if self.listed:
            self.parts.append(text[start:])
        elif self.key is None and text[start:].strip() not in ("", SEPARATOR):
            raise ValueError("text outside a JSON array")

    def _piece(self, text: str, closes: bool) -> tuple[int, str, bool, bool, str]:
        kind = WHOLE if self.open_piece == START else END
        out = (self.seq, kind, self.opens, closes, "".join([*self.parts, text]))
        self.parts, self.seq = [], self.seq + 1
        return out

    def rest(self) -> list[tuple[int, str, bool, bool, str]]:
        return [(self.seq, self.open_piece, self.opens, False, "".join(self.parts))] if self.listed else []


def _scans(batches: Iterator[pa.RecordBatch], starts: dict, key: str | None):
    """Ranges one after the other, as ``(file, block, scan, text)``; no text at the end of a range."""
    last = None
    for file, block, _, text in _ranges(batches):
        if last is None or last[:2] != (file, block):
            if last is not None:
                yield *last, None
            last = (file, block, _Scan(key, *starts[file, block]))
        yield *last, text
    if last is not None:
        yield *last, None


def _events(starts: dict, key: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for file, block, scan, text in _scans(batches, starts, key):
            if text is None:
                rows.append((file, block, scan.event, scan.opened))
            else:
                for _ in scan.walk(text):
                    scan.parts.clear()
                scan.parts.clear()
        columns = list(zip(*rows)) if rows else [()] * 4
        types = (pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         ["file", "block", "event", "opened"])
    return work


def _pieces(starts: dict, key: str | None):
    names = [c.split()[0] for c in PIECES.split(", ")]
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.string())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, scan, text in _scans(batches, starts, key):
            rows = [(file, block, *p) for p in (scan.rest() if text is None else scan.walk(text))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    return work


def _starts(records: DataFrame, key: str | None) -> dict[tuple, tuple]:
    """Where each range starts: within a string, how deep, within the list, and whether it is its file's first one."""
    starts, quoted, depth, before, read, after = {}, 0, 0, None, 0, 0
    ranges = records.mapInArrow(_count, COUNTS).orderBy("file", "block").collect()  # one row a range of bytes
    for i, (file, block, odd, outside, inside, size, ends, bare, whole) in enumerate(ranges):
        if file != before:
            quoted, depth, read, after = 0, 0, 0, 0
        starts[file, block] = (bool(quoted), depth, False, file != before)
        depth += inside if quoted else outside
        quoted, before, read, after = quoted ^ odd, file, read + size, after + ends if bare else ends
        # one separator more than the file has stands after its last record, unless the file ends with one (a byte
        # order mark, 3 bytes, is not read)
        if (i + 1 == len(ranges) or ranges[i + 1][0] != file) and (
                quoted or depth or after != 1 or read - whole in (0, -3)):
            raise ValueError(f"not a whole JSON document: {file}")
    if key is None:
        return {at: (q, d, d > 0, first) for at, (q, d, _, first) in starts.items()}
    listed, opened = False, {}
    events = records.mapInArrow(_events(starts, key), "file string, block long, event string, opened long")
    for file, block, event, n in events.orderBy("file", "block").collect():
        quoted, depth, _, first = starts[file, block]
        listed = listed and not first
        starts[file, block] = (quoted, depth, listed, first)
        listed = event == "open" if event else listed
        opened[file] = opened.get(file, 0) + n
    for file, n in opened.items():
        if n != 1:
            raise KeyError(f"document at {file} has {'no' if not n else 'more than one'} '{key}' list")
    return starts


def json_elements(spark: SparkSession, path: str, list_key: str | None = None) -> DataFrame:
    """``(item, file, block, seq)``: the text of every element of the arrays at ``path`` (files or a glob), or of the
    lists under ``list_key`` of the objects there; ``file, block, seq`` give their order."""
    records = _records(spark, path)
    pieces = checkpoint(records.mapInArrow(_pieces(_starts(records, list_key), list_key), PIECES), cache=False)
    order = Window.partitionBy("file").orderBy("block", "seq")  # at most two pieces a range
    begun = F.sum((F.col("kind") == START).cast("int")).over(order)
    crossing = pieces.where(F.col("kind") != WHOLE).withColumn("element", begun)
    joined = crossing.groupBy("file", "element").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("parts"), F.min(F.struct("block", "seq")).alias("at"),
        F.bool_or("opens").alias("opens"), F.bool_or("closes").alias("closes")).select(
        "file", "opens", "closes", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), "at.*")
    items = pieces.where(F.col("kind") == WHOLE).select("file", "opens", "closes", "text", "block", "seq").union(joined)
    blank = F.length(F.regexp_replace("text", r"^\s+", "")) == 0
    checked = F.when(blank, F.raise_error(F.concat(F.lit("blank element in "), F.col("file"))).cast("string"))
    items = items.where(~(blank & F.col("opens") & F.col("closes")))
    return items.select(F.coalesce(checked, F.col("text")).alias("item"), "file", "block", "seq")
