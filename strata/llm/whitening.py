"""Whitening of embeddings; the covariance comes from exact sums of squares (polarisation).

Entries become whole numbers ``floor(scale * c) + shift``.  With ``n`` vectors of sums ``S`` the centred
value of an entry is ``n * x - S``, a whole number too.  Tasks square it for every dimension, and its sum for every pair of
dimensions; as ``(a + b)^2 - a^2 - b^2 = 2ab``, differences of the sums of these squares are the cross-covariances, times
``2 n^3``.  All sums are exact (64-bit numbers within a block of rows, arbitrary ones within a task, decimals of 38
digits between tasks), so neither the shift nor the order of the rows leaves a trace, and each covariance is rounded
once.  The driver gets one number a pair of dimensions, whatever the number of vectors, and solves for the
eigenvectors.  Whitened rows are the centred whole numbers projected in double precision.

Four passes over the vectors: sums, squares, the check of the whitened rows' covariance, the result.  Nothing but
sums is shuffled, and no task holds more than a block of ``BLOCK_ROWS`` rows.

Defined cases: rows whose vector is null or has null or non-finite entries give no rows, likewise empty vectors and those
whose length is not the most frequent one (of equally frequent ones the greater); repeated rows count as often as they
stand there, a null id stays one; a component without variance has null ``whitened`` (with one vector: all), and is
left out of ``identity_error``, null if none has variance; equal eigenvalues are numbered as the solver gives
them; whole numbers beyond 52 bits, or a ``deviation`` beyond a long, raise; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows worked on at a time: so many squares below 2 ** 52 add up within 64 bits.
BLOCK_ROWS = 1024
#: Share of the largest eigenvalue below which a component has no variance.
NO_VARIANCE = 1e-12
#: Bits of the low part of a centred value whose square would not fit.
LOW = 26

SCORES = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, x)`` of the rows whose vector is whole and of the usual length."""
    vectors = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = vectors.where(F.col("x").isNotNull() & finite & (F.size("x") > 0))
    usual = whole.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return whole.where(F.size("x") == (usual[0] if usual else 0))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows and their whole numbers, a block at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            x = np.floor(SCALE * part.column(part.schema.get_field_index("x")).flatten().to_numpy(
                zero_copy_only=False).reshape(-1, width))
            if np.abs(x).max() >= 2.0 ** 52:
                raise OverflowError("an entry has more than 52 bits")
            yield part, x.astype(np.int64) + SHIFT


def _sums(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _blocks(batches, width):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width + 1)), pa.array(np.append(x.sum(axis=0), len(x)))], ["i", "s"])
    return work


def squared_sums(t: np.ndarray) -> list[int]:
    """The exact sum of squares of each column of at most ``BLOCK_ROWS`` rows below 2 ** 52."""
    if np.abs(t).max(initial=0) < 1 << LOW:
        return (t * t).sum(axis=0).tolist()
    high, low = t >> LOW, t & ((1 << LOW) - 1)
    parts = ((high * high).sum(axis=0), (high * low).sum(axis=0), (low * low).sum(axis=0))
    return [(h << 2 * LOW) + (m << LOW + 1) + v for h, m, v in zip(*(p.tolist() for p in parts))]


def _squares(n: int, sums: list[int]):
    """Sums of squares of every dimension ``(i, i)`` and of every sum of two ``(i, j)``."""
    width = len(sums)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * (width - i) for i in range(width)]
        for _, x in _blocks(batches, width):
            d = centred(x, n, sums)
            for i in range(width):
                t = d[:, i:] + d[:, i:i + 1]
                t[:, 0] = d[:, i]
                total[i] = [a + b for a, b in zip(total[i], squared_sums(t))]
        places = [(i, i + k, decimal.Decimal(v)) for i, row in enumerate(total) for k, v in enumerate(row)]
        for start in range(0, len(places), 10_000):
            i, j, v = zip(*places[start:start + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array(v, pa.decimal128(38, 0))], ["i", "j", "q"])
    return work


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` in whole numbers, computed from small ones: ``n * (x - m) - (S - n * m)``."""
    middle = [s // n for s in sums]
    rest = np.array([s - n * m for s, m in zip(sums, middle)], np.int64)
    x = x - np.array(middle, np.int64)
    if int(np.abs(x).max(initial=0)) * n >= 1 << 51:
        raise OverflowError("a centred value has more than 52 bits")
    return n * x - rest


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives; ``axes``: one unit eigenvector a row."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        trace = np.trace(self.covariance)
        return self.values / trace if trace > 0 else np.full(len(self.values), np.nan)

    @property
    def varying(self) -> np.ndarray:
        return self.values > NO_VARIANCE * max(self.values.max(initial=0.0), 0.0)

    def project(self, d: np.ndarray) -> np.ndarray:
        """Whitened rows of centred values; NaN where a component has no variance."""
        out = (d / self.n) @ self.axes.T
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.varying, out / np.sqrt(np.abs(self.values)), np.nan)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Exact sums, the covariance and its eigenvectors; None without vectors."""
    first = vectors.select(F.size("x")).first()
    if first is None:
        return None
    width = first[0]
    rows = vectors.select("x").mapInArrow(_sums(width), "i long, s long").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # one row a dimension
    found = {r["i"]: int(r["s"]) for r in rows}
    n, sums = found.pop(width), [found[i] for i in range(width)]
    squares = vectors.select("x").mapInArrow(_squares(n, sums), "i int, j int, q decimal(38,0)").groupBy("i", "j").agg(
        F.sum("q").cast("decimal(38,0)").alias("q"))
    q = {(r["i"], r["j"]): int(r["q"]) for r in squares.toLocalIterator()}  # one row a pair of dimensions
    cov = np.zeros((width, width))
    for (i, j), v in q.items():
        exact = Fraction(v, n ** 3) if i == j else Fraction(v - q[i, i] - q[j, j], 2 * n ** 3)
        cov[i, j] = cov[j, i] = float(exact)
    values, vectors_ = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    axes = vectors_[:, order].T
    largest = np.take_along_axis(axes, np.abs(axes).argmax(axis=1)[:, None], axis=1)
    return Whitening(n, sums, cov, values[order], axes * np.where(largest < 0, -1.0, 1.0))


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity.

    Rows are centred exactly before they are projected and multiplied."""
    at = np.flatnonzero(model.varying)
    if not len(at):
        return None
    rows, columns = np.triu_indices(len(at))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(at), len(at)))
        for _, x in _blocks(batches, len(model.sums)):
            w = model.project(centred(x, model.n, model.sums))[:, at]
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(columns), pa.array(total[rows, columns])],
                                         ["i", "j", "s"])

    sums = vectors.select("x").mapInArrow(work, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    one = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.lit(0.0))
    return sums.agg(F.max(F.abs(F.col("s") / model.n - one))).first()[0]


def _scores(model: Whitening):
    k = len(model.values)
    names = [c.split()[0] for c in SCORES.split(", ")]
    explained = np.where(np.isnan(model.explained), None, model.explained).tolist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, len(model.sums)):
            d = centred(x, model.n, model.sums)
            rows = np.repeat(np.arange(len(d)), k)
            ids = part.column(part.schema.get_field_index("vec_id"))
            squared = pa.array(squared_sums_of_rows(d), pa.int64())
            whitened = model.project(d).ravel()
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(d))),
                 pa.array(np.full(len(rows), model.n)), squared.take(pa.array(rows)),
                 pa.array(whitened, mask=np.isnan(whitened)), pa.array(explained * len(d), pa.float64())], names)
    return work


def squared_sums_of_rows(d: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    out = [0] * len(d)
    for start in range(0, d.shape[1], BLOCK_ROWS):
        out = [a + b for a, b in zip(out, squared_sums(d[:, start:start + BLOCK_ROWS].T))]
    if max(out, default=0) >= 1 << 63:
        raise OverflowError("a deviation is beyond a long")
    return out


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component."""
    vectors = usable(df, id_col, vector_col)
    model = fit(vectors, components)
    if model is None:
        none = df.sparkSession.createDataFrame([], SCORES)
        return none.withColumn("identity_error", F.lit(None).cast("double"))
    error = identity_error(vectors, model)
    return vectors.mapInArrow(_scores(model), SCORES).withColumn("identity_error", F.lit(error).cast("double"))
