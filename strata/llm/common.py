"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from strata.session import checkpoint

#: Characters handed to numpy at a time; whole texts, a longer one goes alone.
SLICE_CHARS = 250_000


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive whole texts of about ``limit`` characters together."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def texts_of(column: pa.Array) -> list[str]:
    """Whole texts of an Arrow column; null is an empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def text_udf(make: Callable[[], Callable[[pa.Array], pa.Array]], schema: str | DataType):
    """An Arrow UDF over one text column.  ``make`` builds the worker's scorer once a task.

    Not deterministic for the optimizer, so that no filter makes it run twice."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            yield work(batch)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema).asNondeterministic()


def with_row(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows; checkpoint the result before the numbers meet another plan."""
    return df.withColumn(name, F.monotonically_increasing_id())


def boxed(df: DataFrame) -> Column:
    """All columns of a frame as one struct, so that none can clash with columns beside it; ``doc.*`` unpacks it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` alone, so that no other column's name can clash; null text is empty."""
    return df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


__all__ = ["SLICE_CHARS", "boxed", "checkpoint", "documents", "slices", "table", "text_udf", "texts_of",
           "tokenizer_file", "with_row"]
