"""Keyword search over a news-like table, plus its SQL table-function form.

``search(df, term, source)`` keeps rows whose title or summary contains ``term``
(``ILIKE``; wildcards typed by the user stay active, as in the
original function) and whose source contains ``source``; either argument may be
None, which drops that predicate (C12).  Newest first, top ``limit`` rows - the
limit is the feature here, and Spark plans it as a TakeOrderedAndProject (a
per-partition top-k, then a merge of k rows per partition).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def predicate(term: str, source: str, text_cols: Sequence[str], source_col: str) -> str:
    """C11/C12 as SQL over two SQL operands: a null operand drops its condition."""
    def within(column: str, operand: str) -> str:
        return f"{column} ILIKE '%' || {operand} || '%'"
    texts = [within(c, term) for c in text_cols]
    wanted = [f"coalesce({' OR '.join(texts)}, {term} IS NULL)", f"coalesce({within(source_col, source)}, {source} IS NULL)"]
    return " AND ".join(wanted)


def _literal(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def search(df: DataFrame, term: str | None = None, source: str | None = None, *,
           text_cols: Sequence[str] = ("title", "summary"), source_col: str = "source",
           order_by: Sequence[Column] | None = None, limit: int = 10) -> DataFrame:
    """H12 as a DataFrame call; give ``order_by`` a unique last column, so that ties are broken."""
    out = df.filter(F.expr(predicate(_literal(term), _literal(source), text_cols, source_col)))
    if order_by:
        out = out.orderBy(*order_by)
    return out.limit(limit) if limit else out


def register_search_function(spark: SparkSession, name: str, table: str, columns: Mapping[str, str],
                             text_cols: Sequence[str], source_col: str, order_by: str,
                             limit: int = 10, temporary: bool = True) -> None:
    """The same search as a SQL table function ``name(term [, src])``.

    ``columns``: result columns and their types.  ``temporary=False`` keeps the function in the catalog
    beyond the session; ``table`` must be a catalog table then.
    """
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    result = ", ".join(f"{column} {typ}" for column, typ in columns.items())
    query = (f"SELECT {', '.join(columns)} FROM {table} WHERE {predicate('term', 'src', text_cols, source_col)} "
             f"ORDER BY {order_by} LIMIT {int(limit)}")
    spark.sql(f"CREATE OR REPLACE {kind} {name}(term STRING, src STRING DEFAULT NULL) "
              f"RETURNS TABLE ({result}) RETURN {query}")
