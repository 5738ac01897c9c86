"""Declarative rule lists -> CASE chains (C8), typed union alignment (C10, F5), marts.

A rule list is data: ``[(predicate_sql, result_sql), ...]`` plus a default.  The
first matching rule wins, as in SQL ``CASE``.  Predicates use Spark SQL syntax
(``LIKE`` with ``%``/``_`` wildcards kept verbatim, ``IN``, ``BETWEEN``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RuleList = Sequence[tuple[str, str]]


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def classify(rules: RuleList, default: str | None = "NULL") -> Column:
    """CASE WHEN p1 THEN r1 ... ELSE default END as a Column."""
    expr = None
    for pred, res in rules:
        expr = F.when(F.expr(pred), F.expr(res)) if expr is None else \
            expr.when(F.expr(pred), F.expr(res))
    dflt = F.expr(default) if default is not None else F.lit(None)
    return dflt if expr is None else expr.otherwise(dflt)


def classify_sql(rules: RuleList, default: str | None = "NULL") -> str:
    """The same rule list as SQL text (for oracles and documentation)."""
    if not rules:
        return default or "NULL"
    body = " ".join(f"WHEN {p} THEN {r}" for p, r in rules)
    return f"CASE {body} ELSE {default or 'NULL'} END"


def align(df: DataFrame, schema: Sequence[tuple[str, str]],
          exprs: Mapping[str, Column | str]) -> DataFrame:
    """Project ``df`` onto ``schema``; columns without an expression become typed nulls."""
    cols = []
    for name, typ in schema:
        e = exprs.get(name)
        if e is None:
            cols.append(F.lit(None).cast(typ).alias(name))
        else:
            c = F.expr(e) if isinstance(e, str) else e
            cols.append(c.cast(typ).alias(name))
    return df.select(*cols)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name of already aligned frames (no shuffle)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def mart(df: DataFrame, where: str | Column | None,
         columns: Sequence[tuple[str, Column | str]]) -> DataFrame:
    """One filter and one projection; no aggregation, one row per input row."""
    out = df if where is None else df.filter(F.expr(where) if isinstance(where, str) else where)
    return out.select(*[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in columns])
