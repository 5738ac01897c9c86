"""Allowed-domain checks, re-aimed from the column documentation.

All rules of one table are evaluated in a single aggregate pass (one scan, one
partial aggregate per map task), then turned into one row per rule with
``stack`` - no per-rule job, nothing collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DomainRule:
    """``sql`` is the predicate that holds when the value is inside the domain."""

    table: str
    name: str
    sql: str

    @property
    def ok(self) -> Column:
        return F.expr(self.sql)


def domain_report(df: DataFrame, rules: Sequence[DomainRule]) -> DataFrame:
    """One row per rule: table_name, rule, n_violations, n_rows (null counts as bad)."""
    aggs = [F.sum(F.when(F.coalesce(r.ok, F.lit(False)), 0).otherwise(1)).cast("bigint")
             .alias(f"_v{i}") for i, r in enumerate(rules)]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    pairs = ", ".join(f"'{r.table}', '{r.name}', _v{i}" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {pairs}) AS (table_name, rule, n_violations)",
                           "n_rows")


def domain_flags(df: DataFrame, rules: Sequence[DomainRule], col: str = "violations") -> DataFrame:
    """Row-level variant: the names of the rules each row breaks (empty when clean)."""
    names = F.array(*[F.when(~F.coalesce(r.ok, F.lit(False)), F.lit(r.name)) for r in rules])
    return df.withColumn(col, F.filter(names, lambda x: x.isNotNull()))
