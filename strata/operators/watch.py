"""Counts taken while a table is written, so that no check reads it again.

``Watch`` hangs conditional sums on the frame that is written (``DataFrame.observe``); they are known when the write
has ended.  Hang them on rows that are read once: behind a range partitioning, whose sampling would count the rows in
front of it twice.  A task that runs again after an executor was lost may be counted again, so these are figures for
reports, not for decisions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.quality import DomainRule


class Watch:
    """Numbers of rows that meet each of some conditions."""

    def __init__(self, conditions: Mapping[str, Column]):
        self.conditions = dict(conditions)
        self.seen: Observation | None = None

    def over(self, df: DataFrame) -> DataFrame:
        if not self.conditions:
            return df
        self.seen = Observation()
        return df.observe(self.seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}")
                                       for i, c in enumerate(self.conditions.values())])

    @property
    def counts(self) -> dict[str, int]:
        """Of the write that has ended; waits for it."""
        found = self.seen.get if self.seen else {}
        return {name: int(found.get(f"c{i}") or 0) for i, name in enumerate(self.conditions)}


def lost(checks: Mapping[str, tuple[Column, Column]]) -> dict[str, Column]:
    """Conditions for values that are there, neither null nor blank, and whose parsed form is null."""
    return {name: raw.isNotNull() & (F.trim(raw.cast("string")) != "") & parsed.isNull()
            for name, (raw, parsed) in checks.items()}


def outside(rules: Sequence[DomainRule]) -> dict[str, Column]:
    """Conditions for rows outside a rule's domain; null counts as outside."""
    return {r.name: ~F.coalesce(r.ok, F.lit(False)) for r in rules}
