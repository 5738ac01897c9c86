"""Aggregation building blocks of the analytic question set.

All of them aggregate first and join afterwards, so every join and every
"whole-table" reference (latest period, grand total) touches aggregated rows
only: a grand total or a latest period is a window over the rows of the aggregate, so
the source is read once.  Grouped aggregates combine map-side, which keeps a key
that holds a third of the rows cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(c) -> Column:
    """First day of the month as a date."""
    return F.trunc(_c(c).cast("date"), "month")


def safe_ratio(num, den, digits: int | None = None) -> Column:
    """Num / den, null when den is 0 or null."""
    r = F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))
    return F.round(r, digits) if digits is not None else r


def latest_period_rows(per_period: DataFrame, period_col: str) -> DataFrame:
    """E6 on a frame with one row per period: the latest period's row(s).

    The max is a window over the per-period rows - a calendar-bounded handful - so
    the source is scanned once instead of once more for a scalar subquery.
    """
    w = Window.partitionBy()
    return (per_period.withColumn("_max_period", F.max(period_col).over(w))
            .filter(F.col(period_col) == F.col("_max_period")).drop("_max_period"))


def trailing_period_rows(per_period: DataFrame, period_col: str, months: int = 12) -> DataFrame:
    """E7 on a frame with one row per period (see ``latest_period_rows``)."""
    w = Window.partitionBy()
    return (per_period.withColumn("_max_period", F.max(period_col).over(w))
            .filter(F.col(period_col) > F.add_months(F.col("_max_period"), -months))
            .drop("_max_period"))


def share_of_total(agg: DataFrame, value_col: str, out: str = "share",
                   digits: int | None = 4) -> DataFrame:
    """Each row's value over the sum of all rows (one row a group: read once)."""
    total = F.sum(value_col).over(Window.partitionBy())
    return agg.withColumn(out, safe_ratio(F.col(value_col), total, digits))


def year_over_year(agg: DataFrame, year_col: str, value_col: str,
                   keys: Sequence[str] = (), prev_col: str = "prev_value",
                   pct_col: str = "variation_pct", digits: int = 2) -> DataFrame:
    """Value beside the previous year's value and % change.

    ``agg`` has one row per (keys, year).  ``lag`` over the years of each key reads
    the input once (a self-join on ``year - 1`` would scan and shuffle it twice);
    a gap year gives a null previous value, exactly like that join.  Without keys
    the window holds one row per year - bounded by the calendar, not by the data.
    """
    w = Window.partitionBy(*keys).orderBy(year_col)
    prev = F.when(F.lag(year_col).over(w) == F.col(year_col) - 1, F.lag(value_col).over(w))
    j = agg.withColumn(prev_col, prev)
    pct = F.round(safe_ratio(F.col(value_col) - F.col(prev_col), F.col(prev_col)) * 100, digits)
    return j.withColumn(pct_col, pct)


def pivot_counts(df: DataFrame, group_cols: Sequence[str], pivot_col: str,
                 values: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Cross-tab with a known value list (no extra job to discover the values)."""
    names = list(names or values)
    aggs = [F.count(F.when(F.col(pivot_col) == v, 1)).alias(n) for v, n in zip(values, names)]
    return df.groupBy(*group_cols).agg(*aggs)


def metric_view(df: DataFrame, dims: Sequence[str], measures: Sequence[Column],
                filters: dict[str, object] | None = None) -> DataFrame:
    """Optional equality / IN filters (None = no filter), then grouped measures."""
    out = df
    for col, val in (filters or {}).items():
        if val is None:
            continue
        if isinstance(val, (list, tuple, set)):
            out = out.filter(F.col(col).isin(*val))
        else:
            out = out.filter(F.col(col) == F.lit(val))
    return out.groupBy(*dims).agg(*measures)


def compare_sides(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  num: str, den: str, out: str = "ratio", digits: int = 4) -> DataFrame:
    """Two aggregated sides full-outer-joined on keys, then a guarded ratio."""
    j = left.join(right, list(keys), "full_outer")
    return j.withColumn(out, safe_ratio(F.col(num), F.col(den), digits))
