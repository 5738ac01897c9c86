"""Explicit handling of hot join keys (a key may hold a third of all rows).

``hot_keys`` finds the keys that hold more than a share of the rows, with one partial
aggregate; there are at most ``1 / share`` of them by arithmetic, so they travel as a literal
map.  ``salted_join`` deals the big side's rows of such a key into as many buckets as the key
has shares, and repeats only the matching rows of the other side, once a bucket.  Other keys
join as usual (bucket 0).  AQE's skew-join split stays on as a second line.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> dict:
    """Keys that hold more than ``share`` of the rows, each with its number of buckets: its rows
    in units of ``share``.  The total is summed up while the largest keys are looked for, in the same job."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    seen = Observation()
    largest = counts.observe(seen, F.sum("_n").alias("total")).orderBy(F.desc("_n")).limit(int(1 / share) + 1)
    rows = largest.collect()  # at most so many keys can hold more than a share
    limit = share * (seen.get["total"] or 0)
    return {r[0]: ceil(r["_n"] / limit) for r in rows if r["_n"] > limit}


def salted_join(small: DataFrame, small_key: str, big: DataFrame, big_key: str,
                hot: dict, spread_by: str | Column, how: str = "inner") -> DataFrame:
    """``small ⋈ big`` on ``small_key = big_key`` with hot keys split into buckets.

    ``spread_by`` is a big-side column that varies within a hot key (e.g. the child
    id); its hash picks the bucket.  The result has the columns of both sides plus
    nothing else.
    """
    if not hot:
        return small.join(big, small[small_key] == big[big_key], how)
    buckets = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    spread = F.col(spread_by) if isinstance(spread_by, str) else spread_by

    def of(key: Column) -> Column:
        return F.coalesce(buckets[key], F.lit(1))
    b = big.withColumn("_salt", F.pmod(F.hash(spread), of(big[big_key])))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), of(small[small_key]) - 1)))
    j = s.join(b, (s[small_key] == b[big_key]) & (s["_salt"] == b["_salt"]), how)
    return j.drop(s["_salt"]).drop(b["_salt"])
