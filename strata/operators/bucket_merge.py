"""H2/H3 on a stored table: a merge that reads and rewrites only the buckets its batch changes.

The table is Parquet in versions (``sources/snapshots.py``), each partitioned by a hash bucket of the key.  A
version holds the buckets that its merge rewrote, and no others: a bucket's rows are those of the newest committed version
that has it.  A merge

1. takes the buckets of the batch's keys (at most as many numbers as there are buckets) and scans those folders
   alone, within the smallest and largest key of the batch, for the rows that the batch matches: a left semi join, so the
   target is not shuffled while the batch is below Spark's broadcast threshold;
2. merges these rows, at most as many as the batch has, with the batch (``keyed_merge``);
3. writes the buckets in which a row was updated or inserted as the next version.  Matched
   rows that stay as they are rewrite nothing, so a rerun of the same batch writes no file.

Nothing that a reader may hold is overwritten, and a run that is lost leaves a version without record, which is passed
over.  ``drop_superseded`` removes old buckets.  One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import assert_unique, dedup_by_key
from strata.operators.merge import INSERT, KEEP, UPDATE, keyed_merge
from strata.session import checkpoint, release
from strata.sources import snapshots

BUCKETS = 64
_FOLDER = re.compile(r"^bucket_of_(\d+)=(\d+)$")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket number of a key: CRC-32 of its parts as text, joined by ``|``."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.crc32(text.cast("binary")), F.lit(buckets)).cast("int")


def _listing(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Names and paths in a folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return [(f.getPath().getName(), f.getPath().toString()) for f in found]


def _folders(spark: SparkSession, path: str) -> tuple[int | None, dict[int, list[str]]]:
    """Number of buckets the table was made with, and each bucket's folders, the newest first."""
    made, out = set(), {}
    for version in snapshots.committed(spark, path):
        for name, folder in _listing(spark, version):
            if m := _FOLDER.match(name):
                made.add(int(m.group(1)))
                out.setdefault(int(m.group(2)), []).append(folder)
    if len(made) > 1:
        raise ValueError(f"{path} mixes numbers of buckets: {sorted(made)}")
    return (made.pop() if made else None), out


def _scan(spark: SparkSession, folders: dict[int, list[str]], buckets: Iterable[int]) -> DataFrame | None:
    """The newest rows of some buckets; None if none of them is there."""
    paths = [folders[b][0] for b in sorted(buckets) if b in folders]
    return spark.read.parquet(*paths) if paths else None


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole table; None if there is none."""
    _, folders = _folders(spark, path)
    return _scan(spark, folders, folders)


def drop_superseded(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the ``keep`` newest folders of each bucket; readers of older ones must have ended."""
    old = [f for found in _folders(spark, path)[1].values() for f in found[keep:]]
    for folder in old:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(old)


def _write(rows: DataFrame, path: str, keys: Sequence[str], column: str) -> None:
    """The next version; rows are ordered by key within a file."""
    snapshots.write_next(rows.sortWithinPartitions(column, *keys), path, partition_by=[column])


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """A new table; one that is there already is an error."""
    if _folders(df.sparkSession, path)[0] is not None:
        raise ValueError(f"{path} is there already")
    column = f"bucket_of_{buckets}"
    _write(df.withColumn(column, bucket_of(keys, buckets)).hint("rebalance", column), path, keys, column)


def merge_into(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
               update_cols: Sequence[str] | None = None, condition: Column | None = None,
               on_update: dict[str, Column] | None = None, on_insert: dict[str, Column] | None = None,
               duplicates: str = "error", dedup_order: Sequence[str] | None = None,
               buckets: int = BUCKETS, schema: str | None = None) -> dict[str, int]:
    """Merge ``batch`` into the table at ``path`` and count its rows by action.

    Arguments as in ``keyed_merge``; ``buckets`` and ``schema`` (default: the batch's) hold for a new table.
    A null key raises, as the key of the table is never null."""
    keys = list(keys)
    made, folders = _folders(spark, path)
    buckets = made or buckets
    column = f"bucket_of_{buckets}"
    if duplicates == "last":
        batch = dedup_by_key(batch, keys, order_by=dedup_order, keep="last")
    batch = checkpoint(batch.withColumn(column, bucket_of(keys, buckets)), cache=False)
    try:
        if duplicates == "error":
            assert_unique(batch, keys)
        if batch.where(" OR ".join(f"`{k}` IS NULL" for k in keys)).limit(1).count():
            raise ValueError(f"null merge key in {keys}")
        matched = _matched(spark, folders, batch, keys, column)
        if matched is None:
            matched = (spark.createDataFrame([], schema) if schema and not folders else
                       (read_buckets(spark, path) if folders else batch.drop(column)).limit(0))
        changed = checkpoint(
            keyed_merge(matched, batch, keys, update_cols=update_cols, condition=condition, on_update=on_update,
                        on_insert=on_insert, duplicates="ignore").withColumn(column, bucket_of(keys, buckets)),
            cache=False)
        counts = {r[0]: r[1] for r in changed.groupBy("_action").count().collect()}
        if counts.get(UPDATE) or counts.get(INSERT):
            _replace(spark, path, folders, changed, keys, column)
        release(spark, changed)
    finally:
        release(spark, batch)
    return {a: counts[a] for a in (UPDATE, KEEP, INSERT) if counts.get(a)}


def _matched(spark: SparkSession, folders: dict[int, list[str]], batch: DataFrame, keys: Sequence[str],
             column: str) -> DataFrame | None:
    """Rows of the table that have a key of the batch, from the batch's buckets alone."""
    part = _scan(spark, folders, [r[0] for r in batch.select(column).distinct().collect()])
    if part is None:
        return None
    low, high = batch.agg(F.min(keys[0]), F.max(keys[0])).first()
    return part.where(F.col(keys[0]).between(low, high)).join(batch.select(*keys), list(keys), "left_semi").select(
        *part.columns)


def _replace(spark: SparkSession, path: str, folders: dict[int, list[str]], changed: DataFrame, keys: Sequence[str],
             column: str) -> None:
    """Write the buckets with changed rows anew."""
    new = changed.where(F.col("_action").isin(UPDATE, INSERT))
    rows = new.drop("_action").hint("rebalance", column)
    old = _scan(spark, folders, [r[0] for r in new.select(column).distinct().collect()])
    if old is not None:
        updated = new.where(F.col("_action") == UPDATE).select(*keys)
        stay = old.join(updated, list(keys), "left_anti").select(*old.columns)
        rows = stay.withColumn(column, bucket_of(keys, int(column.rsplit("_", 1)[1]))).unionByName(rows)
    _write(rows, path, keys, column)
