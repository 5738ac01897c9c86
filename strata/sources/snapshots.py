"""Versioned parquet snapshots for merge-maintained tables.

A merge never overwrites the folder it reads: it writes ``{base}/v{N+1}`` and, last, a commit
record in it.  Readers take the newest version with a record (or with the writer's
``_SUCCESS`` marker), so a failed or half-written run is ignored and the previous
snapshot stays current.  Versions without any record are an error, not an empty table.
Listing uses the Hadoop FileSystem of the session, so the same code works on
HDFS, object stores and local disks.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_V = re.compile(r"^v(\d+)$")
RECORD = "_COMMITTED"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _folders(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """Numbers and paths of all version folders, the newest first."""
    fs, p, _ = _fs(spark, base)
    if not fs.exists(p):
        return []
    found = ((_V.match(s.getPath().getName()), s.getPath().toString()) for s in fs.listStatus(p))
    return sorted(((int(m.group(1)), path) for m, path in found if m), reverse=True)


def committed(spark: SparkSession, base: str) -> list[str]:
    """Committed versions, the newest first; none for a table that was never written."""
    folders = _folders(spark, base)
    out = []
    for _, path in folders:
        fs, _, jvm = _fs(spark, path)
        if any(fs.exists(jvm.org.apache.hadoop.fs.Path(path, mark)) for mark in (RECORD, "_SUCCESS")):
            out.append(path)
    if folders and not out:
        raise RuntimeError(f"{base} holds versions but no commit record: refusing to take it for an empty table")
    return out


def latest_path(spark: SparkSession, base: str) -> str | None:
    """The newest committed version; None for a table that was never written."""
    return next(iter(committed(spark, base)), None)


def read_latest(spark: SparkSession, base: str) -> DataFrame | None:
    p = latest_path(spark, base)
    return spark.read.parquet(p) if p else None


def write_next(df: DataFrame, base: str, partition_by=None) -> str:
    """Write ``df`` as the next snapshot and return its path.

    A number is never used twice: a second writer that took the same one fails."""
    spark = df.sparkSession
    folders = _folders(spark, base)
    path = f"{base.rstrip('/')}/v{(folders[0][0] + 1 if folders else 1):06d}"
    w = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    fs, _, jvm = _fs(spark, path)
    fs.create(jvm.org.apache.hadoop.fs.Path(path, RECORD)).close()
    return path
