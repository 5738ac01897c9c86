"""Spark session defaults and the shared checkpoint folder.

Every operator in the package takes a ``SparkSession`` (or a DataFrame) from the
caller; nothing here starts a cluster.  ``get_session`` is a convenience for tests,
the bench and local runs.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster the master and the checkpoint folder come from the submitter; only
    local runs get a scratch checkpoint folder (see ``ensure_checkpoint_dir``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only when the session has none.

    Order: the folder already set on the SparkContext, then ``spark.checkpoint.dir``
    from the session conf (the shared folder the cluster names).  Only a local-mode
    session without either gets a fresh scratch folder; a cluster session without a
    shared folder is an error, because a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master == "local" or sc.master.startswith("local["):
        local_dir = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(local_dir)
        return sc.getCheckpointDir() or local_dir
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative operators need a shared folder "
        "(HDFS/S3/ABFS) to cut lineage on a cluster")


def checkpoint(df: DataFrame, cache: bool = True, codec: str | None = None) -> DataFrame:
    """Reliable checkpoint into the shared folder (never ``localCheckpoint``).

    ``cache=True`` keeps the frame while it is written, because an eager checkpoint
    runs the plan twice otherwise (once for the action, once for the files).
    ``cache=False`` writes the files within the first action that reads the frame and
    is for wide or costly frames: a plain Parquet table below the checkpoint folder,
    written once and read back; ``codec`` is the one of its files, else the session's.
    """
    base = ensure_checkpoint_dir(df.sparkSession)
    if not cache:
        path = f"{base}/table-{uuid.uuid4().hex}"
        _tables.append(path)
        df.write.parquet(path, compression=codec)
        table = df.sparkSession.read.schema(df.schema).parquet(path)
        table._strata_path = path
        return table
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


_tables: list[str] = []


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables that ``checkpoint(cache=False)`` has written, once no frame reads them:
    those of the given frames, or all."""
    for name in [f._strata_path for f in frames] if frames else list(_tables):
        _delete(spark, name)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if name in _tables:
        _tables.remove(name)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Delete the tables that ``checkpoint(cache=False)`` writes within the block when it ends, but for
    those of the frames that are put into the list it gives."""
    before, keep = set(_tables), []
    try:
        yield keep
    finally:
        kept = before.union(f._strata_path for f in keep)
        for name in [t for t in _tables if t not in kept]:
            _delete(spark, name)
