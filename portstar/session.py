"""Session construction and the shared scratch folder.

Intermediate tables (dense-key numbering, round trips, incremental loads) are written under the
folder the cluster names in ``spark.checkpoint.dir``. That setting is read from the session; a
folder of our own is only created when it is unset *and* the master is local (tests, smoke runs).
On a cluster without it we refuse to guess, because a machine-local folder would not be visible
to every executor.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "portstar",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library is written against."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[int, tuple[int, str | None]] = {}      # session -> writes under way, the setting before the first
_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Statements run inside delete their shuffle files when they end; else these stay on the executors' disks
    until the driver happens to collect its garbage. The session's setting comes back after the last of several
    threads. Versions of Spark without the setting pass over it."""
    session = spark._jsparkSession.hashCode()
    with _lock:
        running, before = _freeing.get(session, (0, None))
        if not running:
            before = spark.conf.get(_FREE, None)
            spark.conf.set(_FREE, "true")
        _freeing[session] = running + 1, before
    try:
        yield
    finally:
        with _lock:
            running, before = _freeing.pop(session)
            if running > 1:
                _freeing[session] = running - 1, before
            elif before is None:
                spark.conf.unset(_FREE)
            else:
                spark.conf.set(_FREE, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir`` of this session."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every executor can read "
                "(HDFS, object store) before writing intermediate tables")
        configured = tempfile.mkdtemp(prefix="portstar-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "portstar", f"{purpose}-{uuid.uuid4().hex[:12]}")


def delete_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
