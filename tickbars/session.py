"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_utc(spark: SparkSession) -> SparkSession:
    """Times are read, windowed and printed in UTC; parquet's zone-less times would shift otherwise."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to the machine's own temporary folder: on a cluster executors could not see it.
    The folder goes when the program ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/tickbars/{label}-{uuid.uuid4().hex}"
        atexit.register(_removed, spark, folder)
        return folder
    if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix=f"tickbars-{label}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store; the store may be gone by then."""
    with contextlib.suppress(Exception):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def streaming_session(
    spark: SparkSession, *, state_partitions: int | None = None, rocksdb: bool | None = None
) -> SparkSession:
    """A sibling session for streaming queries, leaving the caller's settings alone.

    A stateful query keeps the shuffle partition count of its first start for its whole life, so it is chosen here: size
    it for the cluster (a few per core), not for the first batch. RocksDB keeps state off the JVM heap and is the choice
    wherever executors are processes of their own; a local master keeps Spark's default store unless told otherwise. Its
    rows are not counted, as that would look up every key before it is written: ``numRowsTotal`` means nothing there.
    """
    session = use_utc(spark.newSession())
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    if rocksdb is None:
        rocksdb = not spark.sparkContext.master.startswith("local[")
    if rocksdb:
        session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    return session


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder on whatever file system the path names, unless it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
