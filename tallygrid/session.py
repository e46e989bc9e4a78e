"""Session settings and the shared folder that durable intermediates go to."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for. All are runtime-changeable or
# harmless when the cluster already sets them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_staged: list[tuple[SparkSession, str]] = []

# Hour tallies kept in streaming state can outgrow the heap; RocksDB spills. A batch uploads what it
# changed, not the whole store, and a write does not look first whether its key is there.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def apply_settings(spark: SparkSession, streaming: bool = False) -> SparkSession:
    for key, value in {**SETTINGS, **(STREAM_SETTINGS if streaming else {})}.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: the one ``spark.checkpoint.dir`` names.

    Where it is unset, a folder beside the tables of the warehouse, which the
    executors share too; never a folder of the driver's own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (not created yet). What is written there
    is removed by ``release``, or when the driver's Python ends."""
    if not _staged:  # registered late, so that it runs before Spark's own exit hook
        atexit.unregister(_release_all)
        atexit.register(_release_all)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    return path


def release(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``new_dir`` that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _staged[:] = [x for x in _staged if x[1] != path]


def _release_all() -> None:
    for spark, path in list(_staged):
        if spark.sparkContext._jsc is None:  # the session has been stopped
            return
        release(spark, path)



def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there.

    Cuts the lineage: a lost executor re-reads files instead of running again what
    made them, and cannot change which row got which position. Unlike a
    checkpointed RDD the files are columnar, so a reader of one column reads that
    one only, and their size is known to the join planner.
    """
    spark = df.sparkSession
    path = new_dir(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged(df: DataFrame) -> DataFrame:
    """``durable``, with the shuffle files of the writing job removed as it ends."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return durable(df)
    finally:
        spark.conf.set(CLEANUP, before)


def discard(*frames: DataFrame) -> None:
    """Remove what ``durable`` wrote for frames that nothing reads any more."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            release(df.sparkSession, path)
