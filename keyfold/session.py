"""Session settings the operators count on."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # One clock for every conversion between instants and local timestamps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key makes one side of a join long: split it even when that costs
    # one more exchange further down.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A JSON object may repeat a name; the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)
# Counting the rows of the state reads each one again before it is written.
STATE_ROWS = ("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
# State is on disk twice, beside its task and in the checkpoint. A stream join has one store
# a partition in place of four; what began otherwise goes on as it began.
STATE_FILES = {
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "16",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session made elsewhere."""
    for name, value in {**SETTINGS, **STATE_FILES}.items():
        spark.conf.set(name, value)
    spark.conf.set(*STATE_STORE)
    spark.conf.set(*STATE_ROWS)
    return spark


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="keyfold-checkpoint-")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is named and all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named or _own_dir()


def checkpoint_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several branches read.

    A reliable checkpoint survives the loss of executors and keeps the
    partitioning and order of the rows, so what follows need not shuffle again.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
