"""Tables that stay where later joins need them."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from keyfold.session import materialize, shared_dir


def placed(df: DataFrame, *columns: str) -> DataFrame:
    """A checkpoint of ``df`` in hash partitions by ``columns``, which joins on them need not shuffle again.

    Only a plan that is not changed at run time keeps its partitioning in a checkpoint,
    so adaptive execution rests while this one table is made.
    """
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return materialize(df.repartition(int(conf.get("spark.sql.shuffle.partitions")), *columns))
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now: it does so once their handles are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """A Parquet table in the shared folder: smaller than a checkpoint, and as safe."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
