"""Readers of committed keyed state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.operators.published import published_collections
from keyfold.operators.versions import merged, next_versions
from keyfold.schema import OP_KEY


def read_published(
    snapshots: DataFrame, catalog: DataFrame, subsystem: str, collection: str
) -> DataFrame:
    """A published collection's snapshot, from the group that serves it.

    ``snapshots`` holds the committed items of all groups with ``group_id`` and
    ``collection``; an unpublished collection gives no rows.
    """
    serving = published_collections(catalog).where(
        (F.col("subsystem") == subsystem) & (F.col("collection") == collection)
    ).select("group_id", "collection")
    return snapshots.where(F.col("collection") == collection).join(
        serving, ["group_id", "collection"], "left_semi"
    )


def append_versions(log: DataFrame, path: str, run: int, by: Sequence[str] = OP_KEY) -> None:
    """Adds what a commit log changes to the version table at ``path``, as its part ``run``.

    Runs are numbered from 0 in the order of their logs. A part is replaced as a whole, from the
    parts before it, so a run that was lost or stopped is simply run again.
    """
    spark = log.sparkSession
    item = ["map_key"] if "map_key" in log.columns else []
    before = log.select(*by, *item, "seq", "item", F.col("commit_us").alias("from_us"), F.col("commit_us").alias("to_us")).limit(0)
    if run > 0:
        parts = spark.read.option("basePath", path).parquet(*(f"{path}/run={r}" for r in range(run)))
        before = merged(parts.drop("run"), by)
    next_versions(before, log, by).write.mode("overwrite").parquet(f"{path}/run={run}")


def read_versions(spark: SparkSession, path: str, by: Sequence[str] = OP_KEY) -> DataFrame:
    """The versions that all runs together make (``operators.versions``)."""
    return merged(spark.read.parquet(path).drop("run"), by)


def read_state(
    spark: SparkSession, checkpoint: str, variable: str, operator_id: int = 0
) -> DataFrame:
    """A state variable of a stream, straight from its checkpoint."""
    return (
        spark.read.format("statestore")
        .option("stateVarName", variable)
        .option("operatorId", operator_id)
        .load(checkpoint)
    )
