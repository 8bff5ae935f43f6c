"""Ids kept by earlier runs, as a table that grows run by run and forgets what has expired."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions.times import micros
from keyfold.operators.sequence import SEVEN_DAYS_S, dedup_ttl
from keyfold.schema import KEY

SECOND_US = 1_000_000
DAY_US = 86_400 * SECOND_US


def _seen_schema(records: DataFrame, group: Sequence[str]) -> T.StructType:
    named = [T.StructField(c, records.schema[c].dataType) for c in group]
    return T.StructType([*named, T.StructField("kept_us", T.LongType()), T.StructField("version", T.StringType()),
                         T.StructField("run", T.IntegerType()), T.StructField("until", T.IntegerType())])


def read_seen(records: DataFrame, path: str, runs: int, from_us: int, version: str = "",
              event_id: str = "event_id", by: Sequence[str] = KEY) -> DataFrame:
    """What runs before number ``runs`` kept under a version and may not have expired at ``from_us``.

    Parts are folders by day of expiry: days that are over are not read.
    """
    group = [*by, event_id]
    parts = records.sparkSession.read.schema(_seen_schema(records, group)).option("basePath", f"{path}/seen")
    return (
        parts.parquet(*(f"{path}/seen/run={r}" for r in range(runs)))
        .where((F.col("until") >= from_us // DAY_US) & (F.col("version") == version))
        .select(*group, "kept_us")
    )


def append_kept(
    records: DataFrame,
    path: str,
    run: int,
    ttl_seconds: int = SEVEN_DAYS_S,
    version: str = "",
    event_id: str = "event_id",
    by: Sequence[str] = KEY,
) -> DataFrame:
    """Keeps of a run's records what no run before has kept within the TTL, and remembers it.

    The result is written to ``kept/run=<run>`` below ``path``, the latest time of each
    ``(key, id)`` in it to ``seen/run=<run>``. Runs are numbered from 0 and use one TTL. A part
    is replaced as a whole, from the parts before it, so a run that was lost or stopped is
    simply run again. Under a new version nothing was kept before. Over runs in order of
    time the result is that of ``dedup_ttl`` over all records at once; a record that is
    late is a duplicate of a kept one of its id with a later time.
    """
    spark, group = records.sparkSession, [*by, event_id]
    first_us = records.agg(F.min(micros("ts"))).first()[0]
    seen = None
    if run > 0 and first_us is not None:
        seen = read_seen(records, path, run, first_us, version, event_id, by)
    dedup_ttl(records, ttl_seconds, event_id, by, seen).write.mode("overwrite").parquet(f"{path}/kept/run={run}")
    kept = spark.read.schema(records.schema).parquet(f"{path}/kept/run={run}")
    # Windows end on whole seconds, up to one later.
    until = F.floor((F.col("kept_us") + (ttl_seconds + 1) * SECOND_US) / DAY_US).cast("int")
    (
        kept.where(F.col(event_id).isNotNull())
        .groupBy(*group).agg(F.max(micros("ts")).alias("kept_us"))
        .select(*group, "kept_us", F.lit(version).alias("version"), until.alias("until"))
        .write.mode("overwrite").partitionBy("until").parquet(f"{path}/seen/run={run}")
    )
    return kept
