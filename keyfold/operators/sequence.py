"""Per-key order and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.times import micros
from keyfold.operators.anchored import anchored_slots
from keyfold.operators.joins import join_on
from keyfold.operators.scan import CHUNK_ROWS, Hot, Running, by_position, running
from keyfold.schema import KEY

SEVEN_DAYS_S = 7 * 24 * 3600


def per_key_sequence(
    records: DataFrame,
    by: Sequence[str] = KEY,
    chunk_rows: int = CHUNK_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """Number each key's records in delivery order, from 1 (``n``).

    Where ``records`` are costly to compute, pass the hot keys of what they came
    from: counting there finds at least the same keys.
    """
    return running(
        records, by, ["part", "off"], [F.col("part"), by_position("off", chunk_rows)],
        {"n": Running("sum", F.lit(1).cast("bigint"))}, chunk_rows=chunk_rows, hot=hot,
    )


def first_occurrences(
    records: DataFrame, event_id: str = "event_id", by: Sequence[str] = KEY
) -> DataFrame:
    """Keep the first record of each ``(key, id)``; records without id all stay.

    The rank filter is also applied before the shuffle, so each task sends at
    most one record per id however many copies there are.
    """
    first = Window.partitionBy(*by, event_id).orderBy("part", "off")
    named = (
        records.where(F.col(event_id).isNotNull())
        .withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .drop("_rank")
    )
    return named.unionByName(records.where(F.col(event_id).isNull()))


def dedup_ttl(
    records: DataFrame,
    ttl_seconds: int = SEVEN_DAYS_S,
    event_id: str = "event_id",
    by: Sequence[str] = KEY,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Keep a record unless one with its ``(key, id)`` was kept within the TTL.

    A skipped duplicate does not prolong the time. Records without id all stay.
    ``seen`` tells which ids were kept before these records, with their key, id and
    time (``kept_us``; the latest counts). A record that arrives after one of a later
    time was kept is its duplicate.
    """
    group = [*by, event_id]
    named = records.where(F.col(event_id).isNotNull()).withColumn("_us", micros("ts"))
    times = named
    if seen is not None:
        latest = seen.groupBy(*group).agg(F.max("kept_us").alias("_kept_us"))
        named = join_on(named, latest, group, "left").where(
            F.col("_kept_us").isNull() | F.col("_us").isNull() | (F.col("_us") > F.col("_kept_us"))
        )
        # What was kept opens the window it opened in its own run.
        times = named.select(*group, "part", "off", F.explode(F.array_distinct(
            F.array_compact(F.array("_kept_us", "_us")))).alias("_us"))
    kept = (
        anchored_slots(times, group, "_us", ttl_seconds * 1_000_000)
        .where("opens")
        .select(*group, F.col("start_us").alias("_us"))
    )
    first = Window.partitionBy(*group, "_us").orderBy("part", "off")
    survivors = (
        join_on(named, kept, [*group, "_us"], "left_semi")
        .withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .select(*records.columns)
    )
    return survivors.unionByName(records.where(F.col(event_id).isNull()))


def drop_seen(
    records: DataFrame,
    seen: DataFrame,
    version: str,
    event_id: str = "event_id",
    by: Sequence[str] = KEY,
) -> DataFrame:
    """Drop records recorded as seen under this version.

    ``seen`` has the key, the id and ``version``; a new version matches nothing,
    so all its records are processed again.
    """
    known = seen.where(F.col("version") == version).select(*by, event_id)
    return join_on(records, known, [*by, event_id], "left_anti").select(*records.columns)
