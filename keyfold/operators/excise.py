"""Erasure of a key by a tombstone record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.operators.joins import join_on
from keyfold.schema import KEY


def excised_keys(log: DataFrame, by: Sequence[str] = KEY) -> DataFrame:
    """Keys with an excise record and the position and time of the last one."""
    at = F.struct("part", "off")
    return (
        log.where(F.col("payload").isNull())
        .groupBy(*by)
        .agg(F.max(at).alias("excised"), F.max_by("ts", at).alias("excised_ts"))
    )


def excise_cascade(log: DataFrame, by: Sequence[str] = KEY) -> DataFrame:
    """Records that came after their key's last excise; other keys keep all."""
    gone = excised_keys(log, by).select(*by, "excised")
    return (
        join_on(log.where(F.col("payload").isNotNull()), gone, by, "left")
        .where(F.col("excised").isNull() | (F.struct("part", "off") > F.col("excised")))
        .drop("excised")
    )


def purge(
    table: DataFrame, log: DataFrame, ts: str = "ts", by: Sequence[str] = KEY
) -> DataFrame:
    """A derived table (state, timers, copies) without rows written before the excise."""
    gone = excised_keys(log, by).select(*by, "excised_ts")
    return (
        join_on(table, gone, by, "left")
        .where(F.col("excised_ts").isNull() | (F.col(ts) > F.col("excised_ts")))
        .drop("excised_ts")
    )


def compacted_view(log: DataFrame, by: Sequence[str] = KEY) -> DataFrame:
    """The latest record of each key; keys whose latest is an excise are absent."""
    others = [c for c in log.columns if c not in by]
    return (
        log.groupBy(*by)
        .agg(F.max_by(F.struct(*others), F.struct("part", "off")).alias("_last"))
        .where("_last.payload IS NOT NULL")
        .select(*by, "_last.*")
    )


def excise_audit(
    log: DataFrame, tables: Mapping[str, DataFrame], by: Sequence[str] = KEY
) -> DataFrame:
    """Rows of excised keys that are still present in other tables.

    ``tables`` maps a name to a frame with the key and ``ts``; a row is left over
    when it is not newer than the excise.
    """
    gone = excised_keys(log, by).select(*by, "excised_ts")

    def left_over(name, table):
        return (
            join_on(table.select(*by, "ts"), gone, by)
            .where("ts <= excised_ts")
            .groupBy(*by)
            .agg(F.count("*").alias("rows"))
            .select(F.lit(name).alias("table"), *by, "rows")
        )

    return reduce(DataFrame.unionByName, [left_over(n, t) for n, t in tables.items()])
