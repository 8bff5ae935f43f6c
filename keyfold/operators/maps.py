"""Ordered-map collections.

A snapshot has one row per ``(key, map_key)``; map keys are ordered as UTF-8
bytes, which is Spark's string order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.operators.joins import join_on
from keyfold.schema import OP_KEY


def map_fold(ops: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """The entries left after ``set``, ``delete`` and ``clear`` operations."""
    clears = ops.where("op = 'clear'").groupBy(*by).agg(F.max("seq").alias("_cleared"))
    latest = (
        ops.where(F.col("op").isin("set", "delete"))
        .groupBy(*by, "map_key")
        .agg(F.max_by(F.struct("op", "item", "ts"), "seq").alias("_last"), F.max("seq").alias("seq"))
        .where("_last.op = 'set'")
    )
    return (
        join_on(latest, clears, by, "left")
        .where("_cleared IS NULL OR seq > _cleared")
        .select(*by, "map_key", "seq", "_last.ts", "_last.item")
    )


def map_get(snapshot: DataFrame, lookups: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """Each lookup ``(key, map_key)`` with its item, null when absent."""
    return join_on(lookups, snapshot.select(*by, "map_key", "item"), [*by, "map_key"], "left")


def map_has(snapshot: DataFrame, lookups: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """Each lookup with ``present``; items are neither read nor resolved."""
    keys = snapshot.select(*by, "map_key", F.lit(True).alias("_hit"))
    return join_on(lookups, keys, [*by, "map_key"], "left").withColumn(
        "present", F.col("_hit").isNotNull()
    ).drop("_hit")


def map_get_many_rows(
    snapshot: DataFrame, requests: DataFrame, by: Sequence[str] = OP_KEY
) -> DataFrame:
    """Requests ``(request_id, key, keys array)`` as rows ``pos, map_key, item``.

    Positions count from 0; repeated keys are answered each time. A request for
    no keys gives one row with null ``pos``.
    """
    asked = requests.select(
        "request_id", *by, F.posexplode_outer("keys").alias("pos", "map_key")
    )
    return map_get(snapshot, asked, by)


def map_get_many(snapshot: DataFrame, requests: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """One array ``items`` per request, aligned with its ``keys``.

    A result is as long as the request's own array, so a group cannot outgrow a row.
    """
    answered = map_get_many_rows(snapshot, requests, by)
    pairs = F.array_sort(F.collect_list(F.when(
        F.col("pos").isNotNull(), F.struct("pos", "item")
    )))
    return answered.groupBy("request_id", *by).agg(
        F.transform(pairs, lambda p: p["item"]).alias("items")
    )


def _scan(snapshot: DataFrame, by: Sequence[str], columns: Sequence[str], backward: bool) -> DataFrame:
    order = F.col("map_key").desc() if backward else F.col("map_key").asc()
    return snapshot.select(*by, *columns).orderBy(*by, order)


def map_entries(snapshot: DataFrame, backward: bool = False, by: Sequence[str] = OP_KEY) -> DataFrame:
    """Entries in map-key order: a range-partitioned sort, so a huge map spreads out."""
    return _scan(snapshot, by, ["map_key", "item"], backward)


def map_keys(snapshot: DataFrame, backward: bool = False, by: Sequence[str] = OP_KEY) -> DataFrame:
    return _scan(snapshot, by, ["map_key"], backward)


def map_values(snapshot: DataFrame, backward: bool = False, by: Sequence[str] = OP_KEY) -> DataFrame:
    return map_entries(snapshot, backward, by).drop("map_key")
