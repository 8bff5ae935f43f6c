"""Reads of another group's committed state, by explicit key, as of the time of the read.

Logs are commit logs (``txn.commit_log``). A read at ``read_ts`` sees what was committed
at or before it. ``stale_read`` takes a value log whose ``ts`` is the commit time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.functions.times import from_micros, micros
from keyfold.operators import versions
from keyfold.operators.anchored import MILLISECOND_US, assign_windows
from keyfold.operators.intervals import least_held, stab
from keyfold.operators.joins import join_on
from keyfold.operators.scan import asof_join
from keyfold.schema import OP_KEY

READ_TTL_MS = 5_000


def _read(lookups: DataFrame, history: DataFrame, at: str, by: Sequence[str]) -> DataFrame:
    writes = history.where(F.col("op").isin("set", "clear")).select(
        *by, micros("ts").alias("_commit"), "seq", "op", "item"
    )
    found = asof_join(lookups, writes, by, at, "_commit", ["op", "item"], "seq")
    return found.withColumn("item", F.when(F.col("hit.op") == "set", F.col("hit.item"))).drop("hit")


def published_value_get(
    history: DataFrame, lookups: DataFrame, by: Sequence[str] = OP_KEY
) -> DataFrame:
    """The value committed at or before each lookup's ``read_ts``, or null."""
    timed = lookups.withColumn("_at", micros("read_ts"))
    return _read(timed, history, "_at", by).select(*lookups.columns, "item")


def stale_read(
    history: DataFrame,
    lookups: DataFrame,
    ttl_ms: int = READ_TTL_MS,
    reader: Sequence[str] = (),
    by: Sequence[str] = OP_KEY,
) -> DataFrame:
    """Lookups answered through a read cache that keeps a value for ``ttl_ms``.

    A miss fills the cache with the value committed at that instant
    (``filled_at``); reads before it runs out see that value, whatever was
    committed since. Cache times are whole milliseconds, cut off. ``reader``
    names the columns that tell one cache from another.
    """
    cache = [*reader, *by]
    timed = lookups.withColumn("_us", micros("read_ts"))
    filled = assign_windows(
        timed, cache, "_us", ttl_ms * 1000, unit_us=MILLISECOND_US, half_up=False
    )
    return _read(filled, history, "start_us", by).select(
        *lookups.columns, from_micros("start_us").alias("filled_at"), "item"
    )


def published_collections(catalog: DataFrame) -> DataFrame:
    """Readable collections, each with the one group that serves it.

    ``catalog`` has ``subsystem, collection, payload, published, group_id``; only
    published JSON collections can be read. Where several groups publish a collection,
    the one with the least id serves it.
    """
    return (
        catalog.where((F.col("payload") == "json") & F.col("published"))
        .groupBy("subsystem", "collection")
        .agg(F.min("group_id").alias("group_id"))
    )


def publish_catalog(lookups: DataFrame, catalog: DataFrame) -> DataFrame:
    """Lookups of ``(subsystem, collection)`` that may be answered."""
    return lookups.join(published_collections(catalog), ["subsystem", "collection"])


def publications(changes: DataFrame) -> DataFrame:
    """When each group publishes a collection, from rows of the catalogue with their time ``ts``.

    The latest row of a group and collection counts from its time on: one with
    ``published`` false, or of a payload other than JSON, retires the collection there.
    """
    rows = changes.select(
        "subsystem", "collection", "group_id", micros("ts").alias("commit_us"), "seq", F.col("group_id").alias("item"),
        F.when((F.col("payload") == "json") & F.col("published"), "set").otherwise("clear").alias("op"))
    return versions.value_versions(rows, ["subsystem", "collection", "group_id"])


def serving_group(lookups: DataFrame, changes: DataFrame) -> DataFrame:
    """Lookups with ``group_id``: the least group that publishes the collection at ``read_ts``, or null.

    ``lookups`` has ``lookup_id``, unique, and ``subsystem`` and ``collection``.
    """
    spans = publications(changes).select("subsystem", "collection", F.col("item").alias("group_id"), "from_us", "to_us")
    asked = lookups.select("lookup_id", "subsystem", "collection", micros("read_ts").alias("_at"))
    found = least_held(asked, spans, ["subsystem", "collection"], "_at", "lookup_id", "group_id")
    least = found.groupBy("lookup_id").agg(F.min("group_id").alias("group_id"))
    return lookups.join(least, "lookup_id", "left")


def published_map_get(log: DataFrame, lookups: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """Lookups of a ``map_key`` with its ``item`` and ``present`` as of ``read_ts``."""
    timed = lookups.withColumn("_at", micros("read_ts"))
    found = versions.as_of(timed, versions.map_versions(log, by), [*by, "map_key"], "_at")
    return found.select(*lookups.columns, F.col("found.item").alias("item"), F.col("found").isNotNull().alias("present"))


def published_map_get_many(log: DataFrame, requests: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """Requests for an array of ``keys`` as rows ``pos, map_key, item``, as of ``read_ts``; repeats are answered each time."""
    asked = requests.select(*(c for c in requests.columns if c != "keys"), F.posexplode_outer("keys").alias("pos", "map_key"))
    return published_map_get(log, asked, by).drop("present")


def published_map_entries(log: DataFrame, lookups: DataFrame, by: Sequence[str] = OP_KEY, values: bool = True) -> DataFrame:
    """The entries of each lookup's map as of ``read_ts``, one row each; without ``values`` only their keys."""
    item = ["item"] if values else []
    spans = versions.map_versions(log, by).select(*by, "map_key", *item, "from_us", "to_us")
    timed = lookups.withColumn("_at", micros("read_ts"))
    return stab(timed, spans, by, "_at").select(*lookups.columns, "map_key", *item)


def _ends(lookups: DataFrame, ends: DataFrame, by: Sequence[str]) -> DataFrame:
    timed = lookups.withColumn("_at", micros("read_ts"))
    return asof_join(timed, ends, by, "_at", "commit_us", ["front", "back"], "seq")


def published_deque_at(
    log: DataFrame, lookups: DataFrame, capacity: int | None = None, index: str = "i", by: Sequence[str] = OP_KEY
) -> DataFrame:
    """Lookups with ``item``, ``error_category``, ``length`` and ``is_empty`` as of ``read_ts``.

    Indexes count from the front, negative ones from the back; out of range gives null. An
    index that is not a whole number gives null with ``error_category`` transient.
    """
    by = list(by)
    ends, written = versions.deque_versions(log, capacity, by)
    at = F.col(index).cast("double")
    whole = F.coalesce(at == F.floor(at), F.lit(False))
    place = F.when(whole, at.try_cast("bigint") + F.when(at >= 0, F.col("hit.front")).otherwise(F.col("hit.back")))
    inside = (F.col("slot") >= F.col("hit.front")) & (F.col("slot") < F.col("hit.back"))
    asked = _ends(lookups, ends, by).withColumn("slot", place).withColumns({
        "slot": F.when(inside, F.col("slot")),
        "error_category": F.when(~whole, F.lit("transient")),
        "length": F.coalesce(F.col("hit.back") - F.col("hit.front"), F.lit(0)).cast("bigint"),
    }).drop("hit")
    found = asof_join(asked, written, [*by, "slot"], "_at", "commit_us", ["item"], "seq")
    return found.select(*lookups.columns, F.when(F.col("slot").isNotNull(), F.col("hit.item")).alias("item"),
                        "error_category", "length", (F.col("length") == 0).alias("is_empty"))


def published_deque_values(log: DataFrame, lookups: DataFrame, capacity: int | None = None, by: Sequence[str] = OP_KEY) -> DataFrame:
    """The items of each lookup's queue as of ``read_ts``, one row each with ``pos`` from the front."""
    by = list(by)
    ends, written = versions.deque_versions(log, capacity, by)
    held = _ends(lookups, ends, by).where("hit.back > hit.front")
    places = held.select(*lookups.columns, "_at", F.col("hit.front").alias("_front"),
                         F.explode(F.sequence(F.col("hit.front"), F.col("hit.back") - 1)).alias("slot"))
    found = asof_join(places, written, [*by, "slot"], "_at", "commit_us", ["item"], "seq")
    return found.select(*lookups.columns, (F.col("slot") - F.col("_front")).alias("pos"), F.col("hit.item").alias("item"))
