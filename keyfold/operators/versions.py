"""Committed state as versions: what each commit changed, and from when to when it holds.

A commit log (``txn.commit_log``) becomes a table with a row per item and the half-open
span ``from_us`` to ``to_us`` in which readers see it; ``to_us`` is null while it holds. The
state as of any instant is what the spans hold then, so one table answers reads at all
times, and later commits only add rows and end open ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.operators.deques import WRITES, deque_trace
from keyfold.operators.joins import join_on
from keyfold.operators.scan import CHUNK_ROWS, Running, asof_join, by_position, hot_keys, running
from keyfold.schema import OP_KEY


def value_versions(log: DataFrame, by: Sequence[str] = OP_KEY, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(by, seq, item, from_us, to_us) of a value: from its commit to that of the next ``set`` or ``clear``."""
    writes = log.where(F.col("op").isin("set", "clear"))
    ended = running(writes, by, ["seq"], by_position("seq", chunk_rows),
                    {"to_us": Running("last", F.col("commit_us"), before=True)}, following=True, chunk_rows=chunk_rows)
    return _held(ended, by)


def map_versions(log: DataFrame, by: Sequence[str] = OP_KEY, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(by, map_key, seq, item, from_us, to_us): an entry ends with the next write of its map key, or the next clear of its map."""
    by = list(by)
    hot = hot_keys(log, by, chunk_rows)
    cleared = running(log, by, ["seq"], by_position("seq", chunk_rows),
                      {"_cleared": Running("last", F.when(F.col("op") == "clear", F.col("commit_us")))},
                      following=True, chunk_rows=chunk_rows, hot=hot)
    ended = running(cleared.where(F.col("op").isin("set", "delete")), [*by, "map_key"], ["seq"], by_position("seq", chunk_rows),
                    {"_written": Running("last", F.col("commit_us"), before=True)}, following=True, chunk_rows=chunk_rows)
    return _held(ended.withColumn("to_us", F.least("_written", "_cleared")), [*by, "map_key"])


def _held(ended: DataFrame, by: Sequence[str]) -> DataFrame:
    """Items with the span that readers see; what one commit writes and ends again is never seen."""
    return ended.where("op = 'set' AND (to_us IS NULL OR to_us > commit_us)").select(
        *by, "seq", "item", F.col("commit_us").alias("from_us"), "to_us")


def next_versions(open_versions: DataFrame, log: DataFrame, by: Sequence[str] = OP_KEY, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """What later commits change: versions they begin, and open ones again with the time they end.

    ``log`` holds whole attempts, all later than those that ``open_versions`` come from. Only
    open versions of keys in the log are looked at. With a column ``map_key`` in
    the log its items are map entries, else values.
    """
    by = list(by)
    a_map = "map_key" in log.columns
    touched = log.select(*by).distinct()
    held = join_on(open_versions.where("to_us IS NULL"), touched, by, "left_semi")
    item = ["map_key"] if a_map else []
    columns = [*by, *item, "seq", "op", "item", "commit_us"]
    again = held.withColumn("op", F.lit("set")).withColumn("commit_us", F.col("from_us"))
    both = again.select(*columns).unionByName(log.select(*columns))
    found = (map_versions if a_map else value_versions)(both, by, chunk_rows)
    known = held.select(*by, *item, "seq", F.lit(True).alias("_known"))
    return (join_on(found, known, [*by, *item, "seq"], "left")
            .where("_known IS NULL OR to_us IS NOT NULL").drop("_known"))


def merged(deltas: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """One row per version from all that ``next_versions`` gave, run after run: an end counts wherever it stands."""
    item = ["map_key"] if "map_key" in deltas.columns else []
    return deltas.groupBy(*by, *item, "seq").agg(
        F.first("item").alias("item"), F.max("from_us").alias("from_us"), F.max("to_us").alias("to_us"))


def as_of(lookups: DataFrame, versions: DataFrame, by: Sequence[str], at_us: str) -> DataFrame:
    """Lookups with ``found``, a struct of ``from_us``, ``to_us`` and ``item``, or null: the item that holds at their instant."""
    hit = asof_join(lookups, versions, by, at_us, "from_us", ["to_us", "item"], "seq")
    live = F.col("hit.to_us").isNull() | (F.col(at_us) < F.col("hit.to_us"))
    return hit.withColumn("found", F.when(F.col("hit").isNotNull() & live, F.col("hit"))).drop("hit")


def deque_versions(log: DataFrame, capacity: int | None = None, by: Sequence[str] = OP_KEY, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """A queue's ends after each operation, and what was written to each position, both with ``commit_us``.

    The items at an instant are those last written to the positions between the ends
    then (see ``operators.deques``), so positions need no spans of their own.
    """
    by = list(by)
    trace = deque_trace(log, capacity, by, chunk_rows)
    times = log.select(*by, "seq", "commit_us", "item")
    placed = join_on(trace, times, [*by, "seq"])
    ends = placed.select(*by, "seq", "commit_us", "front", "back")
    return ends, placed.where(F.col("op").isin(*WRITES)).select(*by, "slot", "seq", "commit_us", "item")
