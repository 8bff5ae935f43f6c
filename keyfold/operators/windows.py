"""Activity windows: one message at once, the rest in one summary.

The first record of a key is sent immediately and opens a window. Records inside
the window are saved, at most ``capacity`` of them (the newest), and sent as one
summary when the window's timer fires; an empty summary is not sent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.times import from_micros, micros
from keyfold.operators.anchored import assign_windows
from keyfold.operators.joins import join_on
from keyfold.operators.scan import CHUNK_ROWS, Running, by_position, running
from keyfold.schema import KEY

SECOND = 1_000_000


def window_notify(
    records: DataFrame,
    width_seconds: int = 300,
    capacity: int = 100,
    event_id: str = "event_id",
    excise: str | None = None,
    ttl_seconds: int | None = None,
    by: Sequence[str] = KEY,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Notifications ``(key, kind, window_start, fire_at, n, event_ids)``.

    ``kind`` is ``first`` or ``summary``. ``excise`` names a boolean column: such
    a record drops the open window with its timer, and the next record starts
    afresh. ``ttl_seconds`` is the time to live of the window flag and of the
    saved records: an expired flag lets the next record open a new window in
    place of the old one, and expired records are left out of the summary.

    Of each window only the newest ``capacity`` records reach the shuffle; the
    rank filter runs before it.
    """
    by = list(by)
    rows = records.withColumn("_us", micros("ts"))
    group = by
    if excise is not None:
        rows = running(
            rows, by, ["part", "off"], [F.col("part"), by_position("off", chunk_rows)],
            {"_gen": Running("sum", F.col(excise).cast("bigint"))}, chunk_rows=chunk_rows,
        )
        closed = rows.where(excise).select(
            *by, (F.col("_gen") - 1).alias("_gen"), F.col("_us").alias("_excised")
        )
        rows = rows.where(~F.col(excise))
        group = [*by, "_gen"]
    rows = rows.select(*group, "off", "_us", F.col(event_id).alias("_id"))

    open_s = width_seconds if ttl_seconds is None else min(width_seconds, ttl_seconds)
    placed = assign_windows(rows, group, "_us", open_s * SECOND, tie="off").withColumn(
        "_first", (F.col("_us") == F.col("start_us")) & (F.col("off") == F.col("start_tie"))
    )
    due = F.col("start_us") + width_seconds * SECOND + SECOND // 2
    placed = placed.withColumn("fire_us", due - F.pmod(due, F.lit(SECOND)))
    if ttl_seconds is not None:
        placed = placed.where(F.col("_first") | (F.col("_us") + ttl_seconds * SECOND > F.col("fire_us")))

    window = [*group, "start_us", "fire_us", "_first"]
    newest = Window.partitionBy(*window).orderBy(F.col("_us").desc(), F.col("off").desc())
    batch = F.array_sort(F.collect_list(F.struct("_us", "off", "_id")))
    sent = (
        placed.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= capacity)
        .groupBy(*window)
        .agg(F.transform(batch, lambda e: e["_id"]).alias("event_ids"))
    )
    if open_s < width_seconds:
        # The timer only fires if no later window replaced it.
        following = Window.partitionBy(*group).orderBy("start_us")
        starts = placed.where("_first").select(
            *group, "start_us", F.lead("start_us").over(following).alias("_next")
        )
        sent = join_on(sent, starts, [*group, "start_us"], "left").where(
            "_first OR _next IS NULL OR _next >= fire_us"
        )
    if excise is not None:
        sent = join_on(sent, closed, group, "left").where(
            "_first OR _excised IS NULL OR fire_us <= _excised"
        )
    return sent.select(
        *by,
        F.when(F.col("_first"), F.lit("first")).otherwise(F.lit("summary")).alias("kind"),
        from_micros("start_us").alias("window_start"),
        from_micros("fire_us").alias("fire_at"),
        F.size("event_ids").cast("bigint").alias("n"),
        "event_ids",
    )
