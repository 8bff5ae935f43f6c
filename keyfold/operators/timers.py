"""Timers of a key, from a log of timer operations.

Operations are ``schedule``, ``clear_and_schedule``, ``unschedule`` and
``clear``; ``seq`` orders them. A key has at most one timer per second. Timers
due at ``fire_at`` fire before anything that happens at or after that instant,
and, unlike state, they do not roll back with a failed attempt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.functions.times import from_micros, micros, round_timer
from keyfold.operators.scan import CHUNK_ROWS, Running, by_position, hot_keys, running
from keyfold.schema import KEY

SCHEDULES = ("schedule", "clear_and_schedule")
CLEARS = ("clear_and_schedule", "clear")


def timer_fold(
    ops: DataFrame, by: Sequence[str] = KEY, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The timers that fire: ``(key, fire_at)``.

    Per ``(key, second)`` only the last schedule and the last effective
    unschedule count. The surviving second is then cancelled if any clear that
    follows its schedule happened before it was due, which is one running
    minimum over the key's clears, taken from the end.
    """
    by = list(by)
    timed = ops.withColumns({"_at": micros(round_timer("fire_at")), "_us": micros("ts")})
    op = F.col("op")
    seconds = (
        timed.where(op.isin(*SCHEDULES, "unschedule"))
        .groupBy(*by, "_at")
        .agg(
            F.max(F.when(op.isin(*SCHEDULES), F.col("seq"))).alias("seq"),
            F.max(F.when((op == "unschedule") & (F.col("_us") < F.col("_at")), F.col("seq")))
            .alias("_undone"),
        )
        .where("seq > coalesce(_undone, -1)")
    )
    line = seconds.select(*by, "seq", "_at", F.lit(1).alias("_timer")).unionByName(
        timed.where(op.isin(*CLEARS)).select(
            *by, "seq", F.col("_us").alias("_cleared"), F.lit(0).alias("_timer")
        ),
        allowMissingColumns=True,
    )
    # Scanned from the end, a timer comes before the clear of its own operation.
    judged = running(
        line, by, ["seq", "_timer"], by_position("seq", chunk_rows),
        {"_first_clear": Running("min", F.col("_cleared"))}, following=True,
        hot=hot_keys(ops, by, chunk_rows),
    )
    return judged.where(
        "_timer = 1 AND (_first_clear IS NULL OR _first_clear >= _at)"
    ).select(*by, from_micros("_at").alias("fire_at"))


def timers_pending(
    ops: DataFrame, asof_seq: int, asof_ts, by: Sequence[str] = KEY, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Timers scheduled and not yet due after operation ``asof_seq`` at ``asof_ts``."""
    asof = asof_ts if hasattr(asof_ts, "cast") else F.lit(asof_ts)
    return timer_fold(ops.where(F.col("seq") <= asof_seq), by, chunk_rows).where(
        micros("fire_at") > micros(asof)
    )
