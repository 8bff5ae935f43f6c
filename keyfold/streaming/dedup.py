"""Duplicate removal on streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyfold.functions.times import micros
from keyfold.operators.sequence import SEVEN_DAYS_S
from keyfold.schema import KEY
from keyfold.session import configure

SECOND = 1_000_000


class _KeepFirst(StatefulProcessor):
    """Per ``(key, id)`` the instant until which repeats are dropped.

    The instant leaves the state by a timer in event time, or else by Spark's own TTL.
    """

    def __init__(self, ttl_us: int, columns: list[str], timers: bool):
        self.ttl_us, self.columns, self.timers = ttl_us, columns, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl_ms = None if self.timers else max(1, -(-self.ttl_us // 1000))
        self.until = handle.getValueState("until", "until_us bigint", ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.until.get()
        until = before = stored[0] if stored else None
        for r in sorted(rows, key=lambda r: (r.part, r.off)):
            if until is not None and r._us < until:
                continue
            until = (r._us + self.ttl_us + SECOND // 2) // SECOND * SECOND
            yield Row(**{c: getattr(r, c) for c in self.columns})
        if until != before:
            self.until.update((until,))
            if self.timers:
                if before is not None:
                    self.handle.deleteTimer(before // 1000)
                self.handle.registerTimer(until // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.until.clear()
        yield from ()

    def close(self) -> None:
        pass


def dedup_stream(
    records: DataFrame,
    ttl_seconds: int = SEVEN_DAYS_S,
    event_id: str = "event_id",
    watermark: str | None = None,
    by: Sequence[str] = KEY,
) -> DataFrame:
    """Drop a record whose ``(key, id)`` was kept within the TTL; same rows as ``dedup_ttl``.

    Records of a key are taken in offset order, and none is ever late: a key may lag
    behind others by any time. Records without id pass. State is one number per live
    id, removed once the TTL has passed on the wall clock.

    With a ``watermark`` the state follows event time instead, and Spark drops records
    behind the watermark.
    """
    configure(records.sparkSession)
    timed = records if watermark is None else records.withWatermark("ts", watermark)
    columns = records.columns
    kept = (
        timed.where(F.col(event_id).isNotNull())
        .withColumn("_us", micros("ts"))
        .groupBy(*by, event_id)
        .transformWithState(
            _KeepFirst(ttl_seconds * SECOND, columns, watermark is not None),
            T.StructType([records.schema[c] for c in columns]), "Append",
            **({"timeMode": "ProcessingTime"} if watermark is None
               else {"timeMode": "EventTime", "eventTimeColumnName": "ts"}))
    )
    return kept.unionByName(timed.where(F.col(event_id).isNull()))


def dedup_within_watermark(
    records: DataFrame,
    delay: str = "7 days",
    event_id: str = "event_id",
    by: Sequence[str] = KEY,
) -> DataFrame:
    """The cheaper form inside Spark: an id is dropped for at least ``delay``.

    Exact times do not matter to it, so an id may stay suppressed for longer.
    """
    timed = records.withWatermark("ts", delay)
    kept = timed.where(F.col(event_id).isNotNull()).dropDuplicatesWithinWatermark([*by, event_id])
    return kept.unionByName(timed.where(F.col(event_id).isNull()))
