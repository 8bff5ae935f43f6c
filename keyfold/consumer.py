"""What a consumer group reads and how it handles it, in one place.

A record passes the group's filters, duplicates are dropped, and a handler runs
over what is left; failures go where the mode says.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.functions.errors import DEFER_BASE_MS, DEFER_CAP_MS
from keyfold.functions.filters import allowed_event, from_elsewhere
from keyfold.operators.failures import MODES
from keyfold.operators.sequence import SEVEN_DAYS_S, dedup_ttl, drop_seen
from keyfold.sources.log import outgoing, outgoing_excise, read_log
from keyfold.state.definitions import Collection
from keyfold.streaming.dedup import dedup_stream
from keyfold.streaming.handler import Settings, run_stream, run_table


@dataclass(frozen=True)
class Consumer:
    """Options of a consumer group; the defaults are those of the operators.

    ``source_system`` marks what the group sends and defaults to ``group_id``;
    records marked with the group id itself are skipped.
    """

    group_id: str
    topics: str | Sequence[str] = ()
    source_system: str | None = None
    allowed_events: str | Sequence[str] = ()
    dedup_ttl_s: int = SEVEN_DAYS_S
    dedup_version: str = "1"
    mode: str = "pipeline"
    max_retries: int = 3
    failure_topic: str | None = None
    defer: bool = True
    defer_base_ms: int = DEFER_BASE_MS
    defer_cap_ms: int = DEFER_CAP_MS

    def __post_init__(self):
        if not self.group_id:
            raise ValueError("group_id: must be a non-empty string")
        if self.mode not in MODES:
            raise ValueError(f"mode: expected one of {MODES}, got {self.mode!r}")
        if self.mode == "low_latency" and not self.failure_topic:
            raise ValueError("failure_topic: required in low_latency mode")
        if self.dedup_ttl_s < 1:
            raise ValueError("dedup_ttl_s: must be at least 1")

    @property
    def _settings(self) -> Settings:
        return Settings(self.mode, self.max_retries, self.defer, self.defer_base_ms, self.defer_cap_ms)

    def read(self, spark: SparkSession, **options) -> DataFrame:
        """The group's topics; see ``read_log`` for files and streams."""
        return read_log(spark, self.topics, **options)

    def accepted(self, log: DataFrame) -> DataFrame:
        """Records of other sources and of the allowed event types.

        ``log`` carries ``event_id`` and ``event_type``, as ``read_log`` gives them.
        """
        return log.where(
            from_elsewhere("source_system", self.group_id)
            & allowed_event("event_type", self.allowed_events)
        )

    def table(self, log: DataFrame, seen: DataFrame | None = None) -> DataFrame:
        """What the group processes of a table, without what it has seen already."""
        fresh = dedup_ttl(self.accepted(log), self.dedup_ttl_s)
        return fresh if seen is None else drop_seen(fresh, seen, self.dedup_version)

    def stream(self, log: DataFrame, watermark: str | None = None) -> DataFrame:
        """The same for a stream; changing the version means a new checkpoint.

        See ``dedup_stream`` for what a watermark changes.
        """
        return dedup_stream(self.accepted(log), self.dedup_ttl_s, watermark=watermark)

    def handle_table(self, log: DataFrame, handler, collections: Iterable[Collection] = ()) -> DataFrame:
        return self._route(run_table(self.table(log), handler, collections, self._settings))

    def handle_stream(
        self, log: DataFrame, handler, collections: Iterable[Collection] = (), watermark: str | None = None
    ) -> DataFrame:
        # the event time, if any, is set where duplicates are dropped and carried on
        fresh = self.stream(log, watermark)
        return self._route(run_stream(fresh, handler, collections, self._settings, watermark, marked=True))

    def _route(self, rows: DataFrame) -> DataFrame:
        """Add ``to_topic``, the failure topic for dead letters."""
        return rows.withColumn(
            "to_topic", F.when(F.col("kind") == "dead_letter", F.lit(self.failure_topic)).cast("string")
        )

    def outgoing(self, records: DataFrame) -> DataFrame:
        return outgoing(records, self.source_system or self.group_id)

    def outgoing_excise(self, keys: DataFrame) -> DataFrame:
        return outgoing_excise(keys, self.source_system or self.group_id)
