"""Failure handling, from a table of handler attempts.

Attempts have the record's key and position, ``record_no`` and ``attempt_no``
(from 1), ``class`` (``normal`` or ``failure``), ``outcome`` (``ok``, ``failed``),
``error_category``, ``ts`` and ``duration_ms``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.functions.times import from_micros, instant, micros
from keyfold.operators.scan import CHUNK_ROWS, Running, by_position, running, sliding_sums
from keyfold.schema import KEY

MODES = ("pipeline", "low_latency", "best_effort")
PARTITION = ["topic", "part"]


def route_by_mode(
    attempts: DataFrame,
    mode: str = "pipeline",
    max_retries: int = 3,
    defer: bool = True,
    by: Sequence[str] = KEY,
) -> DataFrame:
    """One ``disposition`` per record: done, retry, defer, dead_letter or dropped."""
    if mode not in MODES:
        raise ValueError(f"mode: expected one of {MODES}, got {mode!r}")
    records = attempts.groupBy(*by, "record_no").agg(
        F.max("attempt_no").alias("attempts"),
        F.max_by(F.struct("outcome", "error_category"), "attempt_no").alias("_last"),
    )
    permanent = F.col("_last.error_category") == "permanent"
    if mode == "pipeline":
        transient = F.lit("defer" if defer else "retry")
    elif mode == "low_latency":
        transient = F.when(F.col("attempts") > max_retries, "dead_letter").otherwise("retry")
    else:
        transient = F.lit("dropped")
    disposition = (
        F.when(F.col("_last.outcome") == "ok", "done")
        .when(permanent, "dead_letter" if mode == "low_latency" else "dropped")
        .otherwise(transient)
    )
    return records.select(*by, "record_no", "attempts", disposition.alias("disposition"))


def deferred_queue(
    attempts: DataFrame, by: Sequence[str] = KEY, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Records parked after a transient failure, and those waiting behind them.

    Per record: ``arrived``, ``resolved`` (first success, null while open),
    ``blocked_until`` (latest resolution among earlier parked records of the
    key) and ``state``: ``parked``, ``waiting`` or ``clear``. A record waits
    while an earlier one of its key is parked and not resolved; ``blocked_until``
    is null then if that one never resolves.
    """
    by = list(by)
    never = F.lit(2**62)
    records = attempts.groupBy(*by, "record_no").agg(
        F.min(micros("ts")).alias("_arrived"),
        F.min(F.when(F.col("outcome") == "ok", micros("ts"))).alias("_resolved"),
        F.max((F.col("error_category") == "permanent").cast("int")).alias("_permanent"),
        F.max((F.col("error_category") == "transient").cast("int")).alias("_transient"),
    )
    parked = F.coalesce(F.col("_transient") == 1, F.lit(False)) & ~F.coalesce(
        F.col("_permanent") == 1, F.lit(False)
    )
    until = F.when(parked, F.coalesce(F.col("_resolved"), never))
    scanned = running(
        records, by, ["record_no"], by_position("record_no", chunk_rows),
        {"_until": Running("max", until, before=True)}, chunk_rows=chunk_rows,
    )
    state = (
        F.when(F.col("_until") > F.col("_arrived"), "waiting").when(parked, "parked").otherwise("clear")
    )
    return scanned.select(
        *by, "record_no",
        from_micros("_arrived").alias("arrived"),
        from_micros("_resolved").alias("resolved"),
        F.when(F.col("_until") < never, from_micros("_until")).alias("blocked_until"),
        state.alias("state"),
    )


def failure_rate_gate(
    attempts: DataFrame,
    threshold: float = 0.9,
    window_ms: int = 300_000,
    by: Sequence[str] = PARTITION,
) -> DataFrame:
    """Share of failed attempts in the sliding window ending at each instant.

    Deferral is off (``deferral_enabled`` false) while the share is above the
    threshold. One row per partition and instant with attempts.
    """
    failed = (F.col("outcome") != "ok").cast("bigint")
    sums = sliding_sums(
        attempts.withColumn("_us", micros("ts")), by, "_us", window_ms * 1000,
        {"attempts": F.lit(1).cast("bigint"), "failed": failed},
    )
    rate = F.col("failed") / F.col("attempts")
    return sums.select(
        *by, from_micros("_us").alias("ts"), "attempts", "failed",
        rate.alias("rate"), (rate <= threshold).alias("deferral_enabled"),
    )


def monopolizing_keys(
    attempts: DataFrame,
    threshold: float = 0.9,
    window_ms: int = 300_000,
    by: Sequence[str] = KEY,
) -> DataFrame:
    """Handler time of a key in the sliding window, and whether it is too much.

    A key above ``threshold`` of the window is ``rejected``, as a transient error.
    """
    sums = sliding_sums(
        attempts.withColumn("_us", micros("ts")), by, "_us", window_ms * 1000,
        {"busy_ms": F.col("duration_ms")},
    )
    rejected = F.col("busy_ms") > threshold * window_ms
    return sums.select(
        *by, from_micros("_us").alias("ts"), "busy_ms", rejected.alias("rejected"),
        F.when(rejected, "transient").alias("error_category"),
    )


def stalled_partitions(
    progress: DataFrame,
    asof,
    threshold_ms: int = 300_000,
    by: Sequence[str] = PARTITION,
) -> DataFrame:
    """Per assigned partition the last progress and whether it has stalled."""
    asof = asof if hasattr(asof, "cast") else F.lit(asof)
    last = progress.groupBy(*by).agg(F.max(instant("ts")).alias("last_ts"))
    idle = (micros(asof) - micros("last_ts")) / F.lit(1000)
    return last.withColumns({"idle_ms": F.floor(idle), "stalled": idle > threshold_ms})


def stall_summary(partitions: DataFrame) -> DataFrame:
    """Assigned partition count and whether any is stalled, in one row."""
    return partitions.agg(
        F.count("*").alias("assigned_partitions"),
        F.coalesce(F.max("stalled"), F.lit(False)).alias("is_stalled"),
    )


def execution_share(
    attempts: DataFrame, failure_target: float = 0.3, by: Sequence[str] = KEY
) -> DataFrame:
    """Handler time per key, split into fresh work and retries; in all for no key."""
    duration, retry = F.col("duration_ms"), F.col("class") == "failure"
    failure = F.coalesce(F.sum(F.when(retry, duration)), F.lit(0)).cast("bigint")
    total = F.sum(duration).cast("bigint")
    return (
        attempts.groupBy(*by)
        .agg(total.alias("total_ms"), failure.alias("failure_ms"))
        .withColumn("failure_share", F.col("failure_ms") / F.col("total_ms"))
        .withColumn("over_target", F.col("failure_share") > failure_target)
    )
