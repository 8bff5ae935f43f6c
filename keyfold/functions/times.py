"""Instants and whole-second timer times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(ts: Column | str) -> Column:
    """A timestamp with or without zone as an instant (session zone UTC)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.cast("timestamp")


def micros(ts: Column | str) -> Column:
    return F.unix_micros(instant(ts))


def from_micros(us: Column | str) -> Column:
    return F.timestamp_micros(F.col(us) if isinstance(us, str) else us)


def round_timer(ts: Column | str) -> Column:
    """Timer times keep whole seconds, rounded half up."""
    return F.date_trunc("second", instant(ts) + F.expr("INTERVAL 500 MILLISECONDS"))


def units(column: str, size: int) -> Column:
    """How many whole units of ``size`` a bigint column holds, rounded down."""
    return F.expr(f"(`{column}` - pmod(`{column}`, {size}L)) div {size}L")
