"""Record filters that Spark pushes down to the scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def allowed_event(event_type: Column | str, prefixes: str | Sequence[str] | None) -> Column:
    """True when the type starts with one of the prefixes, or there is no type.

    No prefixes means every record is kept.
    """
    prefixes = [prefixes] if isinstance(prefixes, str) else list(prefixes or [])
    if not prefixes:
        return F.lit(True)
    event_type = _col(event_type)
    return reduce(or_, [event_type.startswith(p) for p in prefixes], event_type.isNull())


def from_elsewhere(source_system: Column | str, group_id: str) -> Column:
    """False for records this group produced itself; a missing header passes."""
    return ~_col(source_system).eqNullSafe(F.lit(group_id))


def is_message(payload: Column | str = "payload") -> Column:
    return _col(payload).isNotNull()


def is_excise(payload: Column | str = "payload") -> Column:
    return _col(payload).isNull()
