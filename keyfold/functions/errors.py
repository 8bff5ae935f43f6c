"""Error categories, retry delays and timeouts as column expressions."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

RETRY_BASE_MS, RETRY_CAP_MS = 20, 300_000
DEFER_BASE_MS, DEFER_CAP_MS = 1_000, 86_400_000
STALL_THRESHOLD_MS = 300_000


def with_subclasses(classes: Iterable[str], parents: Mapping[str, str] | None) -> list[str]:
    """The classes and all that derive from them, for a map of class to parent."""
    wanted = set(classes)
    parents = parents or {}

    def matches(name):
        seen = set()
        while name is not None and name not in seen:
            if name in wanted:
                return True
            seen.add(name)
            name = parents.get(name)
        return False

    return sorted(wanted | {c for c in parents if matches(c)})


def error_category(
    error_class: Column | str,
    permanent: Iterable[str] = (),
    parents: Mapping[str, str] | None = None,
    declared: Column | None = None,
) -> Column:
    """``permanent`` or ``transient``; null where there is no error.

    An error is permanent when its class, or one it derives from, is in
    ``permanent``, or when it carries exactly the token ``permanent`` itself.
    """
    error_class = F.col(error_class) if isinstance(error_class, str) else error_class
    final = error_class.isin(with_subclasses(permanent, parents))
    if declared is not None:
        final = final | F.coalesce(declared == "permanent", F.lit(False))
    return F.when(error_class.isNull(), F.lit(None)).when(final, "permanent").otherwise("transient")


def _doublings(base: int, cap: int) -> int:
    """How many delays stay below the cap."""
    return max(0, math.ceil(math.log2(cap / base)))


def backoff_ms(attempt_no: Column | str, base: int = RETRY_BASE_MS, cap: int = RETRY_CAP_MS) -> Column:
    """Delay after the n-th failed attempt: doubles from ``base`` up to ``cap``."""
    n = F.col(attempt_no) if isinstance(attempt_no, str) else attempt_no
    steps = F.least(n - 1, F.lit(_doublings(base, cap))).cast("int")
    return F.least(F.lit(base) * F.pow(F.lit(2.0), steps).cast("bigint"), F.lit(cap)).cast("bigint")


def elapsed_ms(attempt_no: Column | str, base: int = RETRY_BASE_MS, cap: int = RETRY_CAP_MS) -> Column:
    """Total delay after n failed attempts, as a closed form of the sum."""
    n = F.col(attempt_no) if isinstance(attempt_no, str) else attempt_no
    m = _doublings(base, cap)
    growing = F.least(n, F.lit(m)).cast("int")
    rising = F.lit(base) * (F.pow(F.lit(2.0), growing).cast("bigint") - 1)
    return (rising + F.greatest(n - m, F.lit(0)) * F.lit(cap)).cast("bigint")


def default_timeout_ms(stall_threshold_ms: int = STALL_THRESHOLD_MS) -> int:
    return stall_threshold_ms * 8 // 10


def timed_out(
    duration_ms: Column | str,
    timeout_ms: int | None = None,
    stall_threshold_ms: int = STALL_THRESHOLD_MS,
) -> Column:
    """True for an attempt longer than the timeout (80 % of the stall threshold)."""
    limit = default_timeout_ms(stall_threshold_ms) if timeout_ms is None else timeout_ms
    return (F.col(duration_ms) if isinstance(duration_ms, str) else duration_ms) > limit
