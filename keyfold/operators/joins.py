"""Joins in which a missing key is a key like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns that both sides have; null equals null, as in a group or a window.

    Spark still hashes or sorts by these columns. The result has them once, first, and
    from the left: only kinds of joins that keep no right rows by themselves fit.
    """
    on = list(on)
    theirs = {c: f"_their_{c}" for c in on}
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(t)) for c, t in theirs.items()))
    left = left.select(*on, *(c for c in left.columns if c not in on))
    return left.join(right.withColumnsRenamed(theirs), same, how).drop(*theirs.values())
