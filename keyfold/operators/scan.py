"""Running aggregates over per-key histories of any length.

A plain window ``partitionBy(key).orderBy(seq)`` sends all rows of a key to one
task, which fails when one key holds a large part of the table. So the keys with
too many rows are looked up first: a count per key, combined before its small
shuffle. Where there are none the plain window is used, one shuffle in all.
Otherwise the hot keys are cut up. Every running aggregate used here is
associative, so it can be computed in two levels:

1. cut a hot key's history into chunks of bounded size and run the window inside
   ``(key, chunk)``: the shuffle spreads the key over all tasks;
2. reduce every chunk to one row, run the window over those few rows, and join
   the value carried into each chunk back to its rows.

A chunk is a non-decreasing function of the order columns, so that chunks of a
key follow each other. ``by_position`` divides a unique integer position and
``by_minute`` a time line with distinct instants; both bound the rows of a chunk.
The list of hot keys only chooses the plan; it never changes a result.
Key columns must not be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.times import units
from keyfold.operators.joins import join_on

CHUNK_ROWS = 1 << 18
# A key is cut up when it has more rows than this many chunks.
HOT_CHUNKS = 16
# More hot keys than this are not listed: then every key is cut up.
MAX_LISTED = 10_000
MINUTE_US = 60_000_000


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``sum``, ``last`` (non-null), ``max`` or ``min``.

    ``before`` leaves the current row out.
    """

    kind: str
    value: Column
    before: bool = False


def by_position(position: str, rows: int = CHUNK_ROWS) -> Column:
    return units(position, rows)


def by_minute(micros: str) -> Column:
    return units(micros, MINUTE_US)


@dataclass(frozen=True)
class Hot:
    """The keys to cut up: listed in a small frame, or all of them."""

    any: bool
    listed: DataFrame | None = None

    def mark(self, df: DataFrame, by: Sequence[str]) -> DataFrame:
        """Add ``_hot``, true for rows of the keys to cut up."""
        if not self.any:
            return df.withColumn("_hot", F.lit(False))
        if self.listed is None:
            # without a key a row is not cut up, here as with a list
            return df.withColumn("_hot", reduce(and_, (F.col(c).isNotNull() for c in by)))
        # at most MAX_LISTED keys
        marked = df.join(F.broadcast(self.listed), list(by), "left")
        return marked.withColumn("_hot", F.coalesce("_hot", F.lit(False)))


def hot_keys(df: DataFrame, by: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> Hot:
    """Find the keys with too many rows for one task. Runs a job on the key columns."""
    counted = df.groupBy(*by).agg(F.count("*").alias("_rows"))
    crowded = counted.where(F.col("_rows") > chunk_rows * HOT_CHUNKS).select(*by)
    found = crowded.limit(MAX_LISTED + 1).collect()
    if len(found) > MAX_LISTED:
        return Hot(True)
    if not found:
        return Hot(False)
    listed = df.sparkSession.createDataFrame(found, crowded.schema)
    return Hot(True, listed.withColumn("_hot", F.lit(True)))


_OVER = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _combine(kind: str, carried: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carried + local, carried, local)
    if kind == "last":
        return F.coalesce(local, carried)
    # greatest and least skip nulls
    return (F.greatest if kind == "max" else F.least)(carried, local)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    chunk: Column | Sequence[Column],
    out: Mapping[str, Running],
    following: bool = False,
    chunk_rows: int = CHUNK_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """Add running aggregates over the rows up to the current one.

    With ``following`` the frame is the current row and those after it; ``last``
    then means the next non-null value. ``hot`` saves the count where the caller
    knows the crowded keys already.
    """
    hot = hot_keys(df, by, chunk_rows) if hot is None else hot
    values = {name: f"_v_{name}" for name in out}
    rows = df.withColumns({values[name]: r.value for name, r in out.items()})
    kept = [c for c in df.columns if c not in out]

    def window(partition, names, before):
        return (
            Window.partitionBy(*partition)
            .orderBy(*[F.col(n).desc() if following else F.col(n).asc() for n in names])
            .rowsBetween(Window.unboundedPreceding, -1 if before else 0)
        )

    def over(name, r, group):
        return _OVER[r.kind](F.col(values[name])).over(window(group, order, r.before)).alias(name)

    if not hot.any:
        return rows.select(*kept, *[over(name, r, by) for name, r in out.items()])

    chunks = [chunk] if isinstance(chunk, Column) else list(chunk)
    names = [f"_chunk{i}" for i in range(len(chunks))]
    group = [*by, *names]
    rows = hot.mark(rows, by)
    rows = rows.withColumns({
        name: F.when(F.col("_hot"), c.cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        for name, c in zip(names, chunks)
    })
    local = rows.select(*kept, *names, *[over(name, r, group) for name, r in out.items()])

    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    def total(name, r):
        value = F.col(values[name])
        if r.kind != "last":
            return _OVER[r.kind](value)
        pick = F.min_by if following else F.max_by
        return pick(value, F.when(value.isNotNull(), position))

    totals = rows.where("_hot").groupBy(*group).agg(
        *[total(name, r).alias(f"_t_{name}") for name, r in out.items()]
    )
    carried = totals.select(*group, *[
        _OVER[r.kind](F.col(f"_t_{name}")).over(window(by, names, True)).alias(f"_c_{name}")
        for name, r in out.items()
    ]).where(reduce(or_, [F.col(f"_c_{name}").isNotNull() for name in out]))
    return local.join(carried, group, "left").select(*kept, *[
        _combine(r.kind, F.col(f"_c_{name}"), F.col(name)).alias(name) for name, r in out.items()
    ])


def sliding_sums(
    df: DataFrame,
    by: Sequence[str],
    micros: str,
    width_us: int,
    sums: Mapping[str, Column],
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Sums over ``[t - width, t]`` at every distinct instant ``t`` of a key.

    Each instant enters the sum at ``t`` and leaves it after ``t + width``, so a
    sliding sum is a running sum over twice the rows: no row is ever compared
    with another, whatever the density of the window. Values must be integers.
    """
    hot = hot_keys(df, by, chunk_rows)
    instants = df.groupBy(*by, F.col(micros).alias("_t")).agg(
        *[F.sum(c).cast("bigint").alias(f"_s_{n}") for n, c in sums.items()]
    )
    both = instants.select(
        *by,
        F.inline(F.array(
            F.struct(
                F.col("_t").alias("_at"), F.lit(0).alias("_leaves"),
                *[F.col(f"_s_{n}").alias(f"_d_{n}") for n in sums],
            ),
            F.struct(
                (F.col("_t") + F.lit(width_us)).alias("_at"), F.lit(1).alias("_leaves"),
                *[(-F.col(f"_s_{n}")).alias(f"_d_{n}") for n in sums],
            ),
        )),
    )
    summed = running(
        both, by, ["_at", "_leaves"], by_minute("_at"),
        {n: Running("sum", F.col(f"_d_{n}")) for n in sums}, hot=hot,
    )
    return summed.where("_leaves = 0").select(
        *by, F.col("_at").alias(micros), *[F.col(n) for n in sums]
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_us: str,
    right_us: str,
    values: Sequence[str],
    tie: str,
    forward: bool = False,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Attach to each left row the nearest right row of its key in time.

    Backward: the latest right row at or before ``left_us``; forward: the
    earliest at or after it. ``tie`` orders right rows of one instant (backward
    keeps the last of them, forward the first). Adds ``hit``, a struct of
    ``right_us`` and ``values``, null where nothing matches.

    Both sides are merged into one time line and scanned; no pairs are formed.
    With hot keys the sides are first reduced to one row per ``(key, instant)``,
    which bounds the chunks, and the answers are joined back.
    """
    by = list(by)
    hot = hot_keys(left.select(*by).unionAll(right.select(*by)), by, chunk_rows)
    # In scan order a right row comes before the left instant it equals.
    right_side, left_side = (1, 0) if forward else (0, 1)
    hit = {"hit": Running("last", F.col("_hit"))}
    found = right.select(
        *by, F.col(right_us).alias("_at"), F.struct(F.col(right_us), *values).alias("_hit"),
        F.col(tie).alias("_tie"), F.lit(right_side).alias("_side"),
    )
    if not hot.any:
        line = left.withColumns({"_at": F.col(left_us), "_side": F.lit(left_side)}).unionByName(
            found, allowMissingColumns=True
        )
        scanned = running(line, by, ["_at", "_side", "_tie"], [], hit, forward, hot=hot)
        return scanned.where(F.col("_side") == left_side).select(*left.columns, "hit")
    pick = F.min_by if forward else F.max_by
    instants = found.groupBy(*by, "_at", "_side").agg(pick("_hit", "_tie").alias("_hit"))
    probes = left.select(*by, F.col(left_us).alias("_at"), F.lit(left_side).alias("_side")).distinct()
    line = instants.unionByName(probes, allowMissingColumns=True)
    scanned = running(
        line, by, ["_at", "_side"], by_minute("_at"), hit, forward, hot=hot
    ).where(F.col("_side") == left_side)
    return join_on(left, scanned.select(*by, F.col("_at").alias(left_us), "hit"), [*by, left_us], "left")
