"""Double-ended queues as arithmetic on positions.

Folding push, unshift, pop and shift row by row would pin a key to one task.
Three facts make it parallel:

* The length after an operation is the length before it, moved and held between
  two bounds (``min(max(length + step, low), high)``): push adds one up to the
  capacity, pop takes one down to zero, clear pins it to zero. Such functions
  compose to one of the same form, so a chunk of a log reduces to three numbers
  (``clamp_prefix``), and chunks combine like a running sum.
* Knowing the length, it is known whether a pop found something and whether a
  push evicted, so the back end of the queue is a plain running sum of steps and
  the front is the back minus the length.
* Every item then has a fixed position. What a position holds is the latest
  write to it; the items left are the positions between front and back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.operators.anchored import key_at, key_changes
from keyfold.operators.joins import join_on
from keyfold.operators.scan import CHUNK_ROWS, Running, by_position, hot_keys, running
from keyfold.schema import OP_KEY
from keyfold.session import materialize

UNBOUNDED = 1 << 60
WRITES = ("push", "unshift")
REMOVALS = ("pop", "shift")


def _then(f, g):
    """The clamp ``(step, low, high)`` that applies f first, then g."""
    step, low, high = g
    return (
        f[0] + step,
        np.minimum(np.maximum(f[1] + step, low), high),
        np.minimum(np.maximum(f[2] + step, low), high),
    )


IDENTITY = (0, -UNBOUNDED, UNBOUNDED)


def _prefixes(by: list[str], totals: bool):
    """Compose clamps along each key: before every row, or once per key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carry = None, IDENTITY
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            fresh = key_changes(batch, by, key)
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(fresh, at, 0))
            through = tuple(
                batch.column(c).to_numpy().astype(np.int64) for c in ("step", "low", "high")
            )
            # Doubling: after each round a row covers twice as many rows before it.
            reach = 1
            while reach < n:
                rows = np.flatnonzero(at - reach >= start)
                if rows.size == 0:
                    break
                joined = _then(
                    tuple(c[rows - reach] for c in through), tuple(c[rows] for c in through)
                )
                through = tuple(c.copy() for c in through)
                for column, values in zip(through, joined):
                    column[rows] = values
                reach *= 2
            if not fresh[0]:
                head = int(np.flatnonzero(fresh)[0]) if fresh.any() else n
                joined = _then(carry, tuple(c[:head] for c in through))
                for column, values in zip(through, joined):
                    column[:head] = values
            if totals:
                ends = np.flatnonzero(fresh) - 1
                if ends.size and ends[0] < 0:
                    ends = ends[1:]
                    if key is not None:
                        yield _one(by, key, carry, batch.schema)
                if ends.size:
                    take = pa.array(ends)
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).take(take) for c in by],
                         *[pa.array(c[ends]) for c in through]],
                        names=[*by, "step", "low", "high"],
                    )
            else:
                before = []
                for column, first, entry in zip(through, IDENTITY, carry):
                    shifted = np.empty(n, dtype=np.int64)
                    shifted[1:] = column[:-1]
                    shifted[fresh] = first
                    if not fresh[0]:
                        shifted[0] = entry
                    before.append(pa.array(shifted))
                kept = [c for c in batch.schema.names if c not in ("step", "low", "high")]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], *before],
                    names=[*kept, "step", "low", "high"],
                )
            key, carry = key_at(batch, by, n - 1), tuple(int(c[-1]) for c in through)
            last_schema = batch.schema
        if totals and key is not None:
            yield _one(by, key, carry, last_schema)

    return run


def _one(by, key, clamp, schema):
    return pa.RecordBatch.from_arrays(
        [*[pa.array([v], type=schema.field(c).type) for c, v in zip(by, key)],
         *[pa.array([int(v)], type=pa.int64()) for v in clamp]],
        names=[*by, "step", "low", "high"],
    )


def clamp_prefix(df: DataFrame, by: Sequence[str], order: str, totals: bool = False) -> DataFrame:
    """Compose the clamps ``step, low, high`` of each key's rows in order.

    Gives every row the composition of the rows before it, or with ``totals``
    one row per key with the composition of all its rows.
    """
    by = list(by)
    clamp = [T.StructField(c, T.LongType()) for c in ("step", "low", "high")]
    if totals:
        df = df.select(*by, order, "step", "low", "high")
    kept = by if totals else [c for c in df.columns if c not in ("step", "low", "high")]
    return (
        df.repartition(*by)
        .sortWithinPartitions(*by, order)
        .mapInArrow(_prefixes(by, totals), T.StructType([*[df.schema[c] for c in kept], *clamp]))
    )


def deque_trace(
    ops: DataFrame,
    capacity: int | None = None,
    by: Sequence[str] = OP_KEY,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every operation with the queue it meets and the position it touches.

    Adds ``length`` (after), ``front`` and ``back`` (half-open range of occupied
    positions, after), ``slot`` (position written or removed, else null).
    The result is checkpointed: later steps read it more than once.
    """
    by = list(by)
    cap = UNBOUNDED if capacity is None else capacity
    op = F.col("op")
    low, high = F.lit(-UNBOUNDED), F.lit(UNBOUNDED)
    clamp = {
        "step": F.when(op.isin(*WRITES), 1).when(op.isin(*REMOVALS), -1).otherwise(0),
        "low": F.when(op.isin(*REMOVALS, "clear"), F.lit(0)).otherwise(low),
        "high": F.when(op.isin(*WRITES), F.lit(cap)).when(op == "clear", F.lit(0)).otherwise(high),
    }
    narrow = ops.select(*by, "seq", "op").select("*", *[c.cast("bigint").alias(n) for n, c in clamp.items()])
    hot = hot_keys(narrow, by, chunk_rows)

    def entered(length):
        return F.greatest(F.lit(0), F.least(
            F.greatest(length + F.col("step"), F.col("low")), F.col("high")))

    if hot.any:
        group = [*by, "_chunk"]
        narrow = hot.mark(narrow, by).withColumn(
            "_chunk", F.when(F.col("_hot"), by_position("seq", chunk_rows)).otherwise(0))
        chunks = clamp_prefix(narrow.where("_hot"), group, "seq", totals=True)
        entry = clamp_prefix(chunks, by, "_chunk").select(*group, entered(F.lit(0)).alias("_entry"))
        placed = clamp_prefix(narrow.drop("_hot"), group, "seq").join(
            entry.where("_entry > 0"), group, "left")
        before = placed.withColumn("_before", entered(F.coalesce("_entry", F.lit(0))))
    else:
        before = clamp_prefix(narrow, by, "seq").withColumn("_before", entered(F.lit(0)))
    held = F.col("_before")
    length = (
        F.when(op.isin(*WRITES), F.least(held + 1, F.lit(cap)))
        .when(op.isin(*REMOVALS), F.greatest(held - 1, F.lit(0)))
        .when(op == "clear", F.lit(0))
        .otherwise(held)
    ).cast("bigint")
    step_back = (
        F.when(op == "push", F.lit(1))
        .when((op == "pop") & (held > 0), F.lit(-1))
        # a full queue drops from the back when something enters at the front
        .when(op == "unshift", F.least(F.lit(0), F.lit(cap) - held - 1))
        .otherwise(F.lit(0))
    ).cast("bigint")
    sized = materialize(before.select(*by, "seq", "op", "_before", length.alias("length")))
    traced = running(
        sized, by, ["seq"], by_position("seq", chunk_rows),
        {"back": Running("sum", step_back)}, hot=hot,
    ).withColumn("front", F.col("back") - F.col("length"))
    slot = (
        F.when(op == "push", F.col("back") - 1)
        .when(op == "unshift", F.col("front"))
        .when((op == "pop") & (held > 0), F.col("back"))
        .when((op == "shift") & (held > 0), F.col("front") - 1)
    )
    return traced.withColumn("slot", slot).drop("_before")


def deque_fold(
    ops: DataFrame,
    capacity: int | None = None,
    by: Sequence[str] = OP_KEY,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The items left in each key's queue.

    ``pos`` counts from the front (0, 1, …) and ``rpos`` from the back (…, -2, -1).
    """
    by = list(by)
    trace = deque_trace(ops, capacity, by, chunk_rows)
    ends = trace.groupBy(*by).agg(
        F.max_by(F.struct("front", "back"), "seq").alias("_end")
    )
    written = trace.where(F.col("op").isin(*WRITES)).groupBy(*by, "slot").agg(
        F.max("seq").alias("seq")
    )
    live = (
        join_on(written, ends, by)
        .where("slot >= _end.front AND slot < _end.back")
        .select(
            *by, "seq",
            (F.col("slot") - F.col("_end.front")).alias("pos"),
            (F.col("slot") - F.col("_end.back")).alias("rpos"),
        )
    )
    return join_on(live, ops.select(*by, "seq", "item"), [*by, "seq"])


def deque_removed(
    ops: DataFrame,
    capacity: int | None = None,
    by: Sequence[str] = OP_KEY,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """What each ``pop`` and ``shift`` returned: ``item``, null from an empty queue."""
    by = list(by)
    trace = deque_trace(ops, capacity, by, chunk_rows)
    touched = trace.where("slot IS NOT NULL")
    writer = F.when(F.col("op").isin(*WRITES), F.col("seq"))
    # A position may be written and emptied again and again: scan it in chunks too.
    written = running(
        touched, [*by, "slot"], ["seq"], by_position("seq", chunk_rows),
        {"_writer": Running("last", writer)}, chunk_rows=chunk_rows,
    )
    took = written.where(F.col("op").isin(*REMOVALS)).select(
        *by, "seq", "op", F.col("_writer").alias("from_seq")
    )
    nothing = trace.where(F.col("op").isin(*REMOVALS) & F.col("slot").isNull()).select(
        *by, "seq", "op", F.lit(None).cast("bigint").alias("from_seq")
    )
    items = ops.where(F.col("op").isin(*WRITES)).select(*by, F.col("seq").alias("from_seq"), "item")
    return join_on(took.unionByName(nothing), items, [*by, "from_seq"], "left")


def deque_latest(ops: DataFrame, capacity: int, by: Sequence[str] = OP_KEY) -> DataFrame:
    """The queue of a log that only pushes and clears: its newest ``capacity`` items.

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` the rank filter runs before
    the shuffle as well, so a task sends at most ``capacity`` rows per key. Any other
    operation in the log is an error: such logs need ``deque_fold``. Same columns as
    ``deque_fold``.
    """
    by = list(by)
    other = F.raise_error(F.concat(F.lit("deque_latest takes push and clear, not "), F.coalesce("op", F.lit("null"))))
    ops = ops.withColumn("op", F.when(F.col("op").isin("push", "clear"), F.col("op")).otherwise(other))
    cleared = ops.where("op = 'clear'").groupBy(*by).agg(F.max("seq").alias("_cleared"))
    newest = Window.partitionBy(*by).orderBy(F.col("seq").desc())
    # Pushes before the last clear rank behind those after it, so cutting to the
    # newest first and dropping cleared ones later gives the same rows.
    ranked = (
        ops.where("op = 'push'")
        .select(*by, "seq", "item")
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= capacity)
    )
    kept = join_on(ranked, cleared, by, "left").where("_cleared IS NULL OR seq > _cleared")
    count = F.count("*").over(Window.partitionBy(*by))
    return kept.select(
        *by, "seq",
        (count - F.col("_rank")).alias("pos"),
        (-F.col("_rank")).cast("bigint").alias("rpos"),
        "item",
    )


def deque_length(items: DataFrame, lookups: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """Each lookup with ``length`` and ``is_empty``; an unknown key counts 0."""
    lengths = items.groupBy(*by).agg(F.count("*").alias("length"))
    return join_on(lookups, lengths, by, "left").withColumns({
        "length": F.coalesce("length", F.lit(0)).cast("bigint"),
    }).withColumn("is_empty", F.col("length") == 0)


def deque_at(
    items: DataFrame, lookups: DataFrame, index: str = "i", by: Sequence[str] = OP_KEY
) -> DataFrame:
    """The item at an index: from the front when >= 0, from the back when negative.

    Out of range gives null. An index that is not a whole number gives null with
    ``error_category`` transient.
    """
    by = list(by)
    at = F.col(index).cast("double")
    whole = F.coalesce(at == F.floor(at), F.lit(False))
    asked = lookups.withColumns({
        "_pos": F.when(whole & (at >= 0), at.try_cast("bigint")),
        "_rpos": F.when(whole & (at < 0), at.try_cast("bigint")),
        "error_category": F.when(~whole, F.lit("transient")),
    })
    front = items.select(*by, F.col("pos").alias("_pos"), F.col("item").alias("_front"))
    back = items.select(*by, F.col("rpos").alias("_rpos"), F.col("item").alias("_back"))
    return (
        join_on(join_on(asked, front, [*by, "_pos"], "left"), back, [*by, "_rpos"], "left")
        .select(
            *lookups.columns,
            F.coalesce("_front", "_back").alias("item"),
            "error_category",
        )
    )


def deque_values(items: DataFrame, backward: bool = False, by: Sequence[str] = OP_KEY) -> DataFrame:
    """Items in queue order; a range-partitioned sort, so a long queue spreads out."""
    order = F.col("pos").desc() if backward else F.col("pos").asc()
    return items.select(*by, "pos", "item").orderBy(*by, order)
