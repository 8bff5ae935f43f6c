"""Anchored windows: a record opens a window, the first one after it the next.

The first record of a key at ``t`` opens ``[t, round(t + width))``; the first
record at or after that end opens the following window. Deduplication with a
time to live, notification windows and stale reads are all of this form.

Window ends lie on whole units (seconds for timers), so the record that opens a
window is always the first of its unit. One row per ``(key, unit)`` is therefore
enough to find every window. That row comes out of a map-side minimum, and the
ordered pass below sees at most one row per unit of elapsed time for a key, no
matter how many records share the key.

A key crowded over a long time still has many such rows. It is cut into blocks of time,
which tasks work on side by side: for each row of a block, were it to open a window,
an exit pointer tells the last window opened in the block from there on. Pointers of
neighbouring rows are mostly alike, so a block shrinks to the few rows where they
change. A walk over one such table per block then finds the window open where
each block begins, and the blocks are labelled side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions.times import units
from keyfold.operators import scan
from keyfold.operators.joins import join_on

SECOND_US = 1_000_000
MILLISECOND_US = 1_000
#: Units of time in a block, or this many widths if that is more: chains that start in
#: different rows then meet inside a block, or at least differ by a width at most.
BLOCK_UNITS = 1 << 18
BLOCK_WIDTHS = 4
_NO_WINDOW = -(1 << 62)


def key_changes(batch: pa.RecordBatch, by: Sequence[str], previous: tuple | None) -> np.ndarray:
    """True where a row's key differs from the row before it."""
    n = batch.num_rows
    changed = np.zeros(n, dtype=bool)
    for name in by:
        column = batch.column(name)
        if n > 1:
            here, above = column.slice(1), column.slice(0, n - 1)
            # null is a key too: it differs from all others and not from itself
            differs = pc.coalesce(pc.not_equal(here, above), pc.xor(here.is_null(), above.is_null()))
            changed[1:] |= differs.to_numpy(zero_copy_only=False)
    changed[0] = previous is None or key_at(batch, by, 0) != previous
    return changed


def key_at(batch: pa.RecordBatch, by: Sequence[str], i: int) -> tuple:
    return tuple(batch.column(name)[i].as_py() for name in by)


def _open_windows(by: list[str], width_us: int, unit_us: int, half_up: bool, entered: bool = False):
    """Labels sorted rows of ``by`` and ``slot`` with their windows.

    With ``entered`` a key is a block of a longer one, and ``in_start``, ``in_tie`` and
    ``in_end`` give the window that is open where the block begins.
    """
    shift = unit_us // 2 if half_up else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, open_start, open_tie, open_end = None, 0, 0, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            new_key = key_changes(batch, by, last_key)
            slot = batch.column("slot").to_numpy()
            first_us = batch.column("first_us").to_numpy()
            first_tie = batch.column("first_tie").to_numpy()
            end = (first_us + width_us + shift) // unit_us
            # Lay the keys of the batch side by side on one line: a search for a
            # window's end then stops at the next key by itself.
            base = slot.min()
            span = max(int(end.max()), int(slot.max())) - base + 1
            lane = np.cumsum(new_key) * span
            position = lane + slot - base
            following = np.searchsorted(position, lane + end - base).tolist()
            # where a key begins, the first row that opens a window
            entry = np.arange(n)
            if entered:
                entry = np.searchsorted(position, lane + np.clip(batch.column("in_end").to_numpy() - base, 0, span - 1))
            starts_key = new_key.tolist()
            i = 0
            if not new_key[0]:
                i = int(np.searchsorted(position, lane[0] + min(max(open_end - base, 0), span - 1)))
            opens = []
            while i < n:
                if starts_key[i] and entry[i] != i:
                    i = int(entry[i])
                    continue
                opens.append(i)
                i = following[i]
            opener = np.full(n, -1)
            opener[opens] = opens
            opener = np.maximum.accumulate(opener)
            begin = np.maximum.accumulate(np.where(new_key, np.arange(n), -1))
            inside = opener >= np.maximum(begin, 0)
            before = [np.full(n, v) for v in (open_start, open_tie, open_end)]
            if entered:
                before = [np.where(begin >= 0, batch.column(c).to_numpy(), b) for c, b in zip(("in_start", "in_tie", "in_end"), before)]
            starts = np.where(inside, first_us[opener], before[0])
            ties = np.where(inside, first_tie[opener], before[1])
            ends = np.where(inside, end[opener], before[2])
            last_key = key_at(batch, by, n - 1)
            open_start, open_tie, open_end = int(starts[-1]), int(ties[-1]), int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in by], batch.column("slot"),
                 pa.array(starts), pa.array(ties), pa.array(ends * unit_us),
                 pa.array(opener == np.arange(n))],
                names=[*by, "slot", "start_us", "start_tie", "end_us", "opens"],
            )

    return run


def exits(slot: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block after which the exit pointer changes, and those pointers.

    The pointer of a row is the last row that opens a window if the row itself does.
    """
    last = np.arange(len(slot))
    jump = np.searchsorted(slot, end)
    while True:
        inner = np.flatnonzero(jump < len(slot))
        if not len(inner):
            break
        # twice as far with each turn
        last[inner], jump[inner] = last[jump[inner]], np.append(jump, len(slot))[jump[inner]]
    change = np.flatnonzero(np.append(last[1:] != last[:-1], True))
    return change, last[change]


def _block_exits(by: list[str], width_us: int, unit_us: int, half_up: bool):
    """One row per key and block: the exit pointers as lists, where they change."""
    shift = unit_us // 2 if half_up else 0
    group = [*by, "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the block that goes on

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            slot, first_us = rows["slot"].to_numpy(), rows["first_us"].to_numpy()
            end = (first_us + width_us + shift) // unit_us
            upto, last = exits(slot, end)
            lists = [slot[upto], end[last], first_us[last], rows["first_tie"].to_numpy()[last]]
            return pa.RecordBatch.from_arrays(
                [*(rows[c].chunk(0).slice(0, 1) for c in group), *(pa.array([x], pa.list_(pa.int64())) for x in lists)],
                names=[*group, "upto", "exit_end", "exit_start", "exit_tie"])

        last_key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = [*np.flatnonzero(key_changes(batch, group, last_key)).tolist(), batch.num_rows]
            if cut[0] > 0:
                held.append(batch.slice(0, cut[0]))
            for a, b in zip(cut, cut[1:]):
                if held:
                    yield block()
                    held = []
                held.append(batch.slice(a, b - a))
            last_key = key_at(batch, group, batch.num_rows - 1)
        if held:
            yield block()

    return run


def _walk(by: list[str]):
    """The window open where each block begins, from blocks in order: one step a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, (0, 0, _NO_WINDOW)
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                own = key_at(batch, by, i)
                if own != key:
                    key, state = own, (0, 0, _NO_WINDOW)
                found.append(state)
                upto, end, start, tie = (batch.column(c)[i].values.to_numpy() for c in ("upto", "exit_end", "exit_start", "exit_tie"))
                at = int(np.searchsorted(upto, state[2]))
                if at < len(upto):
                    state = int(start[at]), int(tie[at]), int(end[at])
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in by), batch.column("block"), *columns],
                                             names=[*by, "block", "in_start", "in_tie", "in_end"])

    return run


def _crowded(df: DataFrame, by: list[str], slot, chunk_rows: int) -> scan.Hot:
    """Keys with too many slots for one task; none can have them where the whole table spans fewer."""
    limit = chunk_rows * scan.HOT_CHUNKS
    low, high = df.agg(F.min(slot), F.max(slot)).first()
    if low is None or high - low < limit:
        return scan.Hot(False)
    return scan.hot_keys(df, by, chunk_rows)


def _in_blocks(firsts: DataFrame, by: list[str], width_us: int, unit_us: int, half_up: bool, block_units: int, out: T.StructType) -> DataFrame:
    group = [*by, "block"]
    rows = firsts.withColumn("block", F.floor(F.col("slot") / block_units).cast("bigint"))
    keys = [firsts.schema[c] for c in by]
    number, numbers = T.LongType(), T.ArrayType(T.LongType())
    tables = T.StructType([*keys, T.StructField("block", number), *(T.StructField(c, numbers) for c in ("upto", "exit_end", "exit_start", "exit_tie"))])
    entries = T.StructType([*keys, *(T.StructField(c, number) for c in ("block", "in_start", "in_tie", "in_end"))])
    # One shuffle of the rows serves both passes: blocks stay where they are, and the few
    # rows that tell what each is entered with come to them.
    dealt = rows.repartition(*group).sortWithinPartitions(*group, "slot")
    found = dealt.mapInArrow(_block_exits(by, width_us, unit_us, half_up), tables)
    entered = found.repartition(*by).sortWithinPartitions(*group).mapInArrow(_walk(by), entries)
    # a crowded key is never null
    placed = dealt.join(entered.repartition(*group), group).sortWithinPartitions(*group, "slot")
    labelled = T.StructType([*keys, T.StructField("block", number), *out.fields[len(by):]])
    return placed.mapInArrow(_open_windows(group, width_us, unit_us, half_up, entered=True), labelled).drop("block")


def anchored_slots(
    df: DataFrame,
    by: Sequence[str],
    us: str,
    width_us: int,
    unit_us: int = SECOND_US,
    half_up: bool = True,
    tie: str | None = None,
    chunk_rows: int = scan.CHUNK_ROWS,
    block_units: int | None = None,
) -> DataFrame:
    """One row per ``(key, slot)`` that has records, with the window it lies in.

    ``slot`` is the instant divided by the unit; columns ``start_us``, ``end_us``
    give the window and ``opens`` is true where the slot's first record opens it.
    With ``tie``, a bigint column that orders records of one instant, ``start_tie``
    is its value for the record that opened the window. Keys with more rows than
    ``chunk_rows`` times ``scan.HOT_CHUNKS`` are worked on in blocks of time of
    ``block_units``.
    """
    if width_us < unit_us:
        raise ValueError("a window must last at least one unit")
    by = list(by)
    block_units = block_units or max(BLOCK_UNITS, BLOCK_WIDTHS * (width_us // unit_us))
    hot = _crowded(df, by, units(us, unit_us), chunk_rows)
    slot = units(us, unit_us).alias("slot")
    if tie is None:
        firsts = df.groupBy(*by, slot).agg(F.min(us).alias("first_us")).withColumn(
            "first_tie", F.lit(0).cast("bigint")
        )
    else:
        first = F.min(F.struct(F.col(us).alias("first_us"), F.col(tie).alias("first_tie")))
        firsts = df.groupBy(*by, slot).agg(first.alias("_f")).select(*by, "slot", "_f.*")
    out = T.StructType([
        *[firsts.schema[c] for c in by],
        T.StructField("slot", T.LongType()),
        T.StructField("start_us", T.LongType()),
        T.StructField("start_tie", T.LongType()),
        T.StructField("end_us", T.LongType()),
        T.StructField("opens", T.BooleanType()),
    ])
    marked = hot.mark(firsts, by)
    plain = marked.where("not _hot").drop("_hot") if hot.any else firsts
    labelled = (
        plain.repartition(*by)
        .sortWithinPartitions(*by, "slot")
        .mapInArrow(_open_windows(by, width_us, unit_us, half_up), out)
    )
    if not hot.any:
        return labelled
    crowded = marked.where("_hot").drop("_hot").select(*firsts.columns)
    return labelled.unionByName(_in_blocks(crowded, by, width_us, unit_us, half_up, block_units, out))


def assign_windows(
    df: DataFrame,
    by: Sequence[str],
    us: str,
    width_us: int,
    unit_us: int = SECOND_US,
    half_up: bool = True,
    tie: str | None = None,
    chunk_rows: int = scan.CHUNK_ROWS,
    block_units: int | None = None,
) -> DataFrame:
    """Every record with ``start_us``, ``start_tie`` and ``end_us`` of its window."""
    slots = anchored_slots(df, by, us, width_us, unit_us, half_up, tie, chunk_rows, block_units).drop("opens")
    return join_on(df.withColumn("slot", units(us, unit_us)), slots, [*by, "slot"]).drop("slot")
