"""Which spans of time hold an instant, without comparing every span with every instant.

Time is cut into leaves of ``LEAF_US``, and leaves are paired up into a binary tree. A span
is written as the fewest nodes of the tree that cover its whole leaves, and its two
ends as the leaves they lie in: some twice the depth of the tree at most, however
long it is. An instant lies in one node of each depth. So a span meets an instant by
equality of one node, and exactly once; only ends are compared.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.operators.anchored import key_at, key_changes
from keyfold.operators.joins import join_on

LEAF_US = 1 << 30  # 18 minutes
#: Doublings of a leaf: 35,000 years.
DEPTH = 30
_END = -1  # leaves that a span covers in part


def _node(depth: Column, number: Column) -> Column:
    return F.struct(depth.cast("int").alias("depth"), number.cast("bigint").alias("number"))


def _leaf(us: Column) -> Column:
    return F.floor(us / F.lit(LEAF_US)).cast("bigint")


def cover(start_us: Column, end_us: Column, depth: int = DEPTH, base: int = 0) -> Column:
    """The nodes of the half-open span; an empty span has none. Leaves count from ``base``."""
    first, last = _leaf(start_us) - base, _leaf(end_us - 1) - base

    def at(depth: Column) -> Column:
        # whole nodes of this depth inside what is covered, as far as none above covers them
        low = -F.call_function("shiftright", -(first + 1), depth)  # rounded up
        high = F.call_function("shiftright", last, depth)
        left = F.when((low < high) & (low % 2 != 0), _node(depth, low))
        right = F.when((low < high) & (high % 2 != 0), _node(depth, high - 1))
        return F.array(left, right)

    whole = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(depth)), at))
    ends = F.array(_node(F.lit(_END), first), F.when(last > first, _node(F.lit(_END), last)))
    return F.when(end_us > start_us, F.array_compact(F.concat(ends, whole))).otherwise(F.array().cast(
        "array<struct<depth:int,number:bigint>>"))


def _up(leaf: Column, depth: int) -> Column:
    """The nodes that hold a leaf as a whole, one of each depth."""
    return F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda d: _node(d, F.call_function("shiftright", leaf, d)))


def above(us: Column, depth: int = DEPTH, base: int = 0) -> Column:
    """The nodes that hold an instant, one of each depth."""
    leaf = _leaf(us) - base
    return F.concat(F.array(_node(F.lit(_END), leaf)), _up(leaf, depth))


def _covered(instants: DataFrame, spans: DataFrame, at_us: str, start_us: str, end_us: str) -> tuple[DataFrame, int, int]:
    """Spans by their nodes, in a tree no higher than the time between the first instant and the last.

    What spans hold before and after is not asked for; the leaf of the first instant is
    number 0. Runs a job on the instants' time. Also the tree's depth and its first leaf.
    """
    low, high = instants.agg(F.min(at_us), F.max(at_us)).first()
    low, high = (0, 0) if low is None else (low, high)
    base = low // LEAF_US
    depth = (high // LEAF_US - base).bit_length()
    start, end = F.greatest(F.col(start_us), F.lit(low)), F.least(F.col(end_us), F.lit(high + 1))
    start = F.when(F.col(start_us).isNotNull(), start)
    return spans.select("*", F.inline(cover(start, end, depth, base))), depth, base


def stab(instants: DataFrame, spans: DataFrame, by: Sequence[str], at_us: str, start_us: str = "from_us", end_us: str = "to_us") -> DataFrame:
    """Every pair of an instant and a span of its key that holds it; spans are half open.

    Columns of both, those of ``by`` once; other columns must not share names. A null
    end never ends. A missing key is a key like any other.
    """
    by = list(by)
    far = F.lit((1 << (30 + DEPTH)) - 1)
    spans = spans.withColumn(end_us, F.coalesce(F.col(end_us), far))
    covered, depth, base = _covered(instants, spans, at_us, start_us, end_us)
    asked = instants.select("*", F.inline(above(F.col(at_us), depth, base)))
    # Spark takes both sides for as small as the files they come from: without the hint it
    # would send one of them, many rows per row there, through the driver.
    met = join_on(asked, covered.hint("merge"), [*by, "depth", "number"])
    return met.where((F.col(at_us) >= F.col(start_us)) & (F.col(at_us) < F.col(end_us))).drop("depth", "number")


def least_held(
    instants: DataFrame, spans: DataFrame, by: Sequence[str], at_us: str, row: str, value: str,
    start_us: str = "from_us", end_us: str = "to_us",
) -> DataFrame:
    """``row`` of each instant and the least ``value`` (a string or an integer) of the spans of its key that hold it, or null.

    No pairs are formed. Of the spans that hold a whole leaf only the least value of each
    node counts; spans that begin or end in a leaf are swept through it in the
    order of time, from key to key and leaf to leaf, with those still open in a heap.
    Keys, nulls and ends are as in ``stab``; without a time a row has no answer.
    """
    by = list(by)
    far = F.lit((1 << (30 + DEPTH)) - 1)
    spans = spans.where(F.col(value).isNotNull()).select(
        *by, F.col(value).alias("_value"), F.col(start_us).alias("_from"), F.coalesce(F.col(end_us), far).alias("_to"))
    asked = instants.select(*by, F.col(at_us).alias("_at"), F.col(row).alias("_row")).where("_at IS NOT NULL")
    covered, depth, base = _covered(asked, spans, "_at", "_from", "_to")
    leaf = (_leaf(F.col("_at")) - base).alias("_leaf")
    nodes = covered.where(F.col("depth") >= 0).groupBy(*by, "depth", "number").agg(F.min("_value").alias("_value"))
    leaves = asked.select(*by, leaf).distinct().select("*", F.inline(_up(F.col("_leaf"), depth)))
    first = (F.col("_leaf") + base) * LEAF_US
    whole = join_on(leaves, nodes.hint("merge"), [*by, "depth", "number"]).groupBy(*by, "_leaf").agg(F.min("_value").alias("_value")).select(
        *by, "_leaf", first.alias("_at"), (first + LEAF_US).alias("_to"), "_value")
    parts = covered.where(F.col("depth") == _END).select(
        *by, F.col("number").alias("_leaf"), F.col("_from").alias("_at"), "_to", "_value")
    line = asked.select(*by, leaf, "_at", "_row", F.lit(True).alias("_asks")).unionByName(
        whole.unionByName(parts).withColumn("_asks", F.lit(False)), allowMissingColumns=True)
    place = [*by, "_leaf"]
    swept = line.repartition(*place).sortWithinPartitions(*place, "_at", "_asks")
    out = T.StructType([T.StructField(row, instants.schema[row].dataType), T.StructField(value, spans.schema["_value"].dataType)])
    return swept.mapInArrow(_sweep(place, row, value), out)


def _sweep(place: list[str], row: str, value: str):
    """Answers sorted rows of ``place``: spans enter a heap, rows that ask see its least value that has not ended."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, previous = [], None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            fresh = key_changes(batch, place, previous)
            columns = [batch.column(c).to_pylist() for c in ("_at", "_to", "_value")]
            asks, answers = batch.column("_asks"), []
            for new, ask, at, to, least in zip(fresh.tolist(), asks.to_pylist(), *columns):
                if new:
                    held = []
                if not ask:
                    heapq.heappush(held, (least, to))
                    continue
                while held and held[0][1] <= at:
                    heapq.heappop(held)
                answers.append(held[0][0] if held else None)
            previous = key_at(batch, place, batch.num_rows - 1)
            rows = batch.column("_row").filter(asks)
            yield pa.RecordBatch.from_arrays([rows, pa.array(answers, type=batch.column("_value").type)], names=[row, value])

    return sweep
