"""Value collections: at most one item per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.times import micros
from keyfold.operators.scan import CHUNK_ROWS, Running, by_position, hot_keys, running
from keyfold.schema import KEY, OP_KEY


def value_latest(ops: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    """The item each key holds after its whole log; cleared keys are absent."""
    last = F.max_by(F.struct("op", "item", "ts"), "seq").alias("last")
    return (
        ops.where(F.col("op").isin("set", "clear"))
        .groupBy(*by)
        .agg(last, F.max("seq").alias("seq"))
        .where("last.op = 'set'")
        .select(*by, "seq", "last.ts", "last.item")
    )


def value_asof(
    ops: DataFrame, by: Sequence[str] = OP_KEY, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Every operation with ``current``, the item visible right after it.

    Writes see themselves and reads (``get``) the last write before them.
    """
    write = F.when(F.col("op").isin("set", "clear"), F.struct("op", "item"))
    seen = running(
        ops, by, ["seq"], by_position("seq", chunk_rows), {"_w": Running("last", write)},
        chunk_rows=chunk_rows,
    )
    return seen.withColumn("current", F.when(F.col("_w.op") == "set", F.col("_w.item"))).drop("_w")


def keyed_counter(
    records: DataFrame,
    ttl_seconds: int,
    by: Sequence[str] = KEY,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Count each key's records (``count``), from 1 again once idle for the TTL.

    Inside a chunk of a hot key the count starts over at each idle gap; a
    chunk-level pass finds what the chunk takes over from the ones before it.
    """
    ttl_us = ttl_seconds * 1_000_000
    hot = hot_keys(records, by, chunk_rows)
    group = [*by, "_part", "_chunk"] if hot.any else list(by)
    rows = hot.mark(records.withColumn("_us", micros("ts")), by).withColumns({
        "_part": F.when(F.col("_hot"), F.col("part")).otherwise(0),
        "_chunk": F.when(F.col("_hot"), by_position("off", chunk_rows)).otherwise(0),
    })
    inside = Window.partitionBy(*group).orderBy("part", "off")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumns({
        "_n": F.row_number().over(inside).cast("bigint"),
        "_idle": F.col("_us") - F.lag("_us").over(inside) >= ttl_us,
    }).withColumn("_base", F.max(F.when(F.col("_idle"), F.col("_n") - 1)).over(upto))

    inner = F.col("_n") - F.coalesce("_base", F.lit(0))
    if not hot.any:
        return numbered.select(*records.columns, inner.alias("count"))

    per_chunk = numbered.where("_hot").groupBy(*group).agg(
        F.min_by("_us", "off").alias("first_us"),
        F.max_by("_us", "off").alias("last_us"),
        F.max("_n").alias("n"),
        F.max("_base").alias("base"),
    )
    chunks = Window.partitionBy(*by).orderBy("_part", "_chunk")
    sofar = chunks.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(sofar)
    carried = (
        per_chunk.withColumns({
            "_fresh": F.coalesce(
                F.col("first_us") - F.lag("last_us").over(chunks) >= ttl_us, F.lit(True)
            ),
            "_total": total,
        })
        # rows of the key before the last restart seen so far
        .withColumn("_restart", F.last(
            F.when(F.col("base").isNotNull(), F.col("_total") - F.col("n") + F.col("base"))
            .when(F.col("_fresh"), F.col("_total") - F.col("n")),
            ignorenulls=True,
        ).over(sofar))
        .withColumn("_carry", F.when(
            ~F.col("_fresh"), F.lag(F.col("_total") - F.col("_restart")).over(chunks)
        ))
        .where("_carry IS NOT NULL")
        .select(*group, "_carry")
    )
    count = inner + F.when(F.col("_base").isNull(), F.coalesce("_carry", F.lit(0))).otherwise(0)
    return numbered.join(carried, group, "left").select(
        *records.columns, count.alias("count")
    )
