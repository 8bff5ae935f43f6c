"""Collections that hold whole messages, kept as references until read.

Folds move only ``item = struct(topic, part, off)``; the log is joined last and
only for the items that are left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.operators.deques import deque_fold
from keyfold.operators.maps import map_fold
from keyfold.operators.values import value_latest
from keyfold.schema import OP_KEY

MESSAGE_COLUMNS = ("ts", "key", "payload")
#: Columns of logs stored by range of offsets (``sources.log.write_chunked_log``): the range,
#: and the folder it is in. Ranges of few offsets share a folder of ``FOLDER_OFFSETS`` at most,
#: so that folders and files do not multiply with the records.
CHUNK, FOLDER = "off_chunk", "off_folder"
CHUNK_OFFSETS = FOLDER_OFFSETS = 1 << 20


def offset_chunk(off: Column | str, offsets: int = CHUNK_OFFSETS) -> Column:
    """The range of offsets that an offset lies in, by number."""
    off = F.col(off) if isinstance(off, str) else off
    return F.floor(off / F.lit(offsets)).cast("bigint")


def chunk_folder(chunk: Column | str, offsets: int = CHUNK_OFFSETS) -> Column:
    """The folder that holds a range of so many offsets, by number."""
    chunk = F.col(chunk) if isinstance(chunk, str) else chunk
    return F.floor(chunk / F.lit(max(1, FOLDER_OFFSETS // offsets))).cast("bigint")


def ref(topic: str = "topic", part: str = "part", off: str = "off") -> Column:
    return F.struct(
        F.col(topic).alias("topic"), F.col(part).alias("part"), F.col(off).alias("off")
    )


def resolve_refs(
    refs: DataFrame,
    log: DataFrame,
    item: str = "item",
    columns: Sequence[str] = MESSAGE_COLUMNS,
    chunk_offsets: int = CHUNK_OFFSETS,
) -> DataFrame:
    """Replace each reference by ``message``, null when the log no longer has it.

    Spark broadcasts the references where its size check allows it and otherwise
    shuffles both sides on the record position, which is unique per record. Of a log
    stored by ranges of offsets (columns ``off_chunk`` of ``chunk_offsets`` each, and ``off_folder``) only
    the folders that broadcast references point into are read, whatever the log's size.
    """
    chunked = CHUNK in log.columns
    found = log.select(
        F.struct("topic", "part", "off", *columns).alias("message"),
        F.col("topic").alias("_topic"), F.col("part").alias("_part"), F.col("off").alias("_off"),
        *([F.col(CHUNK).alias("_chunk"), F.col(FOLDER).alias("_folder")] if chunked else []),
    )
    at = F.col(item)
    same = (at["topic"] == F.col("_topic")) & (at["part"] == F.col("_part")) & (at["off"] == F.col("_off"))
    if not chunked:
        return refs.join(found, same, "left").drop("_topic", "_part", "_off")
    # Folders are pruned while the query runs, by the positions asked for: an inner join may
    # broadcast them, where they are small, and so tell the scan of the log before it starts.
    asked = refs.select(at["topic"].alias("_of_topic"), at["part"].alias("_of_part"), at["off"].alias("_of_off")).where("_of_off >= 0").distinct()
    asked = asked.withColumn("_of_chunk", offset_chunk("_of_off", chunk_offsets))
    asked = asked.withColumn("_of_folder", chunk_folder("_of_chunk", chunk_offsets))
    place = (F.col("_of_topic") == F.col("_topic")) & (F.col("_of_part") == F.col("_part")) & (F.col("_of_folder") == F.col("_folder"))
    hits = found.join(asked, place & (F.col("_of_chunk") == F.col("_chunk")) & (F.col("_of_off") == F.col("_off"))).select("message", "_topic", "_part", "_off")
    return refs.join(hits, same, "left").drop("_topic", "_part", "_off")


def message_value(ops: DataFrame, log: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    return resolve_refs(value_latest(ops, by), log)


def message_map(ops: DataFrame, log: DataFrame, by: Sequence[str] = OP_KEY) -> DataFrame:
    return resolve_refs(map_fold(ops, by), log)


def message_deque(
    ops: DataFrame, log: DataFrame, capacity: int | None = None, by: Sequence[str] = OP_KEY
) -> DataFrame:
    return resolve_refs(deque_fold(ops, capacity, by), log)


def reject_item_kind(ops: DataFrame, payload: str) -> tuple[DataFrame, DataFrame]:
    """Split writes by whether the item fits the collection's payload kind.

    ``ops`` has ``item`` (JSON text) and ``ref``; a ``json`` collection takes
    only the former and a ``message`` collection only the latter. Misfits are
    transient errors.
    """
    if payload not in ("json", "message"):
        raise ValueError(f'payload: expected "json" or "message", got {payload!r}')
    wanted, other = ("item", "ref") if payload == "json" else ("ref", "item")
    write = F.col("op").isin("set", "push", "unshift")
    bad = write & (F.col(wanted).isNull() | F.col(other).isNotNull())
    return ops.where(~bad), ops.where(bad).withColumn("error_category", F.lit("transient"))
