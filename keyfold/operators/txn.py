"""Which state operations of an attempt survive, and for how long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.functions.times import micros
from keyfold.operators.scan import CHUNK_ROWS, Running, by_position, running
from keyfold.schema import OP_KEY


def committed_ops(
    ops: DataFrame,
    read_uncommitted: bool = False,
    by: Sequence[str] = OP_KEY,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Drop the operations that a rollback or a failed attempt undoes.

    ``ops`` has ``attempt`` and its ``outcome`` (``ok``, ``failed``, ``crashed``);
    ``commit`` and ``rollback`` are operations themselves. The next of these two
    after an operation decides: commit keeps it and rollback drops it. Where
    none follows, a successful attempt keeps it. With ``read_uncommitted`` a
    crashed attempt keeps it too; one that failed by an error does not.
    """
    control = F.when(F.col("op").isin("commit", "rollback"), F.col("op"))
    decided = running(
        ops, [*by, "attempt"], ["seq"], by_position("seq", chunk_rows),
        {"_next": Running("last", control)}, following=True, chunk_rows=chunk_rows,
    )
    finished = ["ok", "crashed"] if read_uncommitted else ["ok"]
    kept = F.coalesce(F.col("_next") == "commit", F.col("outcome").isin(finished))
    return decided.where(~F.col("op").isin("commit", "rollback") & kept).drop("_next")


def commit_log(
    ops: DataFrame,
    read_uncommitted: bool = False,
    by: Sequence[str] = OP_KEY,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The operations that ``committed_ops`` keeps, with ``commit_us``: when others may see them.

    That is the time of the commit that follows, or of the attempt's last operation.
    Attempts of a key follow each other, so commits never go back in time.
    """
    control = F.when(F.col("op").isin("commit", "rollback"), F.struct("op", micros("ts").alias("us")))
    decided = running(
        ops.withColumn("_us", micros("ts")), [*by, "attempt"], ["seq"], by_position("seq", chunk_rows),
        {"_next": Running("last", control), "_end": Running("max", F.col("_us"))}, following=True, chunk_rows=chunk_rows,
    )
    finished = ["ok", "crashed"] if read_uncommitted else ["ok"]
    kept = F.coalesce(F.col("_next.op") == "commit", F.col("outcome").isin(finished))
    seen = F.when(F.col("_next.op") == "commit", F.col("_next.us")).otherwise(F.col("_end"))
    return (decided.where(~F.col("op").isin("commit", "rollback") & kept)
            .withColumn("commit_us", seen).drop("_next", "_end", "_us"))


def unexpired(
    snapshot: DataFrame, ttl_seconds: int, asof, write_ts: str = "ts"
) -> DataFrame:
    """Items whose own last write is less than the TTL before ``asof``.

    ``asof`` is a column or a timestamp literal.
    """
    if ttl_seconds < 1:
        raise ValueError("ttl_seconds must be at least 1")
    asof = asof if hasattr(asof, "cast") else F.lit(asof)
    return snapshot.where(micros(write_ts) + ttl_seconds * 1_000_000 > micros(asof))
