"""Small frames from literals; times are seconds after a fixed instant."""

import datetime as dt
import os

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def records(spark, rows):
    """Rows ``(key, off, seconds, payload)`` of one topic and partition."""
    return spark.createDataFrame(
        [("t", 0, off, at(s), key, payload) for key, off, s, payload in rows],
        "topic string, part int, off long, ts timestamp, key string, payload string")


def ops(spark, rows, item="string"):
    """Rows ``(key, seq, op, map_key, item)``; the time is the sequence number."""
    return spark.createDataFrame(
        [("t", k, "c", seq, at(seq), op, mk, it) for k, seq, op, mk, it in rows],
        f"topic string, key string, collection string, seq long, ts timestamp, op string, "
        f"map_key string, item {item}")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def micro_batches(spark, folder, frames):
    """One file per frame, in order of modification, read one per micro-batch."""
    source = folder / "in"
    source.mkdir()
    for i, frame in enumerate(frames):
        part = folder / f"part{i}"
        frame.coalesce(1).write.parquet(str(part))
        target = source / f"{i:03}.parquet"
        next(p for p in part.iterdir() if p.suffix == ".parquet").rename(target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(source))
