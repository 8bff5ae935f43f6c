"""Run a streaming frame to the end of its input."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keyfold.session import shared_dir

#: Later than any timer, window or deadline.
END = dt.datetime(9000, 1, 1)

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def run_available(stream: DataFrame, name: str, partitions: int | None = None, event_time: bool = True) -> DataFrame:
    """Process everything available into files of the shared folder; read them back.

    ``name`` identifies the query: run again under the same name it continues
    from its checkpoint and adds what is new. Batches without data let timers of
    event time fire at the end; a stream on the wall clock (``event_time`` False) would
    go on with them for ever and ends with its input instead.
    """
    return _run(stream, name, partitions, event_time, lambda writer: writer.trigger(availableNow=True).start().awaitTermination())


def _run(stream: DataFrame, name: str, partitions: int | None, event_time: bool, until_done: Callable) -> DataFrame:
    spark = stream.sparkSession
    home = f"{shared_dir(spark)}/{name}"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    no_data = spark.conf.get(NO_DATA)
    spark.conf.set(NO_DATA, str(event_time).lower())
    if partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        until_done(
            stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{home}/checkpoint").option("path", f"{home}/rows"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set(NO_DATA, no_data)
    return spark.read.schema(stream.schema).parquet(f"{home}/rows")


def run_to_end(build: Callable[..., DataFrame], name: str, *inputs: tuple[DataFrame, Mapping[str, Any]]) -> DataFrame:
    """Run a stream of event time over all of its input and close what is still open then.

    A watermark only passes what later records have overtaken, so windows, timers and
    deadlines behind the last record stay open. ``build`` makes the stream from inputs that
    each end with a marker: the given values, a key of its own and ``ts`` at ``END`` among
    them. Markers are written once every record is in the state, while the stream still
    runs: a second run would load the state again beside the first one's files. The
    stream is closed for good: what comes later is late.
    Rows of the marker's own key are the caller's to drop.
    """
    spark, ended, markers = inputs[0][0].sparkSession, [], []
    for i, (stream, values) in enumerate(inputs):
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema.fields])
        folder = f"{shared_dir(spark)}/{name}-end{i}"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(folder)
        ended.append(stream.unionByName(spark.readStream.schema(schema).parquet(folder)))
        markers.append((folder, spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)))

    def until_closed(writer):
        query = writer.start()
        try:
            query.processAllAvailable()
            for folder, marker in markers:
                marker.write.mode("append").parquet(folder)
            query.processAllAvailable()
        finally:
            query.stop()

    return _run(build(*ended), name, None, True, until_closed)
