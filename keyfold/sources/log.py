"""Reading and writing keyed record logs: Kafka, files, batch or stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions.payload import encode_payload, with_event_metadata
from keyfold.operators.refs import CHUNK, CHUNK_OFFSETS, FOLDER, chunk_folder, offset_chunk
from keyfold.schema import ATTEMPT, RECORD

SOURCE_HEADER = "source-system"


def _header(name: str) -> Column:
    found = F.filter(F.col("headers"), lambda h: h["key"] == name)
    return F.try_element_at(found, F.lit(1))["value"].cast("string")


def from_kafka(raw: DataFrame) -> DataFrame:
    """Kafka's columns as records; ``value`` stays beside ``payload`` as bytes."""
    return raw.select(
        "topic",
        F.col("partition").alias("part"),
        F.col("offset").alias("off"),
        F.col("timestamp").alias("ts"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("payload"),
        _header(SOURCE_HEADER).alias("source_system"),
        "value",
    )


def read_log(
    spark: SparkSession,
    topics: str | Sequence[str] | None = None,
    *,
    path: str | None = None,
    format: str = "kafka",
    stream: bool = False,
    options: Mapping[str, str] | None = None,
    metadata: bool = True,
) -> DataFrame:
    """Records of one or more topics, with event id and type from the payload.

    ``format`` ``kafka`` subscribes to ``topics``; any file format reads records
    in canonical columns from ``path`` and keeps the given topics.
    """
    reader = (spark.readStream if stream else spark.read).format(format)
    topics = [topics] if isinstance(topics, str) else list(topics or [])
    reader = reader.options(**(options or {}))
    if format == "kafka":
        reader = reader.option("subscribe", ",".join(topics)).option("includeHeaders", "true")
        log = from_kafka(reader.load()).drop("value")
    else:
        log = reader.schema(RECORD).load(path)
        if topics:
            log = log.where(F.col("topic").isin(topics))
    return with_event_metadata(log) if metadata else log


def read_attempts(
    spark: SparkSession,
    path: str,
    *,
    format: str = "parquet",
    stream: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Handler attempts (starts, outcomes, durations) written as files."""
    reader = (spark.readStream if stream else spark.read).format(format).schema(ATTEMPT)
    return reader.options(**(options or {})).load(path)


def write_chunked_log(log: DataFrame, path: str, chunk_offsets: int = CHUNK_OFFSETS) -> None:
    """Writes records by topic, partition and range of ``chunk_offsets`` offsets.

    References then find their records without a scan of the log (``operators.refs``).
    A folder has one range, or as many small ones as fit into ``refs.FOLDER_OFFSETS``
    offsets. Rows of one folder are spread over a few files by their offset, in order.
    """
    rows = log.withColumn(CHUNK, offset_chunk("off", chunk_offsets)).withColumn(FOLDER, chunk_folder(CHUNK, chunk_offsets))
    place = ["topic", "part", FOLDER]
    rows.repartitionByRange(*place, "off").sortWithinPartitions(*place, "off").write.partitionBy(*place).parquet(path)


def read_chunked_log(spark: SparkSession, path: str) -> DataFrame:
    """Records in canonical columns, and the range of offsets and the folder they are stored in."""
    stored = [T.StructField(c, T.LongType()) for c in (CHUNK, FOLDER)]
    return spark.read.schema(T.StructType([*RECORD.fields, *stored])).parquet(path)


def split_excise(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages, and excise records (a key without a payload)."""
    return log.where(F.col("payload").isNotNull()), log.where(F.col("payload").isNull())


def split_keyless(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with a key, and those without with ``error_category`` permanent.

    Operators take a missing key for a key like any other; deques refuse it.
    """
    keyless = log.where(F.col("key").isNull()).withColumns({
        "error_category": F.lit("permanent"),
        "error_message": F.lit("record has no key"),
    })
    return log.where(F.col("key").isNotNull()), keyless


def outgoing(records: DataFrame, source_system: str) -> DataFrame:
    """Records as Kafka rows: ``topic, key, value, headers``.

    ``payload`` may be JSON text or any struct, array or map. A null payload is
    refused here: tombstones go through ``outgoing_excise``.
    """
    text = records.schema["payload"].dataType == T.StringType()
    value = F.col("payload") if text else encode_payload(records, "payload")
    value = F.when(
        value.isNull(), F.raise_error(F.lit("payload has no JSON form; use write_excise"))
    ).otherwise(value)
    return records.select("topic", "key", value.alias("value"), _headers(source_system))


def outgoing_excise(keys: DataFrame, source_system: str) -> DataFrame:
    """One tombstone per row: a key with a null value."""
    return keys.select(
        "topic", "key", F.lit(None).cast("string").alias("value"), _headers(source_system)
    )


def _headers(source_system: str) -> Column:
    return F.array(
        F.struct(F.lit(SOURCE_HEADER).alias("key"), F.lit(source_system).cast("binary").alias("value"))
    ).alias("headers")


def _save(rows: DataFrame, format: str, options: Mapping[str, str], path: str | None):
    writer = rows.write.format(format).options(**options).mode("append")
    if format == "kafka":
        writer.option("includeHeaders", "true").save()
    else:
        writer.partitionBy("topic").save(path)


def write_log(
    records: DataFrame,
    source_system: str,
    *,
    format: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Publish records, to Kafka or to files partitioned by topic."""
    _save(outgoing(records, source_system), format, options or {}, path)


def write_excise(
    keys: DataFrame,
    source_system: str,
    *,
    format: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Publish a tombstone for every ``(topic, key)`` row."""
    _save(outgoing_excise(keys, source_system), format, options or {}, path)


def dead_letters(routed: DataFrame, failure_topic: str) -> DataFrame:
    """The records whose ``disposition`` is ``dead_letter``, addressed to the topic.

    The original topic goes into ``from_topic``.
    """
    return routed.where("disposition = 'dead_letter'").withColumns({
        "from_topic": F.col("topic"), "topic": F.lit(failure_topic),
    })


def write_dead_letters(failure_topic: str, path: str, format: str = "parquet"):
    """A ``foreachBatch`` function that appends a batch's dead letters.

    The folder of a batch is named after its query and its id and overwritten when the
    batch is repeated, so nothing is written twice. A query keeps its id with its
    checkpoint; one with a new checkpoint writes beside the letters of earlier ones.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        dead_letters(batch, failure_topic).write.format(format).mode("overwrite").save(
            f"{path}/query={query}/batch={batch_id}"
        )

    return write
