"""Row shapes shared by all operators.

Every operator works on the logical key ``(topic, key)``: equal keys of two
topics never meet. ``off`` is the position of a record in its topic partition
and ``seq`` the position of an operation in its log; both are unique per key,
integer and rising in delivery order, which is what lets long histories be cut
into chunks (see ``operators.scan``).
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["topic", "key"]
OP_KEY = ["topic", "key", "collection"]

RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("off", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("source_system", T.StringType()),
])

STATE_OP = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("collection", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("op", T.StringType()),
    T.StructField("map_key", T.StringType()),
    T.StructField("item", T.StringType()),
])

TIMER_OP = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("op", T.StringType()),
    T.StructField("fire_at", T.TimestampType()),
])

ATTEMPT = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("off", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("record_no", T.LongType()),
    T.StructField("attempt_no", T.LongType()),
    T.StructField("class", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("error_class", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
])

REF = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("off", T.LongType()),
])
