"""Payloads, filters, order, duplicates and excise records."""

import json
import random

import pytest
from fixtures import at, records, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.functions import filters, payload
from keyfold.functions.times import round_timer
from keyfold.operators import excise, sequence
from keyfold.sources import log


def test_event_types_match_from_the_start(spark):
    df = spark.createDataFrame([(t,) for t in (
        "user.created", "account.deleted", "admin.user.created", "my.account.deleted", "notification", None)],
        "type string")
    kept = df.where(filters.allowed_event("type", ["user.", "account."]))
    assert rows(kept, "type") == [("account.deleted",), ("user.created",), (None,)]
    assert df.where(filters.allowed_event("type", "user.")).count() == 2
    assert df.where(filters.allowed_event("type", [])).count() == 6


def test_own_records_are_skipped(spark):
    df = spark.createDataFrame([("mine",), ("other",), (None,)], "s string")
    assert rows(df.where(filters.from_elsewhere("s", "mine")), "s") == [("other",), (None,)]


GOOD = ['{"a":1}', "null", "1", '"x"', "[1,2]", " 3 ", "1e5", '{"a":1,"a":2}', '{"id":"i","type":"t"}']
BAD = ["", "{", '"k": 69}', "{} tail", "1, 2", "1] , [2", '1}{"a":2', '1,"b":2', "NaN", "01", "tru", "[1,2",
       "{'a':1}", '{"a":}']


def test_whole_payload_must_be_json(spark):
    df = spark.createDataFrame([(p,) for p in [*GOOD, *BAD, None]], "payload string")
    parsed, broken = payload.decode_payload(df)
    assert rows(parsed, "payload") == sorted(((p,) for p in GOOD), key=repr)
    assert rows(broken, "payload", "error_category") == sorted(((p, "permanent") for p in BAD), key=repr)
    typed, _ = payload.decode_payload(df.where("payload like '{%'"), T.StructType([T.StructField("a", T.LongType())]))
    assert rows(typed, "document.a") == [(1,), (2,), (None,)]


def test_metadata_only_from_strings(spark):
    df = spark.createDataFrame([(p,) for p in (
        '{"id":"i","type":"t"}', '{"id":1,"type":"t"}', '{"id":null}', "[1]", '"id"', '{"id":"i"} tail')],
        "payload string")
    got = payload.with_event_metadata(df)
    assert rows(got, "event_id", "event_type") == [
        ("i", "t"), (None, "t"), (None, None), (None, None), (None, None), (None, None)]


def test_rich_value_round_trip(spark):
    kind = "s string, n double, b boolean, arr array<string>, nested struct<z:array<double>>"
    rich = ("café 😀", 3.5, True, ["1", "x", None], ([float("nan"), 2.0],))
    df = spark.createDataFrame([(rich,), (None,)], f"v struct<{kind.replace(' ', ':').replace(',:', ',')}>")
    texts = [r[0] for r in df.select(payload.encode_payload(df, "v")).collect()]
    assert json.loads(texts[0]) == {"s": "café 😀", "n": 3.5, "b": True, "arr": ["1", "x", None],
                                    "nested": {"z": [None, 2.0]}}
    assert texts[1] is None
    scalar = spark.createDataFrame([(1.5,), (float("inf"),), (None,)], "v double")
    assert [r[0] for r in scalar.select(payload.encode_payload(scalar, "v")).collect()] == ["1.5", "null", None]


def test_bytes_must_be_utf8(spark):
    df = spark.createDataFrame([(bytearray("é".encode()),), (bytearray(b"\xc3"),), (None,)], "value binary")
    good, bad = payload.validate_utf8(df)
    assert rows(good, "payload") == [("é",), (None,)]
    assert rows(bad, "error_category") == [("permanent",)]


def test_timer_times_round_half_up(spark):
    df = spark.sql("SELECT timestamp_micros(x) AS t FROM VALUES (1499999), (1500000), (2000000) v(x)")
    assert [r[0].second for r in df.select(round_timer("t")).collect()] == [1, 2, 2]


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_records_of_a_key_stay_in_order(spark, chunk):
    df = records(spark, [("key1", 0, 0, "1"), ("key2", 1, 0, "1"), ("key1", 2, 0, "2"),
                         ("key3", 3, 0, "1"), ("key2", 4, 0, "2")])
    got = sequence.per_key_sequence(df, chunk_rows=chunk)
    assert rows(got, "key", "n", "payload") == [
        ("key1", 1, "1"), ("key1", 2, "2"), ("key2", 1, "1"), ("key2", 2, "2"), ("key3", 1, "1")]


def test_duplicates_are_per_key_and_id(spark):
    df = records(spark, [("key1", 0, 0, "msg-123"), ("key1", 1, 5, "msg-123"), ("key2", 2, 6, "msg-123"),
                         ("key1", 3, 7, None), ("key1", 4, 8, None), ("key1", 5, 100, "msg-123")])
    keep = [("key1", 0), ("key1", 3), ("key1", 4), ("key2", 2)]
    assert rows(sequence.first_occurrences(df, "payload"), "key", "off") == keep
    assert rows(sequence.dedup_ttl(df, 100, "payload"), "key", "off") == sorted([*keep, ("key1", 5)])
    assert rows(sequence.dedup_ttl(df, 101, "payload"), "key", "off") == keep


def test_ttl_counts_from_the_kept_record(spark):
    rng = random.Random(2)
    log_rows = [("hot" if i % 3 else f"k{i % 4}", i, rng.randrange(0, 2000), f"id{i % 3}") for i in range(300)]
    want, until = set(), {}
    for key, off, s, i in sorted(log_rows, key=lambda r: (r[2], r[1])):
        if s >= until.get((key, i), -1):
            until[key, i] = s + 60
            want.add(off)
    got = sequence.dedup_ttl(records(spark, log_rows), 60, "payload")
    assert {r.off for r in got.select("off").collect()} == want


def test_version_forgets_history(spark):
    df = records(spark, [("a", 0, 0, "x"), ("a", 1, 0, "y")])
    seen = spark.createDataFrame([("t", "a", "x", "1")], "topic string, key string, payload string, version string")
    assert rows(sequence.drop_seen(df, seen, "1", "payload"), "off") == [(1,)]
    assert sequence.drop_seen(df, seen, "2", "payload").count() == 2


def test_excise_removes_what_came_before(spark):
    df = records(spark, [("a", 0, 0, "1"), ("a", 1, 1, None), ("a", 2, 2, "2"), ("b", 3, 3, "3"),
                         ("c", 4, 4, "4"), ("c", 5, 5, None)])
    assert rows(excise.excise_cascade(df), "off") == [(2,), (3,)]
    assert rows(excise.compacted_view(df), "key", "payload") == [("a", "2"), ("b", "3")]
    copies = spark.createDataFrame([("t", "a", at(0)), ("t", "a", at(2)), ("t", "c", at(4))],
                                   "topic string, key string, ts timestamp")
    assert rows(excise.excise_audit(df, {"copies": copies}), "table", "key", "rows") == [
        ("copies", "a", 1), ("copies", "c", 1)]
    assert rows(excise.purge(copies, df), "key", "ts") == [("a", at(2))]
    messages, gone = log.split_excise(df)
    assert (messages.count(), rows(gone, "off")) == (4, [(1,), (5,)])


def test_log_files_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    df = records(spark, [("a", 0, 0, '{"id":"i"}'), ("b", 1, 1, '{"id":"j"}')])
    log.write_log(df, "me", format="parquet", path=path)
    log.write_excise(df.select("topic", "key").limit(1), "me", format="parquet", path=path)
    back = spark.read.parquet(path)
    assert rows(back, "topic", "key", "value") == [("t", "a", '{"id":"i"}'), ("t", "a", None), ("t", "b", '{"id":"j"}')]
    assert rows(back.select(F.col("headers")[0]["key"].alias("h")).distinct(), "h") == [("source-system",)]
    kafka = back.select("topic", F.lit(0).alias("partition"), F.lit(7).cast("bigint").alias("offset"),
                        F.current_timestamp().alias("timestamp"), F.col("key").cast("binary").alias("key"),
                        F.col("value").cast("binary").alias("value"), "headers")
    assert {r.source_system for r in log.from_kafka(kafka).collect()} == {"me"}
    df.withColumn("source_system", F.lit("me")).write.parquet(str(tmp_path / "canonical"))
    got = log.read_log(spark, "t", path=str(tmp_path / "canonical"), format="parquet")
    assert rows(got, "key", "event_id") == [("a", "i"), ("b", "j")]
    with pytest.raises(Exception, match="write_excise"):
        log.outgoing(df.withColumn("payload", F.lit(None).cast("string")), "me").collect()
