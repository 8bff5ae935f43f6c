"""A consumer group end to end, on a table and on a stream."""

import pytest
from fixtures import at, micro_batches, rows

from keyfold.consumer import Consumer
from keyfold.functions.payload import with_event_metadata
from keyfold.streaming.handlers import KeyCounter
from keyfold.streaming.run import run_available

LOG = [
    ("a", 0, 0, '{"id":"1","type":"user.created"}', None), ("a", 1, 1, '{"id":"1","type":"user.created"}', None),
    ("a", 2, 2, '{"id":"2","type":"admin.user.created"}', None), ("a", 3, 3, '{"id":"3"}', "me"),
    ("a", 4, 4, '{"id":"4"}', "other"), ("b", 5, 5, '{"id":"1","type":"user.created"}', None),
    ("a", 6, 6, '{"n":1}', None), ("a", 7, 7, '{"n":1}', None), ("a", 8, 8, "broken", None), ("z", 9, 900, "{}", None),
]


def log(spark, items):
    df = spark.createDataFrame([("t", 0, off, at(s), k, p, src) for k, off, s, p, src in items],
                               "topic string, part int, off long, ts timestamp, key string, payload string, "
                               "source_system string")
    return with_event_metadata(df)


def test_options():
    with pytest.raises(ValueError, match="failure_topic"):
        Consumer("me", mode="low_latency")
    for bad in (dict(group_id=""), dict(group_id="me", mode="x"), dict(group_id="me", dedup_ttl_s=0)):
        with pytest.raises(ValueError):
            Consumer(**bad)


def test_table_and_stream_agree(spark, tmp_path):
    me = Consumer("me", "t", allowed_events=["user."], mode="low_latency", failure_topic="failed")
    want = [0, 4, 5, 6, 7, 8, 9]
    table = log(spark, LOG)
    assert [r[0] for r in rows(me.table(table), "off")] == want
    seen = spark.createDataFrame([("t", "a", "4", "1"), ("t", "a", "1", "0")],
                                 "topic string, key string, event_id string, version string")
    assert [r[0] for r in rows(me.table(table, seen), "off")] == [0, 5, 6, 7, 8, 9]
    counter = KeyCounter(3600)
    columns = ["key", "off", "kind", "body", "to_topic"]
    handled = me.handle_table(table, counter, counter.collections)
    assert ("a", 7, "response", '{"count": 4}', None) in rows(handled, *columns)
    frames = [log(spark, LOG[:4]), log(spark, LOG[4:])]
    stream = me.handle_stream(micro_batches(spark, tmp_path, frames), counter, counter.collections)
    got = run_available(stream, f"consumer-{tmp_path.name}", 2, event_time=False)
    assert rows(got, *columns) == rows(handled, *columns)
    sent = me.outgoing(table.where("off = 0")).select("headers").first()[0][0]
    assert (sent["key"], bytes(sent["value"])) == ("source-system", b"me")
