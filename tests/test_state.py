"""Value, map and deque collections, transactions and retention."""

import random

import pytest
from fixtures import at, ops, rows
from pyspark.sql import functions as F

from keyfold.functions.payload import reject_null_items
from keyfold.operators import deques, maps, refs, txn, values


def test_value_reads_see_earlier_writes(spark):
    log = ops(spark, [("a", 1, "get", None, None), ("a", 2, "set", None, "1"), ("a", 3, "get", None, None),
                      ("a", 4, "clear", None, None), ("a", 5, "get", None, None), ("b", 6, "set", None, "2")])
    for chunk in (1, 2, 100):
        assert rows(values.value_asof(log, chunk_rows=chunk), "seq", "current") == [
            (1, None), (2, "1"), (3, "1"), (4, None), (5, None), (6, "2")]
    assert rows(values.value_latest(log), "key", "item") == [("b", "2")]


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_counter_restarts_when_idle(spark, chunk):
    rng = random.Random(1)
    log, off, t = [], 0, 0
    for _ in range(150):
        t += rng.choice([1, 2, 9, 10, 11, 30])
        log.append(("hot" if rng.random() < 0.6 else f"k{rng.randrange(3)}", off, t))
        off += rng.choice([1, 5])
    df = spark.createDataFrame([("t", 0, o, at(s), k) for k, o, s in log],
                               "topic string, part int, off long, ts timestamp, key string")
    want, last = {}, {}
    for k, o, s in log:
        seen = last.get(k)
        n = 1 if seen is None or s - seen[0] >= 10 else seen[1] + 1
        last[k] = (s, n)
        want[o] = n
    got = values.keyed_counter(df, 10, chunk_rows=chunk)
    assert {r.off: r["count"] for r in got.collect()} == want


def test_map_set_delete_clear(spark):
    log = ops(spark, [("a", 1, "set", "old", "0"), ("a", 2, "clear", None, None),
                      ("a", 3, "set", "k1", "1"), ("a", 4, "set", "café", "9"), ("a", 5, "set", "😀", "7"),
                      ("a", 6, "set", "gone", "5"), ("a", 7, "delete", "gone", None),
                      ("a", 8, "set", "b", '{"v":2}')])
    snapshot = maps.map_fold(log)
    keys = [r.map_key for r in maps.map_keys(snapshot).collect()]
    assert keys == ["b", "café", "k1", "😀"]
    assert [r.map_key for r in maps.map_entries(snapshot, backward=True).collect()] == keys[::-1]
    assert [r.item for r in maps.map_values(snapshot).collect()] == ['{"v":2}', "9", "1", "7"]
    asked = spark.createDataFrame(
        [(1, "t", "a", "c", ["k1", "missing", "b", "k1"]), (2, "t", "a", "c", []), (3, "t", "x", "c", ["k1"])],
        "request_id long, topic string, key string, collection string, keys array<string>")
    assert rows(maps.map_get_many(snapshot, asked), "request_id", "items") == [
        (1, ["1", None, '{"v":2}', "1"]), (2, []), (3, [None])]
    one = asked.select("topic", "key", "collection", F.explode("keys").alias("map_key")).distinct()
    assert rows(maps.map_has(snapshot, one), "key", "map_key", "present") == [
        ("a", "b", True), ("a", "k1", True), ("a", "missing", False), ("x", "k1", False)]


def fold(log, capacity):
    """The queue by its definition: each key's items, and what pops and shifts return."""
    queues, taken, lengths = {}, {}, {}
    for key, seq, op, _, item in sorted(log, key=lambda r: r[1]):
        q = queues.setdefault(key, [])
        if op == "push":
            q.append(item)
            if capacity and len(q) > capacity:
                del q[0]
        elif op == "unshift":
            q.insert(0, item)
            if capacity and len(q) > capacity:
                del q[-1]
        elif op == "pop":
            taken[seq] = q.pop() if q else None
        elif op == "shift":
            taken[seq] = q.pop(0) if q else None
        elif op == "clear":
            q.clear()
        lengths[seq] = len(q)
    return queues, taken, lengths


@pytest.mark.parametrize("capacity,chunk,batch", [
    (None, 1000, 10_000), (None, 1000, 4), (None, 5, 4), (3, 7, 10_000), (1, 1, 10_000), (4, 3, 3)])
def test_deque_fold(spark, capacity, chunk, batch):
    rng = random.Random(capacity or 0)
    log, seq = [], 0
    for _ in range(400):
        seq += rng.choice([1, 1, 3])
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}"
        op = rng.choices(["push", "unshift", "pop", "shift", "clear", "get"], [5, 3, 4, 3, 0.3, 1])[0]
        log.append((key, seq, op, None, f"i{seq}" if op in ("push", "unshift") else None))
    df = ops(spark, log)
    queues, taken, lengths = fold(log, capacity)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        items = deques.deque_fold(df, capacity, chunk_rows=chunk).collect()
        removed = deques.deque_removed(df, capacity, chunk_rows=chunk).collect()
        trace = deques.deque_trace(df, capacity, chunk_rows=chunk).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    assert {(r.key, r.pos): (r.item, r.rpos) for r in items} == {
        (k, i): (item, i - len(q)) for k, q in queues.items() for i, item in enumerate(q)}
    assert {r.seq: r.item for r in removed} == taken
    assert {r.seq: r.length for r in trace} == lengths


def test_deque_latest_keeps_newest(spark):
    log = ops(spark, [("a", i, "push", None, str(i)) for i in range(5)] + [("a", 5, "clear", None, None)]
              + [("a", i, "push", None, str(i)) for i in range(6, 10)] + [("b", 3, "push", None, "x")])
    kept = deques.deque_latest(log, 3)
    assert rows(kept, "key", "pos", "rpos", "item") == [
        ("a", 0, -3, "7"), ("a", 1, -2, "8"), ("a", 2, -1, "9"), ("b", 0, -1, "x")]
    assert rows(deques.deque_latest(log, 5000), "key", "pos", "item") == rows(
        deques.deque_fold(log, 5000), "key", "pos", "item")


def test_deque_index(spark):
    items = deques.deque_latest(ops(spark, [("a", i, "push", None, s) for i, s in enumerate("FMB")]), 3)
    want = {0.0: "F", -1.0: "B", -2.0: "M", 2.0: "B", -4.0: None, 3.0: None, float(2**32): None,
            1.5: "error", float("nan"): "error", float("inf"): "error"}
    asked = spark.createDataFrame([("t", "a", "c", i) for i in want],
                                  "topic string, key string, collection string, i double")
    got = {repr(r.i): "error" if r.error_category == "transient" else r.item
           for r in deques.deque_at(items, asked).collect()}
    assert got == {repr(i): v for i, v in want.items()}
    empty = spark.createDataFrame([("t", "a", "c"), ("t", "z", "c")], "topic string, key string, collection string")
    assert rows(deques.deque_length(items, empty), "key", "length", "is_empty") == [("a", 3, False), ("z", 0, True)]


def txn_log(spark, steps):
    """Rows ``(attempt, outcome, seq, op, item)`` of one key."""
    return spark.createDataFrame(
        [("t", "a", "c", n, out, seq, at(seq), op, item) for n, out, seq, op, item in steps],
        "topic string, key string, collection string, attempt long, outcome string, seq long, "
        "ts timestamp, op string, item string")


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_commit_and_rollback(spark, chunk):
    log = txn_log(spark, [
        (1, "ok", 1, "set", "A"), (1, "ok", 2, "commit", None), (1, "ok", 3, "set", "B"),
        (1, "ok", 4, "rollback", None),                                   # A stays
        (2, "failed", 5, "set", "C"), (2, "failed", 6, "commit", None), (2, "failed", 7, "set", "D"),
        (3, "failed", 8, "set", "E"),                                     # nothing stays
        (4, "ok", 9, "set", "F"), (4, "ok", 10, "rollback", None), (4, "ok", 11, "set", "G"),
        (5, "crashed", 12, "set", "H"),
    ])
    assert [r[0] for r in rows(txn.committed_ops(log, chunk_rows=chunk), "item")] == ["A", "C", "G"]
    assert [r[0] for r in rows(txn.committed_ops(log, True, chunk_rows=chunk), "item")] == ["A", "C", "G", "H"]


def test_null_writes_are_rejected(spark):
    log = ops(spark, [("a", 1, "set", None, '{"v":1}'), ("a", 2, "set", None, None), ("a", 3, "push", None, "null"),
                      ("a", 4, "clear", None, None), ("a", 5, "set", None, '[null]'), ("a", 6, "set", None, "plain text")])
    accepted, rejected = reject_null_items(log)
    assert rows(accepted, "seq") == [(1,), (4,), (5,), (6,)]
    assert rows(rejected, "seq", "error_category") == [(2, "transient"), (3, "transient")]


def test_items_expire_after_their_own_write(spark):
    snapshot = ops(spark, [("a", 10, "set", None, "x"), ("a", 20, "set", None, "y")])
    assert rows(txn.unexpired(snapshot, 10, at(20)), "item") == [("y",)]
    with pytest.raises(ValueError):
        txn.unexpired(snapshot, 0, at(20))


def test_message_collections_resolve_last(spark):
    log = spark.createDataFrame(
        [("t", 0, i, at(i), "a", f'{{"n":{i}}}') for i in (0, 1, 3)],
        "topic string, part int, off long, ts timestamp, key string, payload string")
    pushed = ops(spark, [("a", i, "push", None, ("t", 0, i)) for i in range(4)],
                 "struct<topic:string,part:int,off:long>")
    got = refs.message_deque(pushed, log, 3).select("pos", F.col("message.payload").alias("p"))
    assert rows(got, "pos", "p") == [(0, '{"n":1}'), (1, None), (2, '{"n":3}')]
    value = refs.message_value(pushed.withColumn("op", F.lit("set")), log)
    assert rows(value, "message.off") == [(3,)]
    mixed = spark.createDataFrame(
        [(1, "set", "x", None), (2, "set", None, ("t",)), (3, "set", "x", ("t",)), (4, "clear", None, None)],
        "seq long, op string, item string, ref struct<topic:string>")
    assert rows(refs.reject_item_kind(mixed, "json")[1], "seq") == [(2,), (3,)]
    assert rows(refs.reject_item_kind(mixed, "message")[1], "seq") == [(1,), (3,)]


def test_latest_takes_no_other_operation_at_any_capacity(spark):
    log = ops(spark, [("k", 1, "push", None, "1"), ("k", 2, "push", None, "2"), ("k", 3, "pop", None, None)])
    for capacity in (5, 2000):
        with pytest.raises(Exception, match="deque_latest takes push and clear"):
            deques.deque_latest(log, capacity).collect()
    plain = log.where("op = 'push'")
    assert rows(deques.deque_latest(plain, 5), "item") == rows(deques.deque_latest(plain, 2000), "item")


def test_null_followed_by_something_is_no_null(spark):
    from keyfold.functions.payload import is_null_item

    frame = spark.createDataFrame([(" null ",), ("null x",), ("nullx",), (None,), ("1",)], "item string")
    assert [r[0] for r in frame.select(is_null_item("item")).collect()] == [True, False, False, True, False]
