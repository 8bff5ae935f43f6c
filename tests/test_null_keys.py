"""A missing key is a key like any other: every operator gives it the rows that a text key gets."""

import pytest
from fixtures import at, ops, records, rows
from pyspark.sql import functions as F

from keyfold.functions.payload import with_event_metadata
from keyfold.operators import deques, excise, maps, scan, sequence, timers, values, windows
from keyfold.sources.log import split_keyless

LOG = [(key, off, second, payload) for off, (key, second, payload) in enumerate([
    ("a", 0, '{"id": "1"}'), ("z", 0, '{"id": "1"}'), ("z", 1, '{"id": "1"}'), ("a", 5, '{"id": "2"}'), ("z", 6, '{"id": "2"}'),
    ("z", 7, None), ("b", 8, None), ("z", 9, '{"id": "1"}'), ("z", 40, '{"id": "1"}'), ("b", 41, '{"id": "7"}'), ("z", 42, "{}")])]
OPS = [(key, seq, op, mk, item) for seq, (key, op, mk, item) in enumerate([
    ("a", "set", "x", "1"), ("z", "set", "x", "2"), ("z", "set", "y", "3"), ("z", "clear", None, None), ("z", "set", "y", "4"),
    ("b", "set", "x", "5"), ("z", "get", "y", None), ("z", "delete", "x", None), ("a", "set", "x", "6"), ("z", "set", "x", "7")])]
TIMERS = [("z", 0, 0, "schedule", 4), ("a", 1, 1, "schedule", 3), ("z", 2, 2, "clear", None), ("z", 3, 3, "schedule", 9)]


def lookups(spark, key):
    return spark.createDataFrame([("t", key, "c", "y"), ("t", "a", "c", "x"), ("t", "none", "c", "x")],
                                 "topic string, key string, collection string, map_key string")


OPERATORS = {
    "per_key_sequence": lambda log, *_: sequence.per_key_sequence(log, chunk_rows=2),
    "first_occurrences": lambda log, *_: sequence.first_occurrences(log),
    "dedup_ttl": lambda log, *_: sequence.dedup_ttl(log, 30),
    "drop_seen": lambda log, *_: sequence.drop_seen(log, log.where("off < 3").withColumn("version", F.lit("v")), "v"),
    "keyed_counter": lambda log, *_: values.keyed_counter(log, 20, chunk_rows=2),
    "value_latest": lambda _, state, *__: values.value_latest(state),
    "value_asof": lambda _, state, *__: values.value_asof(state, chunk_rows=2),
    "map_fold": lambda _, state, *__: maps.map_fold(state),
    "map_get": lambda _, state, asked, __: maps.map_get(maps.map_fold(state), asked),
    "map_has": lambda _, state, asked, __: maps.map_has(maps.map_fold(state), asked),
    "timer_fold": lambda *frames: timers.timer_fold(frames[3], chunk_rows=2),
    "window_notify": lambda log, *_: windows.window_notify(log.where("payload is not null"), 10, 3),
    "excise_cascade": lambda log, *_: excise.excise_cascade(log),
    "purge": lambda log, state, *_: excise.purge(state, log),
    "compacted_view": lambda log, *_: excise.compacted_view(log),
    "excise_audit": lambda log, state, *_: excise.excise_audit(log, {"state": state}),
}


def frames(spark, name):
    """The test frames with ``name`` as the key of the rows of z."""
    def named(given):
        return [(name if r[0] == "z" else r[0], *r[1:]) for r in given]

    log = with_event_metadata(records(spark, named(LOG)))
    timer = spark.createDataFrame([("t", k, seq, at(s), op, None if f is None else at(f)) for k, seq, s, op, f in named(TIMERS)],
                                  "topic string, key string, seq long, ts timestamp, op string, fire_at timestamp")
    return log, ops(spark, named(OPS)), lookups(spark, name), timer


@pytest.mark.parametrize("listed", [0, 10_000])
@pytest.mark.parametrize("operator", OPERATORS)
def test_a_missing_key_is_a_key(spark, operator, listed, monkeypatch):
    monkeypatch.setattr(scan, "MAX_LISTED", listed)
    want, got = (OPERATORS[operator](*frames(spark, name)) for name in ("z", None))
    got = got.withColumn("key", F.coalesce("key", F.lit("z")))
    columns = sorted(want.columns)
    assert "z" in {r.key for r in want.collect()}
    assert rows(got, *columns) == rows(want, *columns)


DEQUE = [(key, seq, op, None, str(seq) if op in ("push", "unshift") else None) for seq, (key, op) in enumerate([
    ("a", "push"), ("z", "push"), ("z", "push"), ("z", "clear"), ("z", "push"), ("b", "push"), ("z", "push"), ("a", "push"), ("z", "push")])]
MORE = [(key, 20 + seq, op, None, str(seq) if op in ("push", "unshift") else None) for seq, (key, op) in enumerate([
    ("z", "shift"), ("a", "pop"), ("z", "unshift"), ("z", "pop"), ("z", "unshift")])]
INDEXES = [("z", 0), ("z", -1), ("z", 9), ("a", 0), ("none", 0)]
DEQUES = {
    "fold": lambda log, _: deques.deque_fold(log, 3, chunk_rows=2),
    "removed": lambda log, _: deques.deque_removed(log, 3, chunk_rows=2),
    "latest": lambda log, _: deques.deque_latest(log.where("seq < 20"), 2),
    "length": lambda log, asked: deques.deque_length(deques.deque_fold(log), asked),
    "at": lambda log, asked: deques.deque_at(deques.deque_fold(log), asked),
}


@pytest.mark.parametrize("listed", [0, 10_000])
@pytest.mark.parametrize("operator", DEQUES)
def test_a_missing_key_has_a_deque(spark, operator, listed, monkeypatch):
    monkeypatch.setattr(scan, "MAX_LISTED", listed)

    def run(name):
        log = ops(spark, [(name if r[0] == "z" else r[0], *r[1:]) for r in DEQUE + MORE])
        asked = spark.createDataFrame([("t", name if k == "z" else k, "c", i) for k, i in INDEXES], "topic string, key string, collection string, i long")
        return DEQUES[operator](log, asked)

    want, got = run("z"), run(None).withColumn("key", F.coalesce("key", F.lit("z")))
    assert "z" in {r.key for r in want.collect()}
    assert rows(got, *sorted(want.columns)) == rows(want, *sorted(want.columns))


def test_rows_without_a_key_split_off(spark):
    good, keyless = split_keyless(ops(spark, [("a", 0, "push", None, "1"), (None, 1, "push", None, "2")]))
    assert deques.deque_fold(good).count() == 1
    assert [(r.seq, r.error_category) for r in keyless.collect()] == [(1, "permanent")]
