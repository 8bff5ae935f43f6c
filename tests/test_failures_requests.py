"""Failure routing, requests and published reads."""

import random

import pytest
from fixtures import at, ops, rows
from pyspark.sql import functions as F

from keyfold.functions import errors
from keyfold.operators import failures, published, requests
from keyfold.sources.published import read_published


def attempts(spark, steps):
    """Rows ``(record_no, attempt_no, seconds, outcome, category)`` of one key."""
    return spark.createDataFrame(
        [("t", 0, "a", r, n, at(s), out, cat, 1000, "normal" if n == 1 else "failure") for r, n, s, out, cat in steps],
        "topic string, part int, key string, record_no long, attempt_no long, ts timestamp, outcome string, "
        "error_category string, duration_ms long, class string")


def test_categories(spark):
    df = spark.createDataFrame([("TypeError", None), ("Sub", None), ("IOError", None), ("IOError", "permanent"),
                                ("IOError", "Permanent"), (None, None)], "c string, declared string")
    got = df.select(errors.error_category("c", ["TypeError"], {"Sub": "TypeError"}, F.col("declared")).alias("k"))
    assert [r.k for r in got.collect()] == ["permanent", "permanent", "transient", "permanent", "transient", None]


@pytest.mark.parametrize("base,cap", [(20, 300_000), (1000, 86_400_000), (16, 1024), (50, 10)])
def test_backoff(spark, base, cap):
    got = spark.range(1, 61).select(errors.backoff_ms("id", base, cap), errors.elapsed_ms("id", base, cap)).collect()
    total = 0
    for n, (delay, elapsed) in enumerate(got, 1):
        want = min(base * 2 ** (n - 1), cap)
        total += want
        assert (delay, elapsed) == (want, total)


def test_dispositions_by_mode(spark):
    df = attempts(spark, [
        (1, 1, 0, "failed", "transient"), (1, 2, 1, "ok", None),
        (2, 1, 2, "failed", "permanent"),
        (3, 1, 3, "failed", "transient"),
        (4, 1, 4, "failed", "transient"), (4, 2, 5, "failed", "transient"), (4, 3, 6, "failed", "transient"),
        (4, 4, 7, "failed", "transient"),
    ])

    def routed(mode, **options):
        return [r[1] for r in rows(failures.route_by_mode(df, mode, **options), "record_no", "disposition")]

    assert routed("pipeline") == ["done", "dropped", "defer", "defer"]
    assert routed("pipeline", defer=False) == ["done", "dropped", "retry", "retry"]
    assert routed("low_latency") == ["done", "dead_letter", "retry", "dead_letter"]
    assert routed("best_effort") == ["done", "dropped", "dropped", "dropped"]
    with pytest.raises(ValueError):
        failures.route_by_mode(df, "other")


@pytest.mark.parametrize("chunk", [1, 100])
def test_records_wait_behind_parked_ones(spark, chunk):
    df = attempts(spark, [
        (1, 1, 0, "failed", "transient"), (1, 2, 10, "ok", None), (2, 1, 5, "ok", None), (3, 1, 12, "ok", None),
        (4, 1, 20, "failed", "transient"), (5, 1, 21, "ok", None), (6, 1, 22, "failed", "permanent")])
    got = failures.deferred_queue(df, chunk_rows=chunk)
    assert rows(got, "record_no", "state", "blocked_until") == [
        (1, "parked", None), (2, "waiting", at(10)), (3, "clear", at(10)), (4, "parked", at(10)),
        (5, "waiting", None), (6, "waiting", None)]


def test_rolling_windows(spark):
    df = attempts(spark, [(1, 1, 0, "failed", "transient"), (1, 2, 100, "failed", "transient"),
                          (2, 1, 300, "ok", None), (3, 1, 300.000001, "ok", None), (4, 1, 1000, "ok", None)])
    got = failures.failure_rate_gate(df, 0.6, 300_000)
    assert [(r.attempts, r.failed, r.deferral_enabled) for r in got.orderBy("ts").collect()] == [
        (1, 1, False), (2, 2, False), (3, 2, False), (3, 1, True), (1, 0, True)]
    busy = failures.monopolizing_keys(df, 0.009, 300_000).orderBy("ts")
    assert [(r.busy_ms, r.rejected) for r in busy.collect()] == [
        (1000, False), (2000, False), (3000, True), (3000, True), (1000, False)]
    share = failures.execution_share(df).first()
    assert (share.total_ms, share.failure_ms, share.over_target) == (5000, 1000, False)
    stalled = failures.stalled_partitions(df, F.lit(at(1301)).cast("timestamp"))
    assert rows(stalled, "idle_ms", "stalled") == [(301_000, True)]
    assert tuple(failures.stall_summary(stalled).first()) == (1, True)


def test_timeouts(spark):
    df = spark.createDataFrame([(240_000,), (240_001,)], "d long")
    assert [r[0] for r in df.select(errors.timed_out("d")).collect()] == [False, True]
    assert [r[0] for r in df.select(errors.timed_out("d", 240_001)).collect()] == [False, False]


BODY = "ok boolean, value string, kind string, message string"


def test_one_outcome_per_subsystem(spark):
    asked = spark.createDataFrame([(1, at(100), ["a", "b", "c", "d", "a"], 2000), (2, at(0), ["a"], 2000)],
                                  "request_id long, ts timestamp, subsystems array<string>, timeout_ms long")
    answers = spark.createDataFrame([
        (1, "a", at(101), 2, True, "second", None, None), (1, "a", at(100.5), 1, True, "first", None, None),
        (1, "b", at(102), 3, False, None, "handler", "boom"), (1, "c", at(102.000001), 4, True, "late", None, None),
        (1, "d", at(99), 5, True, "before", None, None), (1, "d", at(101), 6, True, "in time", None, None),
        (1, "x", at(101), 7, True, "not asked", None, None)],
        f"request_id long, subsystem string, ts timestamp, resp_no long, {BODY}")
    got = requests.request_outcomes(asked, answers)
    assert rows(got, "request_id", "subsystem", "ok", "value", "kind") == [
        (1, "a", True, "first", None), (1, "b", False, None, "handler"), (1, "c", False, None, "timeout"),
        (1, "d", True, "in time", None), (2, "a", False, None, "timeout")]
    maps = {r.request_id: r.outcomes for r in requests.outcome_maps(got).collect()}
    assert sorted(maps[1]) == ["a", "b", "c", "d"] and maps[1]["b"].message == "boom"
    assert rows(requests.fan_in_summary(got), "subsystem", "kind", "n")[:2] == [("a", "success", 1), ("a", "timeout", 1)]


def test_first_response_of_many(spark):
    rng = random.Random(4)
    answers = [(1, "a", at(rng.randrange(0, 400) / 4), i, True, str(i), None, None) for i in range(300)]
    asked = [(1, at(20), ["a"], 30_000)]
    got = requests.request_outcomes(
        spark.createDataFrame(asked, "request_id long, ts timestamp, subsystems array<string>, timeout_ms long"),
        spark.createDataFrame(answers, f"request_id long, subsystem string, ts timestamp, resp_no long, {BODY}"))
    want = min((r for r in answers if at(20) <= r[2] <= at(50)), key=lambda r: (r[2], r[3]))
    assert rows(got, "value", "resp_ts") == [(want[5], want[2])]


def test_raw_responses(spark):
    df = spark.createDataFrame([
        (bytearray(b'{"a":1}'), None, None), (bytearray(b"null"), None, None), (bytearray(b"{"), None, None),
        (bytearray(b"\xff"), None, None), (None, "formatMismatch", "no"), (None, "timeout", "late")],
        "body binary, kind string, message string")
    got = df.select(requests.decode_outcome("body", "kind", "message").alias("o")).select("o.*")
    assert [(r.ok, r.value, r.kind) for r in got.collect()] == [
        (True, '{"a":1}', None), (True, "null", None), (False, None, "malformedResponse"),
        (False, None, "malformedResponse"), (False, None, "formatMismatch"), (False, None, "timeout")]


def test_published_reads(spark):
    history = ops(spark, [("a", 10, "set", None, "1"), ("a", 20, "clear", None, None), ("a", 30, "set", None, "2")])
    reads = spark.createDataFrame([("t", "a", "c", at(s)) for s in (9, 10, 19, 20, 31, 34, 36)] + [("t", "z", "c", at(50))],
                                  "topic string, key string, collection string, read_ts timestamp")
    got = published.published_value_get(history, reads)
    assert [r.item for r in got.orderBy("read_ts").collect()] == [None, "1", "1", None, "2", "2", "2", None]
    stale = published.stale_read(history, reads, 15_000).orderBy("read_ts").collect()
    # filled at 9 (absent) until 24, then at 31
    assert [r.item for r in stale] == [None, None, None, None, "2", "2", "2", None]
    assert [(r.filled_at - at(0)).total_seconds() for r in stale] == [9, 9, 9, 9, 31, 31, 31, 50]


def test_only_published_json_is_served(spark):
    catalog = spark.createDataFrame([
        ("checkout", "order", "json", True, "g2"), ("checkout", "order", "json", True, "g1"),
        ("checkout", "internal", "json", False, "g1"), ("checkout", "msgs", "message", True, "g1")],
        "subsystem string, collection string, payload string, published boolean, group_id string")
    snapshots = spark.createDataFrame([("order", "g1", "a", 1), ("order", "g2", "a", 2), ("internal", "g1", "a", 3)],
                                      "collection string, group_id string, key string, item long")
    assert rows(read_published(snapshots, catalog, "checkout", "order"), "item") == [(1,)]
    assert read_published(snapshots, catalog, "checkout", "internal").count() == 0
    asked = spark.createDataFrame([("checkout", "order"), ("checkout", "internal"), ("checkout", "msgs")],
                                  "subsystem string, collection string")
    assert rows(published.publish_catalog(asked, catalog), "collection", "group_id") == [("order", "g1")]
