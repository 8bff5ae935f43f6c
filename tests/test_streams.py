"""Streams in several micro-batches against their table forms."""

import random
from pathlib import Path

import pytest
from fixtures import at, micro_batches, records, rows
from pyspark.sql import functions as F

from keyfold.operators.failures import route_by_mode
from keyfold.operators.requests import request_outcomes
from keyfold.operators.sequence import dedup_ttl
from keyfold.operators.windows import window_notify
from keyfold.session import shared_dir
from keyfold.sources.log import write_dead_letters
from keyfold.sources.published import read_state
from keyfold.streaming import handlers
from keyfold.streaming.dedup import dedup_stream, dedup_within_watermark
from keyfold.streaming.handler import run_stream
from keyfold.streaming.requests import request_outcomes_join, request_outcomes_stream
from keyfold.streaming.run import END, run_available, run_to_end


def test_dedup(spark, tmp_path):
    rng = random.Random(8)
    log = [("hot" if i % 2 else f"k{i % 3}", i, i * 5 + rng.randrange(5), None if i % 7 == 0 else f"id{i % 4}")
           for i in range(90)]
    frames = [records(spark, log[i:i + 30]) for i in (0, 30, 60)]
    stream = micro_batches(spark, tmp_path, frames)
    got = run_available(dedup_stream(stream, 60, "payload"), f"dedup-{tmp_path.name}", 2, event_time=False)
    want = dedup_ttl(records(spark, log), 60, "payload")
    assert rows(got, "off") == rows(want, "off")
    cheap = run_available(dedup_within_watermark(stream, "60 seconds", "payload"), f"cheap-{tmp_path.name}", 2)
    ids = {(r[0], r[3]) for r in log if r[3]}
    assert {(r.key, r.payload) for r in cheap.where("payload IS NOT NULL").collect()} == ids


class Seen:
    """Answers each record with its offset; a timer two minutes later."""

    collections = ()

    def on_message(self, ctx, message):
        ctx.schedule(ctx.now_us + 120_000_000)
        return message.off

    on_excise = on_message

    def on_timer(self, ctx, timer):
        ctx.emit("fired")


def test_no_record_is_late(spark, tmp_path):
    # b lags behind a in each batch, and the times of a fall once
    steps = [[("a", 0, 1000, "x"), ("b", 1, 10, "x")], [("a", 2, 2000, "y"), ("b", 3, 20, "y")],
             [("a", 4, 1990, "z"), ("a", 5, 3000, "z"), ("b", 6, 30, "x")]]
    stream = micro_batches(spark, tmp_path, [records(spark, step) for step in steps])
    got = run_available(run_stream(stream, Seen()), f"late-{tmp_path.name}", 2, event_time=False)
    answers = got.where("kind = 'response'")
    assert rows(answers, "key", "off") == [("a", 0), ("a", 2), ("a", 4), ("a", 5), ("b", 1), ("b", 3), ("b", 6)]
    # the timers that later records of the key reach
    fired = got.where("kind = 'emit'").select("key", F.unix_timestamp("at").alias("s"))
    start = int(records(spark, steps[0]).select(F.unix_timestamp("ts") - 1000).first()[0])
    assert rows(fired, "key", "s") == [("a", start + s) for s in (1120, 2110, 2120)]
    kept = run_available(dedup_stream(stream, 600, "payload"), f"ids-{tmp_path.name}", 2, event_time=False)
    assert rows(kept, "key", "off") == [("a", 0), ("a", 2), ("a", 4), ("a", 5), ("b", 1), ("b", 3)]


BODY = "ok boolean, value string, kind string, message string"


@pytest.mark.parametrize("eager", [False, True])
def test_requests(spark, tmp_path, eager):
    asked = spark.createDataFrame(
        [(1, at(0), ["a", "b"], 10_000), (2, at(20), ["a"], 10_000), (9, at(500), ["a"], 1000)],
        "request_id long, ts timestamp, subsystems array<string>, timeout_ms long")
    steps = [[(1, "a", 1, 0), (1, "a", 2, 1), (2, "a", 15, 2)], [(1, "b", 11, 3), (2, "a", 30, 4), (2, "a", 25, 5)],
             [(9, "a", 600, 6)]]
    frames = [spark.createDataFrame([(q, s, at(t), n, True, str(n), None, None) for q, s, t, n in step],
                                    f"request_id long, subsystem string, ts timestamp, resp_no long, {BODY}")
              for step in steps]
    (tmp_path / "asked").mkdir()
    (tmp_path / "answers").mkdir()
    answers = frames[0].unionAll(frames[1]).unionAll(frames[2])
    questions = micro_batches(spark, tmp_path / "asked", [asked.where(f"request_id = {i}") for i in (1, 2, 9)])
    stream = request_outcomes_stream(
        questions, micro_batches(spark, tmp_path / "answers", frames), watermark="60 seconds", eager=eager)
    got = run_available(stream, f"requests-{tmp_path.name}", 2).where("request_id <> 9")
    want = request_outcomes(asked, answers).where("request_id <> 9")
    columns = ["request_id", "subsystem", "ok", "value", "kind", "resp_ts"]
    assert rows(got, *columns) == rows(want, *columns)
    joined = request_outcomes_join(
        spark.readStream.schema(asked.schema).parquet(str(tmp_path / "asked/in")),
        spark.readStream.schema(answers.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "answers/in")),
        10, "60 seconds")
    got = run_available(joined, f"joined-{tmp_path.name}", 2).where("request_id <> 9")
    assert rows(got, "request_id", "subsystem", "ok", "kind") == rows(want, "request_id", "subsystem", "ok", "kind")


def test_windows_with_excise(spark, tmp_path):
    rng = random.Random(6)
    log = [("hot" if i % 2 else f"k{i % 3}", i, i * 2, None if i % 17 == 9 else "{}") for i in range(60)]
    log.append(("end", 99, 10_000, "{}"))
    cut = sorted(rng.sample(range(1, 60), 2))
    frames = [records(spark, log[a:b]) for a, b in zip([0, *cut], [*cut, len(log)])]
    handler = handlers.WindowNotify(15, 3)
    name = f"windows-{tmp_path.name}"
    got = run_available(run_stream(micro_batches(spark, tmp_path, frames), handler, handler.collections, watermark="0 seconds"), name, 2)
    body = F.from_json("body", "kind string, ids array<bigint>")
    sent = got.where("kind = 'emit'").select("key", body.alias("b")).select(
        "key", "b.kind", F.array_join("b.ids", ",").alias("ids"))
    table = records(spark, log).withColumns({"event_id": F.col("off"), "gone": F.col("payload").isNull()})
    want = window_notify(table, 15, 3, excise="gone").select("key", "kind", F.array_join("event_ids", ",").alias("ids"))
    assert rows(sent, "key", "kind", "ids") == rows(want, "key", "kind", "ids")
    state = read_state(spark, f"{shared_dir(spark)}/{name}/checkpoint", "window")
    assert {r[0] for r in state.select("key.key").collect()} <= {"hot", "k0", "k1", "k2", "end"}
    assert "end" in {r[0] for r in state.select("key.key").collect()}


def test_dead_letters_per_batch(spark, tmp_path):
    attempts = spark.createDataFrame(
        [("t", "a", 1, 1, "failed", "permanent"), ("t", "a", 2, 1, "ok", None)],
        "topic string, key string, record_no long, attempt_no long, outcome string, error_category string")
    write = write_dead_letters("failed", str(tmp_path / "dlq"))
    routed = route_by_mode(attempts, "low_latency")
    write(routed, 0)
    write(routed, 0)
    back = spark.read.parquet(str(tmp_path / "dlq"))
    assert rows(back, "topic", "from_topic", "key", "record_no") == [("failed", "t", "a", 1)]


def test_streams_run_to_their_end(spark, tmp_path):
    log = [("hot" if i % 2 else f"k{i % 3}", i, i * 2, None if i % 17 == 9 else "{}") for i in range(40)]
    frames = [records(spark, log[a:b]) for a, b in zip([0, 13, 30], [13, 30, 40])]
    handler = handlers.WindowNotify(15, 3)
    last = {"topic": "end", "part": 0, "off": -1, "ts": END, "key": "end"}
    got = run_to_end(lambda r: run_stream(r, handler, handler.collections, watermark="0 seconds"), f"ended-{tmp_path.name}",
                     (micro_batches(spark, tmp_path, frames), last))
    body = F.from_json("body", "kind string, ids array<bigint>")
    sent = got.where("kind = 'emit'").select("key", body.alias("b")).select("key", "b.kind", F.array_join("b.ids", ",").alias("ids"))
    table = records(spark, log).withColumns({"event_id": F.col("off"), "gone": F.col("payload").isNull()})
    want = window_notify(table, 15, 3, excise="gone").select("key", "kind", F.array_join("event_ids", ",").alias("ids"))
    assert rows(sent, "key", "kind", "ids") == rows(want, "key", "kind", "ids")


def test_requests_run_to_their_end(spark, tmp_path):
    asked = spark.createDataFrame([(i, at(i * 5), ["a", "b"], 10_000) for i in range(1, 9)],
                                  "request_id long, ts timestamp, subsystems array<string>, timeout_ms long")
    steps = [[(1, "a", 6, 0), (2, "b", 11, 1)], [(3, "a", 30, 2), (5, "a", 26, 3)], [(8, "a", 45, 4), (8, "a", 44, 5)]]
    frames = [spark.createDataFrame([(q, s, at(t), n, True, str(n), None, None) for q, s, t, n in step],
                                    f"request_id long, subsystem string, ts timestamp, resp_no long, {BODY}") for step in steps]
    (tmp_path / "asked").mkdir()
    (tmp_path / "answers").mkdir()
    last = {"request_id": -1, "ts": END}
    got = run_to_end(
        lambda q, a: request_outcomes_stream(q, a, "60 seconds"), f"all-{tmp_path.name}",
        (micro_batches(spark, tmp_path / "asked", [asked.where(f"request_id % 3 = {i}") for i in range(3)]), last | {"subsystems": ["end"], "timeout_ms": 0}),
        (micro_batches(spark, tmp_path / "answers", frames), last | {"subsystem": "end", "resp_no": 0})).where("request_id <> -1")
    want = request_outcomes(asked, frames[0].unionAll(frames[1]).unionAll(frames[2]))
    columns = ["request_id", "subsystem", "ok", "value", "kind", "resp_ts"]
    assert want.count() == 16 and rows(got, *columns) == rows(want, *columns)


def test_a_request_is_one_key_with_one_timer(spark, tmp_path):
    asked = spark.createDataFrame([(i, at(i), ["a", "b", "c", "b"], 10_000) for i in range(5)],
                                  "request_id long, ts timestamp, subsystems array<string>, timeout_ms long")
    steps = [[(i, s, i + n, n) for i in range(5) for n, s in enumerate("abx")], [(i, "x", 6, 100 + n) for i in range(5) for n in range(40)]]
    frames = [spark.createDataFrame([(q, s, at(t), n, True, str(n), None, None) for q, s, t, n in step],
                                    f"request_id long, subsystem string, ts timestamp, resp_no long, {BODY}") for step in steps]
    (tmp_path / "asked").mkdir()
    (tmp_path / "answers").mkdir()
    stream = request_outcomes_stream(micro_batches(spark, tmp_path / "asked", [asked]), micro_batches(spark, tmp_path / "answers", frames), "60 seconds")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    try:
        query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint").option("path", f"{tmp_path}/rows")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    first = query.recentProgress[0].stateOperators[0]
    assert first.customMetrics["numRegisteredTimers"] == 5 and first.numRowsUpdated == 5


def test_a_request_asked_for_again_finds_what_waited(spark, tmp_path):
    """Responses come before the request, more of them than a row of state holds, and a second request asks for more."""
    asks = [[(1, at(5), ["a"], 20_000)], [(2, at(6), ["a"], 20_000)], [(1, at(7), ["b", "a"], 20_000), (3, at(8), None, 20_000)]]
    frames = [spark.createDataFrame(a, "request_id long, ts timestamp, subsystems array<string>, timeout_ms long") for a in asks]
    answers = [[(1, s, 9 + n % 3, 100 - n) for s in "bc" for n in range(30)], [(1, "a", 12, 1), (2, "b", 12, 2)], [(2, "a", 40, 3)]]
    told = [spark.createDataFrame([(q, s, at(t), n, True, str(n), None, None) for q, s, t, n in step],
                                  f"request_id long, subsystem string, ts timestamp, resp_no long, {BODY}") for step in answers]
    (tmp_path / "asked").mkdir()
    (tmp_path / "answers").mkdir()
    last = {"request_id": -1, "ts": END}
    got = run_to_end(
        lambda q, a: request_outcomes_stream(q, a, "600 seconds"), f"again-{tmp_path.name}",
        (micro_batches(spark, tmp_path / "asked", frames), last | {"subsystems": ["end"], "timeout_ms": 0}),
        (micro_batches(spark, tmp_path / "answers", told), last | {"subsystem": "end", "resp_no": 0})).where("request_id <> -1")
    assert rows(got, "request_id", "subsystem", "value", "kind") == sorted([
        (1, "a", "1", None), (1, "b", "73", None), (2, "a", None, "timeout")], key=repr)


def test_requests_share_keys_of_state(spark, tmp_path):
    """Forty requests are two keys of state; what waits, what is answered and what times out stays each request's own."""
    ids = [f"q{i}" for i in range(40)]
    asked = spark.createDataFrame([(q, at(20 + i), ["a", "b"], 5000 + 1000 * (i % 4)) for i, q in enumerate(ids)],
                                  "request_id string, ts timestamp, subsystems array<string>, timeout_ms long")
    steps = [[(q, s, 21 + i + n % 3, 100 - n) for i, q in enumerate(ids) for s in "ax" for n in range(20 if i % 5 == 0 else 1)]
             + [(q, "a", 21 + i, None) for i, q in enumerate(ids) if i % 4 == 0],
             [(q, "b", 22 + i + i % 9, 500) for i, q in enumerate(ids) if i % 3]]
    frames = [spark.createDataFrame([(q, s, at(t), n, True, str(n), None, None) for q, s, t, n in step],
                                    f"request_id string, subsystem string, ts timestamp, resp_no long, {BODY}") for step in steps]
    (tmp_path / "asked").mkdir()
    (tmp_path / "answers").mkdir()
    questions = micro_batches(spark, tmp_path / "asked", [asked.limit(0), asked])
    last = {"request_id": "end", "ts": END}
    name = f"shared-{tmp_path.name}"
    got = run_to_end(
        lambda q, a: request_outcomes_stream(q, a, "600 seconds", bundles=2), name,
        (questions, last | {"subsystems": ["end"], "timeout_ms": 0}),
        (micro_batches(spark, tmp_path / "answers", frames), last | {"subsystem": "end", "resp_no": 0})).where("request_id <> 'end'")
    want = request_outcomes(asked, frames[0].unionAll(frames[1]))
    columns = ["request_id", "subsystem", "ok", "value", "kind", "resp_ts"]
    assert want.count() == 80 and rows(got, *columns) == rows(want, *columns)
    keys = spark.read.format("statestore").option("stateVarName", "bundle").option("batchId", 1).load(f"{shared_dir(spark)}/{name}/checkpoint")
    assert keys.count() == 2


def test_joined_requests_run_to_their_end_in_one_store(spark, tmp_path):
    asked = spark.createDataFrame([(i, at(i * 5), ["a", "b", "a"]) for i in range(1, 9)], "request_id long, ts timestamp, subsystems array<string>")
    steps = [[(1, "a", 6, 0), (2, "b", 11, 1), (4, "a", 19, 2), (4, "b", 30, 3)], [(3, "a", 30, 4), (5, "a", 26, 5), (5, "x", 27, 6)]]
    frames = [spark.createDataFrame([(q, s, at(t), n, True, str(n), None, None) for q, s, t, n in step],
                                    f"request_id long, subsystem string, ts timestamp, resp_no long, {BODY}") for step in steps]
    (tmp_path / "asked").mkdir()
    (tmp_path / "answers").mkdir()
    last, name = {"request_id": -1, "ts": END}, f"one-store-{tmp_path.name}"
    got = run_to_end(
        lambda q, a: request_outcomes_join(q, a, 10, "60 seconds"), name,
        (micro_batches(spark, tmp_path / "asked", [asked.where(f"request_id % 2 = {i}") for i in range(2)]), last | {"subsystems": ["end"]}),
        (micro_batches(spark, tmp_path / "answers", frames), last | {"subsystem": "end", "resp_no": 0})).where("request_id <> -1")
    want = request_outcomes(asked.withColumn("timeout_ms", F.lit(10_000)), frames[0].unionAll(frames[1]))
    columns = ["request_id", "subsystem", "ok", "value", "kind", "resp_ts"]
    assert want.count() == 16 and rows(got, *columns) == rows(want, *columns)
    state = Path(shared_dir(spark), name, "checkpoint", "state")
    assert not [p.name for p in state.glob("*/0/*keyToNumValues")] and len(list(state.glob("*/0"))) == 2
