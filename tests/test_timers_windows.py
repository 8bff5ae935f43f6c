"""Timers and activity windows against the rules played step by step."""

import random

import pytest
from fixtures import at, rows
from pyspark.sql import functions as F

from keyfold.operators import timers, windows


def timer_log(spark, steps):
    return spark.createDataFrame(
        [("t", k, seq, at(s), op, None if f is None else at(f)) for k, seq, s, op, f in steps],
        "topic string, key string, seq long, ts timestamp, op string, fire_at timestamp")


CASES = {
    "one": ([(0, "schedule", 2)], [2]),
    "clear_and_schedule replaces": ([(0, "schedule", 4), (0, "clear_and_schedule", 2)], [2]),
    "unschedule": ([(0, "schedule", 2), (0, "schedule", 4), (0, "unschedule", 2)], [4]),
    "clear": ([(0, "schedule", 2), (0, "schedule", 3), (0, "schedule", 4), (0, "clear", None)], []),
    "one per second": ([(0, "schedule", 2), (0, "schedule", 2.2), (0, "schedule", 1.9)], [2]),
    "rounded": ([(0, "schedule", 2.5), (0, "schedule", 4.4)], [3, 4]),
    "last of a second wins": ([(0, "schedule", 5), (1, "unschedule", 5), (2, "schedule", 5)], [5]),
    "too late": ([(0, "schedule", 2), (2, "clear", None), (3, "unschedule", 2)], [2]),
}


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_cases(spark, chunk):
    steps, want, seq = [], [], 0
    for key, (ops, fired) in CASES.items():
        for s, op, f in ops:
            steps.append((key, seq, s, op, f))
            seq += 1
        want += [(key, at(f)) for f in fired]
    got = timers.timer_fold(timer_log(spark, steps), chunk_rows=chunk)
    assert rows(got, "key", "fire_at") == sorted(want, key=repr)


def play(steps):
    """Fire timers by going through the operations in order."""
    pending, fired = {}, set()
    for key, _, s, op, f in steps:
        mine = pending.setdefault(key, set())
        for due in [d for d in mine if d <= s]:
            mine.discard(due)
            fired.add((key, due))
        due = None if f is None else int(f + 0.5)
        if op in ("clear", "clear_and_schedule"):
            mine.clear()
        if op in ("schedule", "clear_and_schedule"):
            mine.add(due)
        if op == "unschedule":
            mine.discard(due)
    waiting = {(k, d) for k, mine in pending.items() for d in mine}
    return fired, waiting


@pytest.mark.parametrize("chunk", [1, 8, 1000])
def test_random_logs(spark, chunk):
    rng = random.Random(chunk)
    steps, s = [], 0
    for seq in range(400):
        s += rng.choice([0, 1, 1, 2])
        op = rng.choices(["schedule", "clear_and_schedule", "unschedule", "clear"], [6, 1, 3, 1])[0]
        f = None if op == "clear" else s + rng.randrange(1, 12)
        steps.append(("hot" if rng.random() < 0.5 else f"k{seq % 3}", seq, s, op, f))
    fired, waiting = play(steps)
    df = timer_log(spark, steps)
    got = {(r.key, int((r.fire_at - at(0)).total_seconds())) for r in timers.timer_fold(df, chunk_rows=chunk).collect()}
    assert got == fired | waiting
    middle = steps[200]
    _, waiting = play(steps[:201])
    got = timers.timers_pending(df, middle[1], at(middle[2]), chunk_rows=chunk).collect()
    assert {(r.key, int((r.fire_at - at(0)).total_seconds())) for r in got} == {
        (k, d) for k, d in waiting if d > middle[2]}


def notify(log, width, capacity, ttl=None):
    """The window rules as a handler, event by event: what is sent."""
    sent, state = [], {}

    def fire(key):
        st = state[key]
        alive = [(t, i) for t, i in st["saved"] if ttl is None or t + ttl > st["fire"]]
        if alive:
            sent.append((key, "summary", st["start"], st["fire"], tuple(i for _, i in alive)))
        state[key] = None

    for key, off, t, gone in sorted(log, key=lambda r: (r[2], r[1])):
        if state.get(key) and state[key]["fire"] <= t:
            fire(key)
        if gone:
            state[key] = None
            continue
        st = state.get(key)
        if st and ttl is not None and t >= int(st["start"] + ttl + 0.5):
            st = None
        if st is None:
            state[key] = dict(start=t, fire=int(t + width + 0.5), saved=[])
            sent.append((key, "first", t, int(t + width + 0.5), (off,)))
        else:
            st["saved"] = [*st["saved"], (t, off)][-capacity:]
    for key in state:
        if state[key]:
            fire(key)
    return sorted(sent)


@pytest.mark.parametrize("width,capacity,ttl,excise,chunk", [
    (30, 100, None, False, 10), (30, 2, None, True, 3), (30, 100, None, True, 1), (20, 5, 8, False, 10), (30, 100, 30, False, 10),
    (1, 3, None, True, 1)])
def test_window_notify(spark, width, capacity, ttl, excise, chunk):
    rng = random.Random(width + capacity)
    log = [("hot" if rng.random() < 0.5 else f"k{i % 4}", i, i + rng.choice([0, 0.25, 0.5]), excise and i % 37 == 5)
           for i in range(300)]
    df = spark.createDataFrame(
        [("t", 0, off, at(s), k, off, g) for k, off, s, g in log],
        "topic string, part int, off long, ts timestamp, key string, event_id long, gone boolean")
    got = windows.window_notify(df, width, capacity, excise="gone" if excise else None, ttl_seconds=ttl,
                                chunk_rows=chunk).collect()
    have = sorted((r.key, r.kind, (r.window_start - at(0)).total_seconds(), (r.fire_at - at(0)).total_seconds(),
                   tuple(r.event_ids)) for r in got)
    assert have == notify(log, width, capacity, ttl)
    assert all(r.n == len(r.event_ids) for r in got)


def test_records_of_one_instant(spark):
    df = spark.createDataFrame([("t", 0, o, at(0), "a", o) for o in (3, 1, 2)],
                               "topic string, part int, off long, ts timestamp, key string, event_id long")
    got = windows.window_notify(df, 10).select("kind", "n", F.array_join("event_ids", ",").alias("ids"))
    assert rows(got, "kind", "ids") == [("first", "1"), ("summary", "2,3")]
