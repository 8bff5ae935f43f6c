"""Chunked running aggregates against a plain loop."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfold.operators import scan
from keyfold.operators.anchored import anchored_slots, exits
from keyfold.operators.scan import Running, asof_join, by_position, running, sliding_sums


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(7)
    rows, seq = [], 0
    for _ in range(600):
        seq += rng.choice([1, 1, 1, 2, 40])
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}"
        rows.append((key, seq, rng.choice([None, 1, 2, 3, 5])))
    return rows, spark.createDataFrame(rows, "key string, seq long, v long")


@pytest.fixture(params=["listed", "all", "plain"])
def chunk_rows(request, monkeypatch):
    """Few hot keys, more of them than are listed, and none."""
    if request.param == "all":
        monkeypatch.setattr(scan, "MAX_LISTED", 0)
    return 10_000 if request.param == "plain" else 30


@pytest.mark.parametrize("following", [False, True])
def test_running(log, chunk_rows, following):
    rows, df = log
    got = running(
        df, ["key"], ["seq"], by_position("seq", chunk_rows),
        {"total": Running("sum", F.col("v")), "last": Running("last", F.col("v")),
         "top": Running("max", F.col("v")), "low": Running("min", F.col("v"), before=True),
         "prev": Running("last", F.col("v"), before=True)},
        following=following, chunk_rows=chunk_rows,
    ).collect()
    want = {}
    for key in {r[0] for r in rows}:
        state = dict(total=None, last=None, top=None, low=None, prev=None)
        for _, seq, v in sorted((r for r in rows if r[0] == key), key=lambda r: r[1], reverse=following):
            before = dict(state)
            if v is not None:
                state["total"] = (state["total"] or 0) + v
                state["last"] = v
                state["top"] = v if state["top"] is None else max(state["top"], v)
                state["low"] = v if state["low"] is None else min(state["low"], v)
            want[key, seq] = (state["total"], state["last"], state["top"], before["low"], before["last"])
    assert {(r.key, r.seq): (r.total, r.last, r.top, r.low, r.prev) for r in got} == want


def test_sliding_sums(spark, chunk_rows):
    rng = random.Random(3)
    rows = [("hot" if i % 2 else f"k{i % 5}", rng.randrange(0, 400_000_000), rng.randrange(100))
            for i in range(500)]
    rows += [rows[0], rows[1]]
    df = spark.createDataFrame(rows, "key string, us long, v long")
    width = 50_000_000
    got = sliding_sums(df, ["key"], "us", width, {"n": F.lit(1), "v": F.col("v")}, chunk_rows).collect()
    want = {
        (k, t): (
            sum(1 for r in rows if r[0] == k and t - width <= r[1] <= t),
            sum(r[2] for r in rows if r[0] == k and t - width <= r[1] <= t))
        for k, t, _ in rows
    }
    assert {(r.key, r.us): (r.n, r.v) for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("forward", [False, True])
def test_asof_join(spark, forward, chunk_rows):
    rng = random.Random(5)
    spots = [rng.randrange(0, 300) * 1_000_000 for _ in range(300)]
    right = [(f"k{i % 3}", spots[i], i, i) for i in range(150)]
    left = [(i, f"k{i % 4}", spots[i]) for i in range(150, 300)]
    left.append((300, "k0", right[0][1]))
    got = asof_join(
        spark.createDataFrame(left, "id long, key string, at long"),
        spark.createDataFrame(right, "key string, us long, v long, tie long"),
        ["key"], "at", "us", ["v"], "tie", forward, chunk_rows,
    ).collect()
    want = {}
    for i, key, at in left:
        near = [r for r in right if r[0] == key and (r[1] >= at if forward else r[1] <= at)]
        pick = (min if forward else max)(near, key=lambda r: (r[1], r[3]), default=None)
        want[i] = None if pick is None else (pick[1], pick[2])
    assert {r.id: (None if r.hit is None else (r.hit.us, r.hit.v)) for r in got} == want


@pytest.mark.parametrize("batch", [3, 10_000])
@pytest.mark.parametrize("half_up", [True, False])
def test_anchored_windows(spark, batch, half_up):
    rng = random.Random(11)
    rows = [("hot" if i % 3 == 0 else f"k{i % 7}", rng.randrange(0, 900_000_000), i) for i in range(700)]
    width = 30_250_000
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = anchored_slots(
            spark.createDataFrame(rows, "key string, us long, tie long"), ["key"], "us", width,
            half_up=half_up, tie="tie",
        ).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    want = {}
    for key in {r[0] for r in rows}:
        end = None
        for _, us, tie in sorted(r for r in rows if r[0] == key):
            opens = end is None or us >= end
            if opens:
                start, first = us, tie
                end = (us + width + (500_000 if half_up else 0)) // 1_000_000 * 1_000_000
            slot = (key, us // 1_000_000)
            if slot not in want:
                want[slot] = (start, first, end, opens)
    assert {(r.key, r.slot): (r.start_us, r.start_tie, r.end_us, r.opens) for r in got} == want


def test_hot_keys(spark):
    df = spark.createDataFrame([("hot", i) for i in range(40)] + [("cold", i) for i in range(32)], "key string, v long")
    hot = scan.hot_keys(df, ["key"], 32)
    assert [r.key for r in hot.listed.collect()] == ["hot"]
    assert hot.mark(df, ["key"]).where("_hot").count() == 40
    assert not scan.hot_keys(df, ["key"], 40).any


def test_one_shuffle_without_hot_keys(spark):
    df = spark.range(100).selectExpr("id % 5 AS key", "id AS seq")
    plan = running(df, ["key"], ["seq"], by_position("seq"), {"n": Running("sum", F.lit(1))})
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def walked(times, width, unit, half_up):
    """(start, end, opens) of each time, one after the other; ends are whole units."""
    start, end, out = None, None, []
    for t in times:
        if end is None or t // unit >= end:
            start, end = t, (t + width + (unit // 2 if half_up else 0)) // unit
            out.append((start, end * unit, True))
        else:
            out.append((start, end * unit, False))
    return out


@pytest.mark.parametrize("blocks", [2, 3, 7, 50])
def test_crowded_keys_in_blocks_of_time(spark, blocks):
    rng = random.Random(blocks)
    rows, want = [], []
    for key in ["a", "b", "c", None]:
        dense = rng.choice([2, 9, 40])
        slots = sorted(rng.sample(range(-300, 300), 600 // dense + 20))
        times = [s * 1000 + rng.randrange(1000) for s in slots]
        rows += [(key, t, i) for i, t in enumerate(times)]
        want += [(key, t // 1000, a, e, o) for t, (a, e, o) in zip(times, walked(times, 6400, 1000, True))]
    frame = spark.createDataFrame(rows, "key string, us long, off long").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1 + blocks * 2)
    try:
        got = anchored_slots(frame, ["key"], "us", 6400, 1000, tie="off", chunk_rows=1, block_units=blocks).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    assert sorted(map(repr, ((r.key, r.slot, r.start_us, r.end_us, r.opens) for r in got))) == sorted(map(repr, want))
    ties = {(k, t): i for k, t, i in rows}
    assert all(ties[r.key, r.start_us] == r.start_tie for r in got)


def test_exit_pointers():
    rng = np.random.default_rng(1)
    for _ in range(50):
        slot = np.unique(rng.integers(0, 60, rng.integers(1, 40)))
        end = slot + rng.integers(3, 5) + rng.integers(0, 2, len(slot))
        end = np.maximum.accumulate(end)
        want = []
        for i in range(len(slot)):
            j = i
            while (k := int(np.searchsorted(slot, end[j]))) < len(slot):
                j = k
            want.append(j)
        upto, last = exits(slot, end)
        assert [last[np.searchsorted(upto, i)] for i in range(len(slot))] == want
