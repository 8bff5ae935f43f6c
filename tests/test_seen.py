"""Ids kept over many runs, against all records at once and against the rule played record by record."""

import random

import pytest
from fixtures import at
from pyspark.sql import functions as F

from keyfold.operators.sequence import dedup_ttl
from keyfold.sources.seen import append_kept, read_seen

DAY = 86_400
COLUMNS = "topic string, part int, off long, ts timestamp, key string, event_id string"


def log(seed, n=400):
    rng, second, out = random.Random(seed), 0, []
    for off in range(n):
        second += rng.choice([0, 0, 1, 59, 600, 7_000, DAY // 2])
        out.append(("t", 0, off, second, rng.choice(["a", "a", "b", None]), rng.choice(["x", "y", "z", None])))
    return out


def frame(spark, log):
    return spark.createDataFrame([(t, p, o, at(s), k, i) for t, p, o, s, k, i in log], COLUMNS).repartition(3)


def played(log, ttl):
    last, out = {}, []
    for _, _, off, second, key, name in log:
        if name is None or (key, name) not in last or second >= last[key, name] + ttl:
            out.append(off)
            if name is not None:
                last[key, name] = second
    return out


@pytest.mark.parametrize("ttl, runs", [(60, 3), (2 * DAY, 10), (30 * DAY, 3)])
def test_runs_keep_what_one_run_keeps(spark, tmp_path, ttl, runs):
    whole = log(ttl)
    last = whole[-1][3] + 1
    for run in range(runs):
        part = [r for r in whole if r[3] * runs // last == run]
        append_kept(frame(spark, part), str(tmp_path), run, ttl)
    got = [r.off for r in spark.read.parquet(f"{tmp_path}/kept").orderBy("off").collect()]
    assert got == played(whole, ttl)
    assert got == [r.off for r in dedup_ttl(frame(spark, whole), ttl).orderBy("off").collect()]


def test_a_run_again_changes_nothing(spark, tmp_path):
    whole = log(5, 90)
    for run in (0, 1, 2, 1, 2):
        append_kept(frame(spark, whole[30 * run:30 * run + 30]), str(tmp_path), run, DAY)
    assert [r.off for r in spark.read.parquet(f"{tmp_path}/kept").orderBy("off").collect()] == played(whole, DAY)


def test_late_records_empty_runs_and_versions(spark, tmp_path):
    path = str(tmp_path)

    def run(number, *log, version="1"):
        made = frame(spark, [("t", 0, off, second, "k", name) for off, second, name in log])
        return [r.off for r in append_kept(made, path, number, 100, version).orderBy("off").collect()]

    assert run(0) == []
    assert run(1, (1, 1_000, "x"), (2, 1_050, "x"), (3, 1_000, None)) == [1, 3]
    assert run(2, (4, 990, "x"), (5, 1_099, "x"), (6, 990, "y")) == [6]
    assert run(3, (7, 1_100, "x"), (8, 1_050, None)) == [7, 8]
    assert run(4, (9, 1_150, "x"), (10, 1_150, "x"), version="2") == [9]
    assert run(5, (11, 1_160, "x"), version="1") == []


def test_days_that_are_over_are_not_read(spark, tmp_path):
    made = [frame(spark, [("t", 0, d, d * DAY, "k", f"x{d}")]) for d in range(6)]
    for run, part in enumerate(made):
        append_kept(part, str(tmp_path), run, DAY)
    first = made[5].agg(F.unix_micros(F.min("ts"))).first()[0]
    seen = read_seen(made[5], str(tmp_path), 5, first)
    assert [r.event_id for r in seen.collect()] == ["x4"]
    scan = next(line for line in seen._jdf.queryExecution().toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(until" in scan
    assert seen.select(F.input_file_name()).distinct().count() == 1
