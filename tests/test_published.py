"""Committed state as versions and reads as of their time, against the rules played step by step."""

import random

import pytest
from fixtures import at
from pyspark.sql import functions as F

from keyfold.operators import intervals, published, refs, txn, versions
from keyfold.schema import RECORD
from keyfold.sources.log import read_chunked_log, write_chunked_log
from keyfold.sources.published import append_versions, read_versions

KEYS = ["a", "b", None]


def attempts(seed, kinds):
    """Rows (key, seq, second, attempt, outcome, op, map_key, item); attempts of a key follow each other."""
    rng, rows = random.Random(seed), []
    for key in KEYS:
        second = 0
        for attempt in range(14):
            outcome = rng.choice(["ok", "ok", "failed", "crashed"])
            for _ in range(rng.randrange(1, 7)):
                second += rng.choice([0, 1, 3, 2000, 9000])
                op = rng.choice([*kinds, *kinds, "commit", "rollback"])
                rows.append((key, len(rows), second, attempt, outcome, op, rng.choice("xyz"), f"i{len(rows)}"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [("t", k, "c", n, at(s), a, o, op, m if op in ("set", "delete") else None, i if op in ("set", "push", "unshift") else None)
         for k, n, s, a, o, op, m, i in rows],
        "topic string, key string, collection string, seq long, ts timestamp, attempt long, outcome string, op string, "
        "map_key string, item string").repartition(3)


def commits(rows):
    """(key, seq, op, map_key, item, second it is seen from), attempt by attempt."""
    out = []
    for key in KEYS:
        for attempt in sorted({r[3] for r in rows if r[0] == key}):
            own, staged = [r for r in rows if r[0] == key and r[3] == attempt], []
            for r in own:
                if r[5] == "commit":
                    out += [(*s, r[2]) for s in staged]
                    staged = []
                elif r[5] == "rollback":
                    staged = []
                else:
                    staged.append((r[0], r[1], r[5], r[6], r[7]))
            if own[0][4] == "ok":
                out += [(*s, own[-1][2]) for s in staged]
    return out


def lookups(spark, rows, seed):
    rng = random.Random(seed)
    last = max(r[2] for r in rows)
    asked = [(n, rng.choice([*KEYS, "never"]), rng.randrange(-5, last + 10), rng.choice("xyzw"), rng.choice([-5, -2, -1, 0, 1, 2, 7, 0.5, None]))
             for n in range(150)]
    return asked, spark.createDataFrame(
        [(n, "t", k, "c", at(s), m, None if i is None else float(i)) for n, k, s, m, i in asked],
        "lookup_id long, topic string, key string, collection string, read_ts timestamp, map_key string, i double").repartition(4)


def entries(done, key, second):
    held = {}
    for k, _, op, m, item, seen in done:
        if k == key and seen <= second:
            if op == "set":
                held[m] = item
            elif op == "delete":
                held.pop(m, None)
            elif op == "clear":
                held.clear()
    return held


@pytest.mark.parametrize("seed", [1, 2])
def test_map_reads_see_what_was_committed_by_then(spark, seed):
    rows = attempts(seed, ["set", "set", "delete", "clear"])
    done, log = commits(rows), txn.commit_log(frame(spark, rows), chunk_rows=5)
    assert sorted((r.seq, r.op) for r in log.collect()) == sorted((d[1], d[2]) for d in done)
    asked, reads = lookups(spark, rows, seed)
    want = {n: entries(done, k, s) for n, k, s, _, _ in asked}
    got = {r.lookup_id: (r.item, r.present) for r in published.published_map_get(log, reads).collect()}
    assert got == {n: (want[n].get(m), m in want[n]) for n, _, _, m, _ in asked}
    every = published.published_map_entries(log, reads.drop("map_key")).collect()
    assert sorted((r.lookup_id, r.map_key, r.item) for r in every) == sorted((n, m, i) for n, e in want.items() for m, i in e.items())
    names = published.published_map_entries(log, reads.drop("map_key"), values=False)
    assert "item" not in names.columns and names.count() == len(every)
    many = reads.drop("map_key").withColumn("keys", F.when(F.col("lookup_id") % 5 > 0, F.array(F.lit("x"), F.lit("w"), F.lit("x"))).otherwise(F.array()))
    found = {(r.lookup_id, r.pos): r.item for r in published.published_map_get_many(log, many).collect()}
    assert found == {(n, p): (None if p is None else want[n].get("xwx"[p])) for n, *_ in asked for p in (range(3) if n % 5 else [None])}


def test_versions_of_many_runs_equal_those_of_one(spark, tmp_path):
    rows = attempts(5, ["set", "set", "delete", "clear"])
    log = txn.commit_log(frame(spark, rows))
    for name, part, whole in (("map", log, versions.map_versions(log)), ("value", log.drop("map_key"), versions.value_versions(log.where("op <> 'delete'")))):
        part = part if name == "map" else part.where("op <> 'delete'")
        for run in range(7):
            append_versions(part.where(F.floor(F.col("attempt") / 2) == run), f"{tmp_path}/{name}", run)
        append_versions(part.where(F.floor(F.col("attempt") / 2) == 6), f"{tmp_path}/{name}", 6)  # again, as after a loss
        got = read_versions(spark, f"{tmp_path}/{name}")
        assert sorted(map(repr, got.select(whole.columns).collect())) == sorted(map(repr, whole.collect()))


def queue(done, key, second, capacity):
    held = []
    for k, _, op, _, item, seen in done:
        if k == key and seen <= second:
            if op == "push":
                held = [*held, item][-capacity:]
            elif op == "unshift":
                held = [item, *held][:capacity]
            elif op == "clear":
                held = []
            else:
                held = held[:-1] if op == "pop" else held[1:]
    return held


def test_deque_reads_see_what_was_committed_by_then(spark):
    rows = [r for r in attempts(3, ["push", "push", "unshift", "pop", "shift", "clear"]) if r[0] is not None]
    done, log = [d for d in commits(rows) if d[0] is not None], None
    log = txn.commit_log(frame(spark, rows))
    asked, reads = lookups(spark, rows, 4)
    reads = reads.where("key is not null").drop("map_key")
    asked = [a for a in asked if a[1] is not None]
    want = {n: queue(done, k, s, 3) for n, k, s, _, _ in asked}

    def item(held, i):
        return held[int(i)] if i is not None and i == int(i) and -len(held) <= i < len(held) else None

    got = {r.lookup_id: (r.item, r.length, r.is_empty, r.error_category) for r in published.published_deque_at(log, reads, 3).collect()}
    assert got == {n: (item(want[n], i), len(want[n]), not want[n], None if i is not None and i == int(i) else "transient") for n, _, _, _, i in asked}
    found = {}
    for r in published.published_deque_values(log, reads, 3).orderBy("lookup_id", "pos").collect():
        found.setdefault(r.lookup_id, []).append(r.item)
    assert found == {n: q for n, q in want.items() if q}


def test_retired_collections_are_not_served(spark):
    changes = spark.createDataFrame([
        ("s", "c", "json", True, "g2", at(10), 1), ("s", "c", "json", True, "g1", at(20), 2), ("s", "c", "json", False, "g1", at(30), 3),
        ("s", "c", "message", True, "g2", at(40), 4), ("s", "d", "json", False, "g1", at(5), 5)],
        "subsystem string, collection string, payload string, published boolean, group_id string, ts timestamp, seq long")
    asked = spark.createDataFrame([(s, "s", c, at(s)) for s, c in ((5, "c"), (10, "c"), (25, "c"), (35, "c"), (45, "c"), (50, "d"))],
                                  "lookup_id long, subsystem string, collection string, read_ts timestamp")
    got = {r.lookup_id: r.group_id for r in published.serving_group(asked, changes).collect()}
    assert got == {5: None, 10: "g2", 25: "g1", 35: "g2", 45: None, 50: None}


def test_spans_meet_instants_once(spark):
    rng = random.Random(8)
    size = intervals.LEAF_US
    spans, instants = [], []
    for n in range(250):
        start = rng.randrange(-20, 3000) * size // rng.choice([1, 7, 1000]) + rng.choice([0, 0, 1, -1])
        end = rng.choice([start, start + 1, start + size, start + rng.randrange(1, 900) * size // rng.choice([1, 3]), None])
        spans.append((rng.choice(["a", "b", None]), n, start, end))
    for n in range(250):
        near = rng.choice(spans)
        instants.append((rng.choice(["a", "b", None]), n, rng.choice([near[2], near[2] - 1, near[3] or 0, rng.randrange(0, 4000) * size])))
    met = intervals.stab(spark.createDataFrame(instants, "key string, i long, at long"),
                         spark.createDataFrame(spans, "key string, s long, from_us long, to_us long"), ["key"], "at")
    want = sorted((i, s) for k, i, t in instants for q, s, a, b in spans if k == q and a <= t and (b is None or t < b))
    assert sorted((r.i, r.s) for r in met.collect()) == want and len(want) > 500
    one = spark.range(1).select(F.size(intervals.cover(F.lit(1), F.lit(1 << 58))).alias("n")).first().n
    assert one <= 2 + 2 * intervals.DEPTH


def test_references_read_only_the_folders_they_point_into(spark, tmp_path):
    rows = [("t", p, off, at(off), f"k{off % 7}", f'{{"n":{off}}}', None) for p in (0, 1) for off in range(400)]
    log = spark.createDataFrame(rows, RECORD)
    write_chunked_log(log.where("off <> 55"), f"{tmp_path}/log", 10)
    asked = spark.createDataFrame([(1, ("t", 0, 51)), (2, ("t", 0, 55)), (3, ("t", 1, 399)), (4, None), (5, ("t", 0, -3)), (6, ("u", 0, 1)), (7, ("t", 0, 51))],
                                  "n int, item struct<topic: string, part: int, off: long>")
    asked.coalesce(1).write.parquet(f"{tmp_path}/asked")
    asked = spark.read.parquet(f"{tmp_path}/asked")
    conf = {"spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = refs.resolve_refs(asked, read_chunked_log(spark, f"{tmp_path}/log"), columns=["ts"], chunk_offsets=10)
        got = {r.n: r.message for r in found.collect()}
        plan, files = found._jdf.queryExecution().executedPlan(), []
        leaves = plan.collectLeaves()
        for i in range(leaves.size()):
            metrics = leaves.apply(i).metrics()
            if metrics.contains("numFiles"):
                files.append(metrics.apply("numFiles").value())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {n: None if m is None else (m.topic, m.part, m.off, m.ts) for n, m in got.items()} == {
        1: ("t", 0, 51, at(51)), 2: None, 3: ("t", 1, 399, at(399)), 4: None, 5: None, 6: None, 7: ("t", 0, 51, at(51))}
    # of 80 folders two hold what is asked for; the references' own file is read more than once
    assert sum(files) < 10


def by_itself(frame):
    """The plan as Spark makes it before a query runs, without tables cut off by a checkpoint."""
    return frame._jdf.queryExecution().executedPlan().toString()


def test_spans_and_instants_of_small_files_are_not_sent_through_the_driver(spark, tmp_path):
    spark.createDataFrame([("a", 1, 0, None)], "key string, s long, from_us long, to_us long").write.parquet(f"{tmp_path}/spans")
    spark.createDataFrame([("a", 1, 5)], "key string, i long, at long").write.parquet(f"{tmp_path}/instants")
    spans, instants = spark.read.parquet(f"{tmp_path}/spans"), spark.read.parquet(f"{tmp_path}/instants")
    met = intervals.stab(instants, spans, ["key"], "at")
    assert [(r.i, r.s) for r in met.collect()] == [(1, 1)]
    assert "BroadcastExchange" not in by_itself(met)
    least = intervals.least_held(instants, spans, ["key"], "at", "i", "s")
    assert [(r.i, r.s) for r in least.collect()] == [(1, 1)]
    assert "BroadcastExchange" not in by_itself(least)


def test_the_least_span_needs_no_pairs(spark, tmp_path):
    """Every change and every lookup in one collection: pairs of both would be their product."""
    n = 300
    changes = spark.range(n).selectExpr(
        "'s' subsystem", "'c' collection", "'json' payload", "true published", "concat('g', 1000 - id) group_id",
        "timestamp_seconds(id) ts", "id seq")
    asked = spark.range(n).selectExpr("id lookup_id", "'s' subsystem", "'c' collection", f"timestamp_seconds({n} + id) read_ts")
    found = published.serving_group(asked, changes)
    assert {r.group_id for r in found.collect()} == {"g1000"}
    leaves, most = [found._jdf.queryExecution().executedPlan()], 0
    while leaves:
        node = leaves.pop()
        if node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan() if "QueryStage" in node.nodeName() else None
        if children is not None:
            leaves.append(children)
        for i in range(node.children().size()):
            leaves.append(node.children().apply(i))
    assert 0 < most < n * n / 10


def test_least_held_by_brute_force(spark):
    rng = random.Random(21)
    size = intervals.LEAF_US
    spans, instants = [], []
    for n in range(300):
        start = rng.choice([None, rng.randrange(-20, 3000) * size // rng.choice([1, 7, 1000]) + rng.choice([0, 0, 1, -1])])
        end = None if start is None else rng.choice([start, start + 1, start + size, start + rng.randrange(1, 900) * size // rng.choice([1, 3]), None])
        spans.append((rng.choice(["a", "b", None]), rng.choice([None, f"g{rng.randrange(40)}", "é", "\U0001f600", "￮"]), start, end))
    for n in range(400):
        near = rng.choice(spans)
        instants.append((rng.choice(["a", "b", "c", None]), n // 2, rng.choice([None, near[2], (near[2] or 0) - 1, near[3] or 0, rng.randrange(-30, 4000) * size])))
    got = intervals.least_held(spark.createDataFrame(instants, "key string, i long, at long"),
                               spark.createDataFrame(spans, "key string, g string, from_us long, to_us long"), ["key"], "at", "i", "g").collect()

    def least(k, t):
        return min((g for q, g, a, b in spans if k == q and g is not None and a is not None and a <= t and (b is None or t < b)), default=None)

    want = [(i, least(k, t)) for k, i, t in instants if t is not None]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and sum(g is not None for _, g in want) > 100


def test_small_ranges_of_offsets_share_folders(spark, tmp_path):
    log = spark.createDataFrame([("t", off % 2, off, at(off), "k", "{}", None) for off in range(3000)], RECORD)
    write_chunked_log(log, f"{tmp_path}/log", 10)
    assert len(list(tmp_path.glob("log/topic=*/part=*/*=*"))) == 2
    far = refs.FOLDER_OFFSETS * 3 + 7
    write_chunked_log(log.limit(1).withColumn("off", F.lit(far).cast("long")), f"{tmp_path}/far", 10)
    for off, path in ((2999, "log"), (far, "far")):
        asked = spark.createDataFrame([(1, ("t", off % 2 if path == "log" else 0, off))], "n int, item struct<topic: string, part: int, off: long>")
        got = refs.resolve_refs(asked, read_chunked_log(spark, f"{tmp_path}/{path}"), columns=["off_chunk"], chunk_offsets=10).first()
        assert got.message is not None and (got.message.off, got.message.off_chunk) == (off, off // 10)
