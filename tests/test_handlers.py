"""Definitions, handles and handlers; no Spark but in the last tests."""

import time

import pytest
from fixtures import at, micro_batches, records, rows

from keyfold.functions.exceptions import (
    PermanentError, PermanentStateError, TransientError, TransientStateError, is_permanent, permanent, transient,
)
from keyfold.state import definitions as d
from keyfold.streaming.handler import CachedStore, KeyRun, MemoryStore, Settings, check_handler, run_stream, run_table
from keyfold.streaming.handles import open_handle
from keyfold.streaming.message import Message
from keyfold.streaming.run import run_available


def message(off, text="{}", s=0, key="a"):
    return Message("t", 0, off, int(s * 1_000_000), key, text)


def handle(definition, store=None, now_s=0):
    return open_handle(d.register([definition]), definition, store or MemoryStore(), int(now_s * 1_000_000))


@pytest.mark.parametrize("ttl", [0, 0.5, 2.5, -1, float("nan"), float("inf"), True, "5"])
def test_ttl_is_a_whole_number(ttl):
    with pytest.raises(d.DefinitionError, match="ttl_seconds: must be a whole number"):
        d.value("v", ttl_seconds=ttl)


def test_options_by_kind():
    assert d.map("m", keyset_limit=0).keyset_limit == 0
    assert d.deque("q", capacity=100.0).capacity == 100
    assert d.message_deque("q", capacity=1).payload == "message"
    for bad in (
        lambda: d.value("v", keyset_limit=5), lambda: d.value("v", capacity=5), lambda: d.map("m", capacity=5),
        lambda: d.map("m", keyset_limit=4097), lambda: d.map("m", keyset_limit=2.5), lambda: d.deque("q", capacity=0),
        lambda: d.message_value("v", published=True), lambda: d.Collection("x", "bogus"),
        lambda: d.Collection("x", "value", "bogus"), lambda: d.value(""),
        lambda: d.register([d.value("x"), d.map("x")]), lambda: d.register([{"name": "x"}]),
    ):
        with pytest.raises(d.DefinitionError):
            bad()


def test_value_handle():
    store = MemoryStore()
    v = handle(d.value("v"), store)
    assert v.get() is None
    rich = {"s": "café 😀", "n": 3.5, "b": True, "arr": [1, "x", None], "nested": {"z": [True, 2]}}
    v.set(rich)
    assert v.get() == rich
    v.commit()
    v.set({"v": "B"})
    assert v.get() == {"v": "B"}
    v.rollback()
    assert v.get() == rich
    v.set([float("nan"), float("inf")])
    assert v.get() == [None, None]
    for bad in (None, float("nan"), object(), message(1)):
        with pytest.raises(TransientStateError):
            v.set(bad)
    v.clear()
    v.commit()
    assert v.get() is None and not store.tables["v"]


def test_map_handle():
    store = MemoryStore()
    m = handle(d.map("m"), store)
    for key, item in (("k1", 1), ("😀", 7), ("café", 9)):
        m.set(key, item)
    m.commit()
    m.set("k1", 2)
    m.set("dropped", 9)
    m.delete("café")
    assert list(m.keys()) == ["dropped", "k1", "😀"] and list(m.keys(backward=True)) == ["😀", "k1", "dropped"]
    m.rollback()
    assert list(m) == [("café", 9), ("k1", 1), ("😀", 7)] and list(m.values()) == [9, 1, 7]
    assert m.get_many(["k1", "missing", "k1"]) == [1, None, 1] and m.get_many([]) == []
    assert m.has("k1") and not m.has("missing")
    m.clear()
    m.set("new", 1)
    m.commit()
    assert dict(m.entries()) == {"new": 1}


def test_deque_handle():
    q = handle(d.deque("q"))
    assert q.pop() is None and q.shift() is None and q.is_empty()
    for item in ("a", {"v": 1}, [2, "😀"]):
        q.push(item)
    q.commit()
    assert (q.at(0), q.at(-1), q.at(-2), q.at(-4), q.at(2**32)) == ("a", [2, "😀"], {"v": 1}, None, None)
    for bad in (1.5, float("nan"), float("inf"), "x", None):
        with pytest.raises(TransientStateError, match="index"):
            q.at(bad)
    assert q.shift() == "a" and q.pop() == [2, "😀"] and q.length() == 1
    q.rollback()
    assert list(q) == ["a", {"v": 1}, [2, "😀"]] and list(q.values(backward=True))[0] == [2, "😀"]
    q.unshift("front")
    q.commit()
    assert q.at(0) == "front"
    q.clear()
    q.commit()
    assert q.length() == 0


def test_deque_capacity_is_lazy():
    store = MemoryStore()
    wide = handle(d.deque("q", capacity=4), store)
    for i in range(6):
        wide.push(i)
    wide.commit()
    assert list(wide) == [2, 3, 4, 5] and len(store.tables["q"]) == 4
    narrow = handle(d.deque("q", capacity=2), store)
    assert narrow.length() == 4
    narrow.unshift("x")
    narrow.commit()
    assert list(narrow) == ["x", 2] and len(store.tables["q"]) == 2


def test_items_expire():
    store = MemoryStore()
    q = handle(d.deque("q", ttl_seconds=10), store)
    q.push("old")
    q.commit()
    q = handle(d.deque("q", ttl_seconds=10), store, 5)
    q.push("new")
    q.commit()
    q = handle(d.deque("q", ttl_seconds=10), store, 10)
    assert q.at(0) is None and q.at(1) == "new" and q.length() == 2 and list(q) == ["new"]
    q = handle(d.deque("q", ttl_seconds=10), store, 15)
    assert q.is_empty() and q.pop() is None
    q.push("again")
    q.commit()
    assert list(q) == ["again"] and q.length() == 1


def test_message_collections_take_messages_only():
    v = handle(d.message_value("v"))
    v.set(message(3, '{"n":1}'))
    assert v.get().off == 3 and v.get().payload == {"n": 1}
    with pytest.raises(TransientStateError):
        v.set({"n": 1})
    with pytest.raises(PermanentStateError):
        open_handle(d.register([d.value("other")]), d.value("v"), MemoryStore(), 0)


def test_error_decorators():
    @permanent(TypeError)
    @transient(KeyError)
    def work(error):
        raise error

    with pytest.raises(PermanentError) as found:
        work(TypeError("x"))
    assert is_permanent(found.value) and isinstance(found.value.__cause__, TypeError)
    with pytest.raises(TransientError):
        work(KeyError("x"))
    with pytest.raises(ValueError):
        work(ValueError("x"))
    assert not is_permanent(ValueError()) and is_permanent(PermanentStateError())


def test_handlers_need_three_methods():
    class Half:
        def on_message(self, ctx, m): ...

    with pytest.raises(TypeError, match="on_excise, on_timer"):
        check_handler(Half())


COUNT = d.value("count")


class Scripted:
    """Fails as its payload says; keeps a count and what it saw."""

    def __init__(self):
        self.seen = []
        self.tries = {}

    def on_message(self, ctx, m):
        self.tries[m.off] = self.tries.get(m.off, 0) + 1
        count = ctx.state(COUNT)
        count.set((count.get() or 0) + 1)
        step = m.payload
        if step.get("commit"):
            count.commit()
        if step.get("schedule"):
            ctx.schedule(ctx.now_us + step["schedule"] * 1_000_000)
        if self.tries[m.off] <= step.get("fail", 0):
            raise ValueError("not yet")
        if step.get("permanent"):
            raise PermanentError("never")
        self.seen.append(m.off)
        return {"count": count.get()}

    def on_excise(self, ctx, m):
        ctx.state(COUNT).clear()
        ctx.clear_scheduled()

    def on_timer(self, ctx, timer):
        self.seen.append(("timer", timer.time_us // 1_000_000))


def run(messages, **settings):
    handler = Scripted()
    key = KeyRun(handler, d.register([COUNT]), Settings(**settings), MemoryStore(), ("t", "a"),
                 lambda us: None, lambda us: None)
    for m in messages:
        key.record(m)
    key.finish(3600 * 1_000_000)
    return handler, [(off, kind, body) for _, _, off, _, kind, body in key.take()]


def test_failed_attempts_leave_no_state():
    _, out = run([message(1, '{"fail": 2}'), message(2, "{}", 100)], mode="low_latency")
    assert out == [(1, "response", '{"count": 1}'), (2, "response", '{"count": 2}')]
    _, out = run([message(1, '{"fail": 1, "commit": true}')], mode="low_latency")
    assert out == [(1, "response", '{"count": 2}')]


def test_modes():
    steps = [message(1, '{"fail": 9}'), message(2, '{"permanent": true}', 1), message(3, "{}", 2)]
    _, out = run(steps, mode="low_latency", max_retries=3)
    assert [(o, k) for o, k, _ in out] == [(1, "dead_letter"), (2, "dead_letter"), (3, "response")]
    _, out = run(steps, mode="best_effort")
    assert [(o, k) for o, k, _ in out] == [(1, "dropped"), (2, "dropped"), (3, "response")]
    with pytest.raises(ValueError):
        run(steps, mode="pipeline", defer=False)


def test_parked_records_hold_back_their_key():
    handler, out = run([message(1, '{"fail": 3}'), message(2, "{}", 2), message(3, "{}", 50)])
    # tries at 0, 1, 3 and 7 seconds; record 2 waits, record 3 comes later
    assert handler.seen == [1, 2, 3] and handler.tries == {1: 4, 2: 1, 3: 1}
    assert [k for _, k, _ in out] == ["response"] * 3


def test_timers_fire_before_later_records_and_survive_failures():
    handler, _ = run([message(1, '{"schedule": 5, "permanent": true}'), message(2, "{}", 5), message(3, "{}", 6)])
    assert handler.seen == [("timer", 5), 2, 3]
    handler, _ = run([message(1, '{"schedule": 5}'), message(2, None, 1), message(3, "{}", 9)])
    assert handler.seen == [1, 3]


class Restless(Scripted):
    """Its first timer fails twice; every later one sets the next."""

    fails = 2

    def on_timer(self, ctx, timer):
        if self.fails:
            self.fails -= 1
            raise ValueError("not yet")
        super().on_timer(ctx, timer)
        ctx.schedule(ctx.now_us + 600_000_000)


def passed(handler, *messages):
    key = KeyRun(handler, d.register([COUNT]), Settings(), MemoryStore(), ("t", "a"), lambda us: None, lambda us: None)
    for m in messages:
        key.record(m)
    key.finish(3600 * 1_000_000)
    return [(off, kind, body) for _, _, off, _, kind, body in key.take()]


def test_failed_timers_are_tried_again_and_tables_end():
    handler = Restless()
    out = passed(handler, message(1, '{"schedule": 5}'))
    # tried at 5, 6 and 8 seconds, then each ten minutes until an hour after the first
    assert handler.seen == [1, ("timer", 5), *(("timer", 8 + 600 * i) for i in range(1, 6))]
    assert out[1:] == [(None, "pending", '{"timer_us": 3608000000}')]
    # a record that never succeeds holds back the next, and both are told
    out = passed(Scripted(), message(1, '{"fail": 1000000}'), message(2, "{}", 1))
    assert out == [(1, "pending", "{}"), (2, "pending", "{}")]


def test_many_timers_cost_no_square():
    handler = Scripted()
    started = time.time()
    passed(handler, *(message(i, '{"schedule": 100000}', i) for i in range(8000)))
    assert len(handler.seen) == 16000 and time.time() - started < 5


def test_expired_items_leave_the_state():
    value, items, queue = d.value("v", ttl_seconds=10), d.map("m", ttl_seconds=20), d.deque("q", ttl_seconds=10)
    backing, armed = MemoryStore(), set()

    class Writer(Scripted):
        def on_message(self, ctx, m):
            ctx.state(value).set(m.off)
            ctx.state(items).set(str(m.off), m.off)
            ctx.state(queue).push(m.off)

    def invoke(*messages, expiry_s=None):
        key = KeyRun(Writer(), d.register([value, items, queue]), Settings(), CachedStore(backing), ("t", "a"),
                     armed.add, armed.discard)
        for m in messages:
            key.record(m)
        if expiry_s is not None:
            key.purge(expiry_s * 1_000_000)
        key.save()

    invoke(message(1), message(2, s=4))
    assert armed == {14_000_000}
    invoke(expiry_s=14)
    assert not backing.tables["v"] and not backing.tables["q"] and not backing.tables["q_ends"]
    assert len(backing.tables["m"]) == 2 and armed == {14_000_000, 20_000_000}
    invoke(expiry_s=24)
    assert not any(backing.tables.values())


def test_payload_that_is_not_json_is_permanent():
    _, out = run([message(1, "{"), message(2, "NaN", 1)], mode="low_latency")
    assert [k for _, k, _ in out] == ["dead_letter", "dead_letter"]


class Totals:
    TOTALS, LOG = d.map("totals"), d.message_deque("log", capacity=2)
    collections = [TOTALS, LOG]

    def on_message(self, ctx, m):
        totals, log = ctx.state(self.TOTALS), ctx.state(self.LOG)
        name = m.payload["k"]
        totals.set(name, (totals.get(name) or 0) + 1)
        log.push(m)
        ctx.clear_and_schedule(ctx.now_us + 60_000_000)
        return {"totals": dict(totals.entries()), "log": [x.off for x in log], "next": ctx.scheduled()}

    def on_excise(self, ctx, m):
        ctx.state(self.TOTALS).clear()
        ctx.state(self.LOG).clear()
        ctx.clear_scheduled()

    def on_timer(self, ctx, timer):
        ctx.emit({"idle": timer.time_us})


LOG_ROWS = [("a", 0, 0, '{"k":"x"}'), ("b", 1, 1, '{"k":"x"}'), ("a", 2, 2, '{"k":"y"}'), ("a", 3, 10, '{"k":"x"}'),
            ("b", 4, 100, None), ("a", 5, 130, '{"k":"z"}'), ("b", 6, 131, '{"k":"x"}'), ("end", 7, 900, '{"k":"x"}')]


def test_stream_in_many_batches_equals_table(spark, tmp_path):
    table = records(spark, LOG_ROWS)
    stream = micro_batches(spark, tmp_path, [records(spark, LOG_ROWS[i:i + 2]) for i in range(0, 8, 2)])
    handler = Totals()
    columns = ["key", "off", "kind", "body", "at"]
    got = run_available(run_stream(stream, handler, handler.collections, watermark="0 seconds"), f"totals-{tmp_path.name}", 2)
    want = run_table(table, handler, handler.collections)
    closed = [r for r in rows(want, *columns) if not (r[0] == "end" and r[2] == "emit")]
    assert rows(got, *columns) == closed
    assert ("a", None, "emit", '{"idle": 70000000}'.replace("70000000", str(int((at(70) - at(0)).total_seconds() * 1e6)
            + 1_704_067_200_000_000)), at(70)) in closed
