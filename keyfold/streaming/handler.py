"""User handlers run per key, in order, with state and timers.

A handler has ``on_message``, ``on_excise`` and ``on_timer``. ``run_stream`` runs
it with ``transformWithState`` and ``run_table`` over a sorted table; both give the
same rows. Records of a key come in offset order. Time is event time: a timer due
at or before a record's time fires before that record.

Rows of one key within a micro-batch are sorted in memory, so bound the batch
with ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``. A table is never held:
it streams through in key order.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyfold.functions.errors import DEFER_BASE_MS, DEFER_CAP_MS
from keyfold.functions.exceptions import PermanentStateError, TransientStateError, is_permanent
from keyfold.functions.times import from_micros, micros
from keyfold.operators.anchored import key_at, key_changes
from keyfold.schema import KEY
from keyfold.session import configure
from keyfold.state.definitions import Collection, register
from keyfold.streaming.handles import expired, open_handle, to_json
from keyfold.streaming.message import Message

SECOND = 1_000_000
METHODS = ("on_message", "on_excise", "on_timer")
OUTPUT = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("off", T.LongType()),
    T.StructField("at_us", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("body", T.StringType()),
])


@dataclass(frozen=True)
class Timer:
    key: str
    time_us: int


def round_second(us: int) -> int:
    return (us + SECOND // 2) // SECOND * SECOND


class Context:
    """What a handler sees of its key while it works on one event."""

    def __init__(self, run: KeyRun, now_us: int):
        self._run, self.now_us = run, now_us
        self._handles: dict[str, object] = {}

    def state(self, definition: Collection):
        name = definition.name
        if name not in self._handles:
            self._handles[name] = open_handle(self._run.collections, definition, self._run.store, self.now_us)
        return self._handles[name]

    def schedule(self, time_us: int) -> None:
        self._run.add_timer(round_second(time_us))

    def clear_and_schedule(self, time_us: int) -> None:
        self.clear_scheduled()
        self.schedule(time_us)

    def unschedule(self, time_us: int) -> None:
        self._run.drop_timer(round_second(time_us))

    def clear_scheduled(self) -> None:
        for time_us in list(self._run.timers()):
            self._run.drop_timer(time_us)

    def scheduled(self) -> list[int]:
        return sorted(self._run.timers())

    def emit(self, body) -> None:
        """Send a row at once; it is not taken back when the handler fails."""
        self._run.out("emit", body)

    def finish(self, keep: bool) -> None:
        for handle in self._handles.values():
            handle.commit() if keep else handle.rollback()


@dataclass(frozen=True)
class Settings:
    """How failures are handled; see ``operators.failures.route_by_mode``."""

    mode: str = "pipeline"
    max_retries: int = 3
    defer: bool = True
    defer_base_ms: int = DEFER_BASE_MS
    defer_cap_ms: int = DEFER_CAP_MS


class KeyRun:
    """One key's pass through its events."""

    def __init__(self, handler, collections, settings: Settings, store, key, arm, disarm):
        self.handler, self.collections, self.settings = handler, collections, settings
        self.store, (self.topic, self.key) = store, key
        self._arm, self._disarm = arm, disarm
        self._timers, self._stored, self._alarms, self._heap = None, frozenset(), {}, []
        self.rows: list[tuple] = []
        self._off, self._now = None, 0

    # timers are stored at once, whatever becomes of the event
    def timers(self) -> set[int]:
        if self._timers is None:
            self._timers = {t for t, _ in self.store.items("_timers")}
            self._stored = frozenset(self._timers)
            self._heap = sorted(self._timers)
        return self._timers

    def add_timer(self, us: int) -> None:
        if us not in self.timers():
            self.timers().add(us)
            heapq.heappush(self._heap, us)
            self.store.put("_timers", us, (1,), new=us not in self._stored)
            self._alarms[us] = True

    def drop_timer(self, us: int) -> None:
        if us in self.timers():
            self.timers().discard(us)
            self.store.remove("_timers", us)
            self._alarms[us] = False

    def next_timer(self) -> int | None:
        timers = self.timers()
        while self._heap and self._heap[0] not in timers:
            heapq.heappop(self._heap)
        return self._heap[0] if self._heap else None

    def next_due(self) -> int | None:
        """The next time at which something is to be done without a record."""
        front, back, _, retry = self._parked()
        purge = self.store.get("_purge", "")
        due = [self.next_timer(), retry if front < back else None, None if purge is None else purge[0]]
        return min((t for t in due if t is not None), default=None)

    def purge(self, now_us: int) -> None:
        """Take expired items out of the state, where reads only skip them."""
        planned = self.store.get("_purge", "")
        if planned is None or planned[0] > now_us:
            return
        left = []
        for c in self.collections.values():
            if c.ttl_seconds is None:
                continue
            tables = [(c.name, self.store.items(c.name))] if c.kind != "value" else []
            ends = c.name if c.kind == "value" else c.name + "_ends"
            if c.kind != "map":
                cell = self.store.get(ends, "")
                tables.append((ends, [] if cell is None else [("", cell)]))
            for name, cells in tables:
                for key, cell in cells:
                    if expired(c, cell[-1], now_us):
                        self.store.remove(name, key)
                    else:
                        left.append(cell[-1] + c.ttl_seconds * SECOND)
        self.store.remove("_purge", "")
        if left:
            self._plan_purge(min(left))

    def _plan_purge(self, due_us: int) -> None:
        self.store.put("_purge", "", (due_us,))
        self._arm(due_us)

    def save(self) -> None:
        """Hand what is left of the changes to Spark, once per invocation."""
        ttls = [c.ttl_seconds for c in self.collections.values()
                if c.ttl_seconds is not None and self.store.wrote(c.name)]
        if ttls and self.store.get("_purge", "") is None:
            self._plan_purge(self._now + min(ttls) * SECOND)
        for us, on in self._alarms.items():
            if on and us not in self._stored:
                self._arm(us)
            elif not on and us in self._stored:
                self._disarm(us)
        self.store.flush()

    def out(self, kind: str, body) -> None:
        self.rows.append((self.topic, self.key, self._off, self._now, kind, to_json(body)))

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows

    def _attempt(self, method: str, event, now_us: int) -> BaseException | None:
        context = Context(self, now_us)
        try:
            result = getattr(self.handler, method)(context, event)
            try:
                body = to_json(result)
            except TransientStateError as error:  # it would fail alike again
                raise PermanentStateError(f"result has no JSON form: {error}") from error
        except Exception as error:  # the handler's own failure, classified below
            context.finish(False)
            return error
        context.finish(True)
        if method != "on_timer":
            self.rows.append((self.topic, self.key, self._off, self._now, "response", body))
        return None

    def _run(self, method: str, event, off, now_us: int, may_park: bool) -> bool:
        """Run an event with the retries its mode allows; False when it is to be parked."""
        self._off, self._now = off, now_us
        settings = self.settings
        low_latency = settings.mode == "low_latency"
        for attempt in range(1 + (settings.max_retries if low_latency else 0)):
            error = self._attempt(method, event, now_us)
            if error is None:
                return True
            if is_permanent(error):
                break
        if settings.mode == "pipeline" and not is_permanent(error):
            if not settings.defer:
                raise error  # the task fails and Spark runs the batch again
            if may_park:
                return False
        kind = "dead_letter" if low_latency else "dropped"
        self.out(kind, {"error": type(error).__name__, "message": str(error)})
        return True

    def _deliver(self, message: Message, now_us: int) -> bool:
        method = "on_excise" if message.text is None else "on_message"
        return self._run(method, message, message.off, now_us, may_park=True)

    def _again(self, event: str, now_us: int) -> bool:
        """Deliver what was parked: a record, or a timer as ``{"timer_us": …}``."""
        parked = json.loads(event)
        if isinstance(parked, dict):
            return self._run("on_timer", Timer(self.key, parked["timer_us"]), None, now_us, may_park=True)
        return self._deliver(Message(*parked), now_us)

    # parked records and timers: a queue at rising positions and the time of the next try
    def _parked(self):
        return self.store.get("_parked_ends", "") or (0, 0, 0, 0)

    def _set_parked(self, front: int, back: int, tries: int, due_us: int) -> None:
        self.store.put("_parked_ends", "", (front, back, tries, due_us))
        if front < back:
            self._arm(due_us)  # never taken back: a retry that is not due does nothing

    def _park(self, event: str, now_us: int) -> None:
        front, back, tries, due = self._parked()
        self.store.put("_parked", back, (event, now_us))
        if front == back:
            tries, due = 1, now_us + self.settings.defer_base_ms * 1000
        self._set_parked(front, back + 1, tries, due)

    def _retry_parked(self, now_us: int) -> None:
        front, back, tries, _ = self._parked()
        while front < back:
            if not self._again(self.store.get("_parked", front)[0], now_us):
                wait = min(self.settings.defer_base_ms << min(tries, 40), self.settings.defer_cap_ms)
                self._set_parked(front, back, tries + 1, now_us + wait * 1000)
                return
            self.store.remove("_parked", front)
            front, tries = front + 1, 0
        self._set_parked(front, back, 0, 0)

    def fire_until(self, us: int) -> None:
        """Fire timers and retries due by ``us``."""
        while True:
            front, back, _, retry = self._parked()
            timer = self.next_timer()
            now_us = min((t for t in (timer, retry if front < back else None) if t is not None), default=None)
            if now_us is None or now_us > us:
                return
            if now_us == timer:
                self.drop_timer(now_us)
                if not self._run("on_timer", Timer(self.key, now_us), None, now_us, may_park=True):
                    self._park(json.dumps({"timer_us": now_us}), now_us)
            else:
                self._retry_parked(now_us)

    def finish(self, horizon_us: int) -> None:
        """Fire what is due until ``horizon_us`` after the last record and timer; tell what stays open."""
        self.fire_until(max([self._now, *self.timers()]) + horizon_us)
        front, back, _, _ = self._parked()
        for i in range(front, back):
            parked = json.loads(self.store.get("_parked", i)[0])
            self._off = None if isinstance(parked, dict) else parked[2]
            self.out("pending", parked if isinstance(parked, dict) else {})
        self._off = None
        for timer_us in sorted(self.timers()):
            self.out("pending", {"timer_us": timer_us})

    def record(self, message: Message) -> None:
        self.fire_until(message.ts_us)
        front, back, _, _ = self._parked()
        if front < back or not self._deliver(message, message.ts_us):
            self._park(message.to_json(), message.ts_us)


def check_handler(handler) -> None:
    missing = [m for m in METHODS if not callable(getattr(handler, m, None))]
    if missing:
        raise TypeError(f"handler lacks {', '.join(missing)}")


class MemoryStore:
    """State of the key at hand, for tables."""

    def __init__(self):
        self.tables: dict[str, dict] = {}

    def get(self, name, key):
        return self.tables.get(name, {}).get(key)

    def put(self, name, key, cell, new=False):
        self.tables.setdefault(name, {})[key] = cell

    def remove(self, name, key):
        self.tables.get(name, {}).pop(key, None)

    def items(self, name):
        return list(self.tables.get(name, {}).items())

    def flush(self):
        pass


CELL = "item string, write_us bigint"


class SparkStore:
    """The same tables as Spark state variables."""

    def __init__(self, handle: StatefulProcessorHandle, collections: dict[str, Collection]):
        self._values, self._maps = {}, {}
        for c in collections.values():
            if c.kind == "value":
                self._values[c.name] = handle.getValueState(c.name, c.item_schema)
            elif c.kind == "map":
                self._maps[c.name] = handle.getMapState(c.name, "map_key string", c.item_schema)
            else:
                self._maps[c.name] = handle.getMapState(c.name, "pos bigint", c.item_schema)
                self._values[c.name + "_ends"] = handle.getValueState(
                    c.name + "_ends", "front bigint, back bigint, write_us bigint")
        self._values["_purge"] = handle.getValueState("_purge", "due_us bigint")
        self._maps["_timers"] = handle.getMapState("_timers", "fire_us bigint", "armed int")
        self._maps["_parked"] = handle.getMapState("_parked", "pos bigint", CELL)
        self._values["_parked_ends"] = handle.getValueState(
            "_parked_ends", "front bigint, back bigint, tries bigint, due_us bigint")

    def get(self, name, key):
        if name in self._values:
            cell = self._values[name].get()
        else:
            state = self._maps[name]
            cell = state.getValue((key,)) if state.containsKey((key,)) else None
        return None if cell is None else tuple(cell)

    def put(self, name, key, cell):
        if name in self._values:
            self._values[name].update(cell)
        else:
            self._maps[name].updateValue((key,), cell)

    def remove(self, name, key):
        if name in self._values:
            self._values[name].clear()
        else:
            self._maps[name].removeKey((key,))

    def items(self, name):
        return [(k[0], tuple(v)) for k, v in self._maps[name].iterator()]


UNKNOWN = object()


class CachedStore:
    """One invocation's view of the state: each item is read and written once.

    Spark keeps or drops the state of a micro-batch as a whole, so writes can wait
    for the end of the invocation; what was added and removed within it is never
    written.
    """

    def __init__(self, store):
        self._store, self._now, self._before, self._listed = store, {}, {}, set()

    def get(self, name, key):
        at = (name, key)
        if at not in self._now:
            cell = None if name in self._listed else self._store.get(name, key)
            self._now[at] = self._before[at] = cell
        return self._now[at]

    def put(self, name, key, cell, new=False):
        """``new`` tells that the state holds nothing there."""
        self._before.setdefault((name, key), None if new else UNKNOWN)
        self._now[name, key] = cell

    def remove(self, name, key):
        self.put(name, key, None)

    def items(self, name):
        if name not in self._listed:
            for key, cell in self._store.items(name):
                if self._before.setdefault((name, key), cell) is UNKNOWN:
                    self._before[name, key] = cell
                self._now.setdefault((name, key), cell)
            self._listed.add(name)
        return [(k, c) for (n, k), c in self._now.items() if n == name and c is not None]

    def wrote(self, name) -> bool:
        return any(n == name and c is not None and c != self._before[n, k] for (n, k), c in self._now.items())

    def flush(self):
        for (name, key), cell in self._now.items():
            if cell == self._before[name, key]:
                continue
            if cell is None:
                self._store.remove(name, key)
            else:
                self._store.put(name, key, cell)


class HandlerProcessor(StatefulProcessor):
    """Runs a handler inside ``transformWithState``."""

    def __init__(self, handler, collections: dict[str, Collection], settings: Settings):
        self.handler, self.collections, self.settings = handler, collections, settings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.store = SparkStore(handle, self.collections)

    # Spark's timers have milliseconds; they fire once the watermark passes
    def _arm(self, us):
        self.handle.registerTimer(-(-us // 1000))

    def _disarm(self, us):
        self.handle.deleteTimer(-(-us // 1000))

    def _key_run(self, key) -> KeyRun:
        return KeyRun(self.handler, self.collections, self.settings,
                      CachedStore(self.store), tuple(key), self._arm, self._disarm)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        run = self._key_run(key)
        last_us = None
        for r in sorted(rows, key=lambda r: (r.part, r.off)):
            run.record(Message(r.topic, r.part, r.off, r.ts_us, r.key, r.payload))
            last_us = r.ts_us
            yield from (Row(**dict(zip(OUTPUT.names, row))) for row in run.take())
        self._save(run, last_us, timerValues)

    def _save(self, run, now_us, timerValues) -> None:
        run.save()

    def _time_of(self, expired_timer, timerValues) -> int:
        return expired_timer.getExpiryTimeInMs() * 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Timers that fired between records are gone from the state: nothing is left to do.
        run = self._key_run(key)
        now_us = self._time_of(expiredTimerInfo, timerValues)
        run.fire_until(now_us)
        run.purge(now_us)
        self._save(run, now_us, timerValues)
        yield from (Row(**dict(zip(OUTPUT.names, row))) for row in run.take())

    def close(self) -> None:
        pass


class WallClockProcessor(HandlerProcessor):
    """The same without a watermark: each key has its own time, so no record is late.

    A key's time is that of its last record, and goes on with the wall clock while no
    record comes. One alarm per key wakes it up for what is due next.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.clock = handle.getValueState("_clock", "at_us bigint, wall_ms bigint, alarm_ms bigint")

    def _arm(self, us):
        pass

    _disarm = _arm

    def _time_of(self, expired_timer, timerValues):
        at_us, wall_ms, _ = self.clock.get()
        return at_us + (timerValues.getCurrentProcessingTimeInMs() - wall_ms) * 1000

    def _save(self, run, now_us, timerValues) -> None:
        due, wall_ms = run.next_due(), timerValues.getCurrentProcessingTimeInMs()
        run.save()
        due = min((t for t in (due, run.next_due()) if t is not None), default=None)
        before = self.clock.get()
        if before is not None and before[2] is not None:
            self.handle.deleteTimer(before[2])
        alarm = None if due is None else wall_ms + max(1, -(-(due - now_us) // 1000))
        if alarm is not None:
            self.handle.registerTimer(alarm)
            self.clock.update((now_us, wall_ms, alarm))
        elif before is not None:
            self.clock.clear()


def _ship(handler) -> None:
    """Send the handler's own module to the workers as code, too."""
    module = sys.modules.get(type(handler).__module__)
    if module is not None and module.__name__ != "__main__":
        cloudpickle.register_pickle_by_value(module)


def _input(records: DataFrame) -> DataFrame:
    return records.select(
        "topic", "key", "part", "off", "ts", micros("ts").alias("ts_us"), "payload"
    )


def _output(rows: DataFrame) -> DataFrame:
    return rows.withColumn("at", from_micros("at_us")).drop("at_us")


def run_stream(
    records: DataFrame,
    handler,
    collections: Iterable[Collection] = (),
    settings: Settings = Settings(),
    watermark: str | None = None,
    marked: bool = False,
) -> DataFrame:
    """A handler over a stream of records: rows ``topic, key, off, kind, body, at``.

    ``kind`` is ``emit``, ``response`` (what a handler returned, as JSON),
    ``dead_letter``, ``dropped`` or, from tables, ``pending``. Every record is delivered, however far its key lags
    behind others; a key's timers fire when its own records reach them, or when as much
    time has passed on the wall clock.

    With a ``watermark`` timers follow it instead, which makes what fires depend on the
    records alone, and Spark drops records behind it. ``marked``: ``ts`` has it already.
    """
    check_handler(handler)
    _ship(handler)
    registered = register(collections)
    configure(records.sparkSession)
    timed = records if watermark is None or marked else records.withWatermark("ts", watermark)
    processor = WallClockProcessor if watermark is None else HandlerProcessor
    rows = (
        _input(timed)
        .groupBy(*KEY)
        .transformWithState(processor(handler, registered, settings), OUTPUT, "Append",
                            "ProcessingTime" if watermark is None else "EventTime")
    )
    return _output(rows)


def _table_pass(handler, collections, settings, horizon_us):
    def nothing(us):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, key = None, None

        def rows_of(done, last):
            if done is not None and last and horizon_us is not None:
                done.finish(horizon_us)
            return done.take() if done is not None else []

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            fresh = key_changes(batch, KEY, key)
            columns = [batch.column(c).to_pylist() for c in ("topic", "part", "off", "ts_us", "key", "payload")]
            out = []
            for i, values in enumerate(zip(*columns)):
                if fresh[i]:
                    out += rows_of(current, True)
                    current = KeyRun(handler, collections, settings, MemoryStore(),
                                     (values[0], values[4]), nothing, nothing)
                current.record(Message(*values))
                out += current.take()
            key = key_at(batch, KEY, n - 1)
            yield _batch(out)
        yield _batch(rows_of(current, True))

    return run


def _batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, kinds)], names=OUTPUT.names)


def run_table(
    records: DataFrame,
    handler,
    collections: Iterable[Collection] = (),
    settings: Settings = Settings(),
    flush: bool = True,
    horizon_seconds: int = 3600,
) -> DataFrame:
    """A handler over a table; with ``flush`` timers still open at its end fire.

    Time goes on until ``horizon_seconds`` after a key's last record and timer; timers
    that handlers set beyond that and records still failing then give ``pending`` rows.

    A handler is arbitrary code that must see its key's records in order, so a
    key is worked on by one task; rows stream through it and only the key's own
    state is held. Use the operators where one fits, they split hot keys.
    """
    check_handler(handler)
    _ship(handler)
    registered = register(collections)
    configure(records.sparkSession)
    ordered = _input(records).drop("ts").repartition(*KEY).sortWithinPartitions(*KEY, "part", "off")
    horizon_us = horizon_seconds * SECOND if flush else None
    return _output(ordered.mapInArrow(_table_pass(handler, registered, settings, horizon_us), OUTPUT))
